"""Keeping banks, questions and progress consistent across imports.

Every operation returns the new content of the relations; a snapshot is
written to a fresh path and swapped in by the caller.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Library:
    banks: DataFrame
    questions: DataFrame
    progress: DataFrame


def _put(stored: DataFrame, new: DataFrame) -> DataFrame:
    """New questions take the place of stored ones of the same id, whichever bank held them."""
    return stored.join(new.select("id"), "id", "left_anti").select(*stored.columns).unionByName(new)


def orphaned_progress(progress: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """Progress of questions that were in ``before`` and are gone from, or in another bank of, ``after``."""
    old = before.select(F.col("id").alias("question_id"), "bank_id")
    new = after.select(F.col("id").alias("question_id"), "bank_id")
    lost = old.join(new, ["question_id", "bank_id"], "left_anti").select("question_id").distinct()
    return progress.join(lost, "question_id", "left_semi")


def refresh_bundled(lib: Library, banks: DataFrame, questions: DataFrame) -> Library:
    """A new bundled dataset replaces the old one; uploads keep their bank ids, and progress of lost questions goes."""
    uploads = lib.banks.filter(F.col("origin") == "upload").select("id")
    old_ids = lib.banks.join(uploads, "id", "left_anti").select(F.col("id").alias("bank_id"))
    new_banks = banks.join(uploads, "id", "left_anti").withColumn("origin", F.lit("bundled"))
    new_questions = questions.join(uploads.withColumnRenamed("id", "bank_id"), "bank_id", "left_anti").select(*lib.questions.columns)
    old_questions = lib.questions.join(old_ids, "bank_id", "left_semi")
    lost = orphaned_progress(lib.progress, old_questions, new_questions).select("question_id")
    return Library(
        lib.banks.join(uploads, "id", "left_semi").unionByName(new_banks.select(*lib.banks.columns)),
        _put(lib.questions.join(old_ids, "bank_id", "left_anti"), new_questions),
        lib.progress.join(lost, "question_id", "left_anti"),
    )


def replace_banks(lib: Library, banks: DataFrame, questions: DataFrame) -> Library:
    """The given banks with their questions replace those of the same id and become uploads; shared ids keep progress."""
    ids = banks.select(F.col("id").alias("bank_id"))
    old = lib.questions.join(ids, "bank_id", "left_semi")
    gone = old.select("id").join(questions.select("id"), "id", "left_anti").withColumnRenamed("id", "question_id")
    return Library(
        lib.banks.join(banks.select("id"), "id", "left_anti").unionByName(banks.withColumn("origin", F.lit("upload")).select(*lib.banks.columns)),
        _put(lib.questions.join(ids, "bank_id", "left_anti"), questions.select(*lib.questions.columns)),
        lib.progress.join(gone, "question_id", "left_anti"),
    )


def deletable(banks: DataFrame) -> DataFrame:
    """Only uploads may be deleted by a user."""
    return banks.filter(F.col("origin") == "upload")


def delete_banks(lib: Library, ids: DataFrame) -> Library:
    """Banks of the column ``bank_id`` go with their questions and the progress of these."""
    gone = lib.questions.join(ids, "bank_id", "left_semi").select(F.col("id").alias("question_id"))
    return Library(
        lib.banks.join(ids.withColumnRenamed("bank_id", "id"), "id", "left_anti"),
        lib.questions.join(ids, "bank_id", "left_anti"),
        lib.progress.join(gone, "question_id", "left_anti"),
    )


def conflicting_bank(imports: DataFrame, banks: DataFrame) -> DataFrame:
    """For each import (id, name) the stored bank of that name: the same id first, else the latest."""
    stored = banks.select(F.col("id").alias("stored_id"), "name", "imported_at")
    met = imports.select(F.col("id").alias("import_id"), "name").join(stored, "name")
    order = F.struct((F.col("import_id") == F.col("stored_id")).alias("same"), "imported_at", "stored_id")
    return met.groupBy("import_id", "name").agg(F.max_by("stored_id", order).alias("stored_id"))


def copied(banks: DataFrame, questions: DataFrame, suffix: str) -> tuple[DataFrame, DataFrame]:
    """An import kept beside the stored bank: the suffix goes on bank and question ids."""
    on = lambda c: F.concat(F.col(c), F.lit(f"-{suffix}"))
    return banks.withColumn("id", on("id")), questions.withColumns({"id": on("id"), "bank_id": on("bank_id")})


def rekeyed(questions: DataFrame, import_id: Column, stored_id: Column) -> DataFrame:
    """A replacing import takes the stored bank's id, and its copy suffix on the question ids if that has one."""
    suffix = F.when(F.startswith(stored_id, F.concat(import_id, F.lit("-"))), F.substring(stored_id, F.length(import_id) + 1, F.length(stored_id))).otherwise("")
    return questions.withColumns({"id": F.concat("id", suffix), "bank_id": stored_id})


def names_in_order(imports: DataFrame) -> DataFrame:
    """Whether a name was seen earlier in the same batch: number of the import among its name, by file order."""
    return imports.withColumn("occurrence", F.row_number().over(Window.partitionBy("name").orderBy("file_ord")))


def derived_banks(questions: DataFrame) -> DataFrame:
    """Bank rows computed from the questions: count and the lists of types and difficulties."""
    from quillforge.operators.paper import facets

    counts = questions.groupBy("bank_id").agg(F.count("*").cast("int").alias("question_count"))
    return counts.join(facets(questions), "bank_id", "left").withColumnRenamed("bank_id", "id")
