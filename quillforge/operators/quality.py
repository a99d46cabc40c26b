"""Integrity aggregates, histograms and content versions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def integrity(banks: DataFrame, questions: DataFrame) -> DataFrame:
    """One row: are ids unique, and do the banks' counts add up to the questions?"""
    b = banks.agg(F.count("*").alias("banks"), F.count_distinct("id").alias("bank_ids"), F.sum("question_count").alias("declared"))
    q = questions.agg(F.count("*").alias("questions"), F.count_distinct("id").alias("question_ids"))
    # Two single rows, met on a constant key.
    return b.withColumn("one", F.lit(1)).join(q.withColumn("one", F.lit(1)), "one").drop("one")


def require_unique_ids(questions: DataFrame) -> DataFrame:
    """Raises at run time if an id of different content occurs twice (a hash collision)."""
    several = questions.groupBy("id").agg(F.count_distinct(F.struct("bank_id", "stem")).alias("n"))
    return several.select("id", F.assert_true(F.col("n") == 1, F.concat(F.lit("id used twice: "), F.col("id"))).alias("ok"))


def count_drift(banks: DataFrame, questions: DataFrame) -> DataFrame:
    """Banks whose declared count is not the number of their questions."""
    n = questions.groupBy("bank_id").agg(F.count("*").alias("counted"))
    out = banks.select("id", "question_count").join(n, banks["id"] == n["bank_id"], "left")
    return out.select("id", "question_count", F.coalesce("counted", F.lit(0)).alias("counted")).filter("question_count <> counted")


def histogram(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.groupBy(*columns).agg(F.count("*").alias("n"))


def content_version(questions: DataFrame) -> DataFrame:
    """A version per bank that changes with any stem or answer and not with the order of rows.

    Row digests are added up exactly, so no bank is collected or sorted.
    """
    row = F.sha2(F.concat_ws("|", "id", F.coalesce("stem", F.lit("")), F.array_join("answers", ",")), 256)
    part = F.conv(F.substring(row, 1, 15), 16, 10).cast("decimal(38,0)")
    total = questions.select("bank_id", part.alias("d")).groupBy("bank_id").agg(F.sum("d").cast("string").alias("t"))
    return total.select("bank_id", F.substring(F.sha2("t", 256), 1, 20).alias("version"))


def repeated_names(banks: DataFrame, name: str = "source_file") -> DataFrame:
    """Output names that more than one bank would write to."""
    return banks.groupBy(name).agg(F.count("*").alias("n")).filter("n > 1")
