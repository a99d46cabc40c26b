"""The 17-column sheet layout, and checks that exporting and importing agree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillforge.functions import text as T
from quillforge.operators.ingest import NOTE_HEADER, import_rows, source_rows
from quillforge.operators.sequence import with_last
from quillforge.session import durable

# The columns and the sheet name of the standard sheet.
COLUMNS = ("题型", "难易度", "知识类别", "题干", *T.OPTION_KEYS, "答案", "出自规范", "是否保命题", NOTE_HEADER)
SHEET, CASE_TYPE = "题库题目", "案例题"
COMPARED = ("type", "answer_mode", "difficulty", "category", "stem", "options", "answers", "source", "lifesaving", "note", "case_context")


def sheet_rows(questions: DataFrame) -> DataFrame:
    """``id`` and the 17 columns of each question, as text."""
    text = lambda k: F.coalesce(F.get(F.filter("options", lambda o: o["key"] == k), F.lit(0))["text"], F.lit(""))
    values = [
        F.coalesce("type", F.lit("")),
        F.coalesce("difficulty", F.lit("")),
        F.coalesce("category", F.lit("")),
        F.col("stem"),
        *(text(k) for k in T.OPTION_KEYS[:9]),
        T.export_answer(F.col("answer_mode"), F.col("answers")),
        F.coalesce("source", F.lit("")),
        F.when(F.col("lifesaving"), "是").otherwise("否"),
        F.coalesce("note", F.lit("")),
    ]
    return questions.select("id", *(v.alias(c) for c, v in zip(COLUMNS, values)))


def context_rows(questions: DataFrame, within: str, order: list[str]) -> DataFrame:
    """The extra rows to write before questions whose context is not blank and differs from the one before."""
    context = F.coalesce("case_context", F.lit(""))
    rows = with_last(questions, context, [within], order, "before", inclusive=False)
    return rows.filter((context != "") & (context != F.coalesce("before", F.lit("")))).select(F.col("id").alias("before_id"), within, F.col("case_context").alias("context"))


def missing_options(questions: DataFrame) -> DataFrame:
    """Letters a choice question's answer names without an option of that key."""
    keys = F.transform("options", lambda o: o["key"])
    letters = T.answer_letters(F.array_join("answers", ""))
    missing = F.array_except(letters, keys)
    rows = questions.filter(F.col("answer_mode").isin("single", "multiple")).select("id", F.array_join(missing, "").alias("missing"))
    return rows.filter("missing <> ''")


def differences(left: DataFrame, right: DataFrame, key: Column | str, columns: tuple[str, ...]) -> DataFrame:
    """Keys and columns in which two relations differ, null-safe; a row only one side has differs in all."""
    a = left.select(F.col(key).alias("key"), F.struct(*columns).alias("a"))
    b = right.select(F.col(key).alias("key"), F.struct(*columns).alias("b"))
    both = a.join(b, "key", "full_outer")
    off = F.array(*(F.when(~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) | F.col("a").isNull() | F.col("b").isNull(), F.lit(c)) for c in columns))
    return both.select("key", F.explode(F.filter(off, lambda x: x.isNotNull())).alias("column"))


def round_trip(questions: DataFrame) -> DataFrame:
    """Questions whose mode or answers change when their exported row is parsed again."""
    sheet = sheet_rows(questions)
    made = F.array(*(F.struct(F.lit(k).alias("key"), F.col(k).alias("text")) for k in T.OPTION_KEYS))
    parsed = sheet.select("id", T.parse_answer(F.col("题型"), F.col("答案"), F.filter(made, lambda o: o["text"] != "")).alias("p"))
    joined = questions.select("id", "answer_mode", "answers").join(parsed, "id")
    return joined.filter((F.col("answer_mode") != F.col("p.mode")) | ~F.col("answers").eqNullSafe(F.col("p.answers"))).select("id", "answer_mode", F.col("p.mode").alias("parsed_mode"))


def reconciled(imported: DataFrame, source: DataFrame) -> DataFrame:
    """Each imported question with its source row by (file, sheet, row, stem); ``found`` is false where there is none.

    A source row that is given again is one row.
    """
    fields = ("answer", "category", "source", "lifesaving")
    s = source.groupBy("file", "sheet", F.col("row_num").alias("source_row"), "stem").agg(F.min(F.struct(*fields)).alias("s"))
    s = s.select("file", "sheet", "source_row", "stem", F.lit(True).alias("found"), *(F.col(f"s.{f}").alias(f"s_{f}") for f in fields))
    return imported.join(s, ["file", "sheet", "source_row", "stem"], "left").withColumn("found", F.coalesce("found", F.lit(False)))


def require_located(rows: DataFrame) -> DataFrame:
    """The reconciled rows; raises at run time for one without a source row."""
    said = F.concat(F.lit("no source row for "), F.concat_ws(" ", "file", "sheet", "source_row"))
    return rows.withColumn("_ok", F.assert_true(F.col("found"), said)).filter(F.col("_ok").isNull()).drop("_ok")


def enriched(rows: DataFrame) -> DataFrame:
    """Category, source and lifesaving of the source row win where present."""
    return rows.withColumns(
        {
            "category": F.coalesce(T.blank_to_null(F.col("s_category")), "category"),
            "source": F.coalesce(T.blank_to_null(F.col("s_source")), "source"),
            "lifesaving": F.coalesce(T.is_lifesaving(T.blank_to_null(F.col("s_lifesaving"))), "lifesaving"),
        }
    )


def named_but_missing(rows: DataFrame) -> Column:
    """Letters the source row's answer cell names without an option of that key, for choice questions; in order."""
    missing = F.array_except(T.answer_letters(F.coalesce("s_answer", F.lit(""))), F.transform("options", lambda o: o["key"]))
    return F.when(F.col("answer_mode").isin("single", "multiple"), F.array_join(missing, "、")).otherwise("")


def converted(rows: DataFrame) -> DataFrame:
    """Sheet rows as questions for the standard sheet: imported, found again in their source, enriched.

    ``missing`` names the options an answer refers to that are not there (such
    questions are not written), ``review`` is true for a multiple choice with
    one answer.
    """
    got = enriched(require_located(reconciled(import_rows(rows).questions, source_rows(rows))))
    return got.withColumns({"missing": named_but_missing(got), "review": (F.col("answer_mode") == "multiple") & (F.size("answers") < 2)})


def cells_of(values: Column) -> Column:
    """The cells of a row of texts, empty ones absent."""
    return F.map_from_entries(F.filter(F.transform(values, lambda v, i: F.struct((i + 1).cast("int").alias("key"), v.alias("value"))), lambda e: e["value"] != ""))


def written_rows(questions: DataFrame) -> DataFrame:
    """``file, sheet, row_num, cells`` of the standard sheet of each file: header, context rows, questions.

    A file is one workbook, whose size the reader bounds; rows are numbered within it.
    """
    sheets = questions.select("file", "sheet").distinct().withColumn("sheet_ord", F.row_number().over(Window.partitionBy("file").orderBy("sheet")))
    rows = questions.join(sheets, ["file", "sheet"]).withColumn("ord", F.col("sheet_ord").cast("bigint") * (1 << 21) + F.col("source_row"))
    context = F.coalesce("case_context", F.lit(""))
    rows = with_last(rows, context, ["file"], ["ord"], "before", inclusive=False)
    made = [c for c in sheet_rows(questions).columns if c != "id"]
    values = sheet_rows(rows.withColumn("id", F.struct("file", "ord"))).select("id.*", F.array(*(F.col(c) for c in made)).alias("values"), F.lit(1).alias("kind"))
    opens = (context != "") & (context != F.coalesce("before", F.lit("")))
    blank = F.lit("")
    case_row = F.array(F.lit(CASE_TYPE), F.coalesce("difficulty", blank), F.coalesce("category", blank), context, *[blank] * (len(made) - 4))
    contexts = rows.filter(opens).select("file", "ord", case_row.alias("values"), F.lit(0).alias("kind"))
    headers = questions.select("file").distinct().select("file", F.lit(-1).cast("bigint").alias("ord"), F.array(*map(F.lit, made)).alias("values"), F.lit(0).alias("kind"))
    all_ = values.unionByName(contexts).unionByName(headers)
    number = F.row_number().over(Window.partitionBy("file").orderBy("ord", "kind"))
    return all_.select("file", F.lit(SHEET).alias("sheet"), number.alias("row_num"), cells_of(F.col("values")).alias("cells"), "ord", "kind")


def verified(questions: DataFrame) -> DataFrame:
    """``key, column``: the fields of written questions that differ when the written sheet is imported again; a lost question differs in all."""
    rows = durable(written_rows(questions), "written-rows")
    place = rows.filter("kind = 1").select(F.col("file").alias("p_file"), F.col("row_num").alias("p_row"), F.concat_ws("|", "file", "ord").alias("key"))
    again = import_rows(rows.select("file", "sheet", "row_num", "cells")).questions
    again = again.join(place, (F.col("file") == F.col("p_file")) & (F.col("source_row") == F.col("p_row"))).select("key", *COMPARED)
    sheets = questions.select("file", "sheet").distinct().withColumn("sheet_ord", F.row_number().over(Window.partitionBy("file").orderBy("sheet")))
    given = questions.join(sheets, ["file", "sheet"]).select(F.concat_ws("|", "file", F.col("sheet_ord").cast("bigint") * (1 << 21) + F.col("source_row")).alias("key"), *COMPARED)
    return differences(given, again, "key", COMPARED)
