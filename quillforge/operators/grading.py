"""Sessions: resuming, grading, tallies and scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillforge.functions import text as T
from quillforge.functions.chars import js_trim


def positions(sessions: DataFrame) -> DataFrame:
    """One row per position of a session with its response and judgement, session columns kept."""
    return sessions.select(
        F.col("id").alias("session_id"),
        F.coalesce("mode", F.lit("practice")).alias("mode"),
        "cursor_pos",
        F.posexplode("question_ids").alias("pos", "question_id"),
        "responses",
        "judgements",
    ).select(
        "session_id",
        "mode",
        "cursor_pos",
        "pos",
        "question_id",
        F.try_element_at("responses", F.col("question_id")).alias("response"),
        F.try_element_at("judgements", F.col("question_id")).alias("judgement"),
    )


def answerable(mode: Column, response: Column) -> Column:
    """A response that can be graded: not empty, and for fill questions not blank."""
    first = js_trim(F.coalesce(F.get(response, F.lit(0)), F.lit("")))
    return F.coalesce(F.size(response) > 0, F.lit(False)) & ~((mode == "fill") & (first == ""))


def graded(sessions: DataFrame, questions: DataFrame) -> DataFrame:
    """Each answered position of a session graded against its question, once per session and question."""
    q = questions.select(F.col("id").alias("question_id"), "answer_mode", "answers")
    # Responses are kept by question, so repeated positions agree and go before the join;
    # nothing is grouped after it, and a question in very many sessions can be split.
    rows = positions(sessions).filter(F.col("response").isNotNull()).select("session_id", "question_id", "mode", "response").dropDuplicates(["session_id", "question_id"])
    rows = rows.join(q, "question_id").filter(answerable(F.col("answer_mode"), F.col("response")))
    return rows.select("session_id", "question_id", T.is_correct(F.col("answer_mode"), F.col("response"), F.col("answers")).alias("is_right"), "mode")


def tallies(sessions: DataFrame) -> DataFrame:
    """``session_id, mode, total, answered, right, wrong, skipped`` from the judgements."""
    rows = positions(sessions)
    out = rows.groupBy("session_id", "mode").agg(F.count("*").alias("total"), F.count("judgement").alias("answered"), F.count_if("judgement").alias("right"))
    return out.withColumns({"wrong": F.col("answered") - F.col("right"), "skipped": F.col("total") - F.col("answered")})


def score(right: Column, denominator: Column) -> Column:
    """Whole percent, halves up, 0 of nothing."""
    return F.when(denominator > 0, F.floor((right * 200 + denominator) / (denominator * 2))).otherwise(0).cast("int")


def scores(sessions: DataFrame) -> DataFrame:
    """Exams are scored over all questions, practice over the answered ones."""
    t = tallies(sessions)
    return t.withColumn("score", score(F.col("right"), F.when(F.col("mode") == "exam", F.col("total")).otherwise(F.col("answered"))))


def first_open(sessions: DataFrame) -> DataFrame:
    """The first position without a judgement, null where all have one; and the ratio done."""
    rows = positions(sessions)
    out = rows.groupBy("session_id").agg(F.min(F.when(F.col("judgement").isNull(), F.col("pos"))).alias("first_open"), F.count("judgement").alias("done"), F.count("*").alias("total"))
    return out.withColumn("percent", score(F.col("done"), F.col("total")))


def resumed(sessions: DataFrame, questions: DataFrame) -> DataFrame:
    """Sessions cut to the questions that still exist, in their order; emptied sessions are left out.

    Responses and judgements keep surviving ids, the cursor stays inside.
    """
    known = questions.select(F.col("id").alias("question_id"))
    rows = positions(sessions).join(known, "question_id", "left_semi")
    kept = rows.groupBy("session_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "question_id"))), lambda s: s["question_id"]).alias("kept"))
    out = sessions.join(kept, sessions["id"] == kept["session_id"]).drop("session_id")
    inside = lambda m: F.map_filter(m, lambda k, _: F.array_contains(F.col("kept"), k))
    return out.withColumns(
        {
            "mode": F.coalesce("mode", F.lit("practice")),
            "responses": inside("responses"),
            "judgements": inside("judgements"),
            "cursor_pos": F.least(F.col("cursor_pos"), F.size("kept") - 1),
            "question_ids": F.col("kept"),
        }
    ).drop("kept")


def choice_marks(sessions: DataFrame, questions: DataFrame) -> DataFrame:
    """Options of answered choice questions with their marks: picked, right, wrongly picked."""
    q = questions.select(F.col("id").alias("question_id"), "answer_mode", "answers", "options")
    rows = positions(sessions).filter(F.col("judgement").isNotNull()).join(q, "question_id")
    shown = F.when(F.col("answer_mode") == "judge", F.array(F.struct(F.lit("T").alias("key"), F.lit("正确").alias("text")), F.struct(F.lit("F").alias("key"), F.lit("错误").alias("text")))).otherwise(F.col("options"))
    rows = rows.filter(F.col("answer_mode") != "fill").select("session_id", "question_id", "response", "answers", F.explode(shown).alias("o"))
    picked = F.coalesce(F.array_contains("response", F.col("o.key")), F.lit(False))
    right = F.coalesce(F.array_contains("answers", F.col("o.key")), F.lit(False))
    return rows.select("session_id", "question_id", F.col("o.key").alias("key"), picked.alias("picked"), right.alias("right"), (picked & ~right).alias("wrong"))


def toggled(response: Column, key: Column) -> Column:
    """Symmetric difference with one key."""
    return F.when(F.array_contains(response, key), F.array_remove(response, key)).otherwise(F.array_append(response, key))
