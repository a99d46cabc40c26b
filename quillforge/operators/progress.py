"""Per-question progress as a fold over append-only events.

Events are redelivered, so each ``event_id`` counts once.  State follows the
last ``drop`` of a question: attempts and right answers are counted after it,
wrong ones after the last ``reset_wrong`` too, ``starred`` is the parity of the
star toggles.  Order is (ts, seq, event_id).

The fold needs no sorting: the few drop and reset stamps are one small row per
question, joined back to the events by question and salt (``SALTS`` copies of
each stamp), and the events are counted with partial aggregation.  A question
with a third of all events is so spread over ``SALTS`` tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SALTS = 16
EVENT_COLUMNS = ("event_id", "question_id", "bank_id", "kind", "correct", "ts", "seq")


def once(events: DataFrame) -> DataFrame:
    """Each event once: copies agree in all but their arrival."""
    return events.select(*EVENT_COLUMNS).dropDuplicates(["event_id"])


def fold(events: DataFrame) -> DataFrame:
    """``question_id, attempts, correct, wrong, starred, last_answered_at``."""
    rows = once(events).withColumn("at", F.struct("ts", "seq", "event_id"))
    stamps = (
        rows.filter(F.col("kind").isin("drop", "reset_wrong"))
        .groupBy("question_id")
        .agg(F.max(F.when(F.col("kind") == "drop", F.col("at"))).alias("dropped"), F.max(F.when(F.col("kind") == "reset_wrong", F.col("at"))).alias("reset"))
    )
    stamps = stamps.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = rows.withColumn("salt", F.pmod(F.hash("event_id"), F.lit(SALTS)))
    live = rows.join(stamps, ["question_id", "salt"], "left").filter((F.col("kind") != "drop") & (F.col("dropped").isNull() | (F.col("at") > F.col("dropped"))))
    answer = F.col("kind") == "answer"
    counts = F.col("reset").isNull() | (F.col("at") > F.col("reset"))
    return live.groupBy("question_id").agg(
        F.count_if(answer).alias("attempts"),
        F.count_if(answer & F.col("correct")).alias("correct"),
        F.count_if(answer & ~F.col("correct") & counts).alias("wrong"),
        (F.count_if(F.col("kind") == "star") % 2 == 1).alias("starred"),
        F.max(F.when(answer, F.col("ts"))).alias("last_answered_at"),
    )


def star_parity(events: DataFrame) -> DataFrame:
    stars = once(events).filter(F.col("kind") == "star").groupBy("question_id").agg(F.count("*").alias("toggles"))
    return stars.withColumn("starred", F.col("toggles") % 2 == 1)


def with_progress(questions: DataFrame, progress: DataFrame) -> DataFrame:
    """Every question with its progress, zero where it has none."""
    p = progress.select(F.col("question_id").alias("id"), "attempts", "correct", "wrong", "starred", "last_answered_at")
    zero = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("attempts", "correct", "wrong")}
    return questions.join(p, "id", "left").withColumns(zero | {"starred": F.coalesce("starred", F.lit(False))})


def wrong_by_bank(questions: DataFrame, progress: DataFrame) -> DataFrame:
    wrong = with_progress(questions, progress).filter(F.col("wrong") > 0)
    return wrong.groupBy("bank_id").agg(F.count("*").alias("wrong_questions"), F.sum("wrong").alias("wrong_answers"))


def clear_wrong(progress: DataFrame, ids: DataFrame) -> DataFrame:
    """Wrong counts of the given questions to 0; other fields and unknown ids untouched."""
    marked = ids.select(F.col("id").alias("question_id")).distinct().withColumn("hit", F.lit(True))
    return progress.join(marked, "question_id", "left").withColumn("wrong", F.when(F.col("hit") & (F.col("wrong") > 0), 0).otherwise(F.col("wrong"))).drop("hit")


def latest_per_key(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """Put semantics: the last row of each key, by ``order``; partially aggregated, no sorting."""
    at = F.struct(*order)
    return rows.groupBy(key).agg(F.max_by(F.struct(*[c for c in rows.columns if c != key]), at).alias("r")).select(key, "r.*")


def upsert(stored: DataFrame, changed: DataFrame, key: str) -> DataFrame:
    """Whole-row replacement by key."""
    return stored.join(changed.select(key), key, "left_anti").unionByName(changed)


def delete_keys(stored: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return stored.join(keys.select(key), key, "left_anti")


ACTIVE = "active"


def save_session(stored: DataFrame, session: DataFrame) -> DataFrame:
    """The one session slot holds the session given last."""
    return upsert(stored, session.withColumn("id", F.lit(ACTIVE)), "id")


def active_session(stored: DataFrame) -> DataFrame:
    return stored.filter(F.col("id") == ACTIVE)


def clear_session(stored: DataFrame) -> DataFrame:
    return stored.filter(F.col("id") != ACTIVE)


def navigation(sessions: DataFrame) -> DataFrame:
    """Previous and next question of each position of a session."""
    rows = sessions.select(F.col("id").alias("session_id"), F.posexplode("question_ids").alias("pos", "question_id"))
    w = Window.partitionBy("session_id").orderBy("pos")
    return rows.withColumns({"previous_id": F.lag("question_id").over(w), "next_id": F.lead("question_id").over(w)})
