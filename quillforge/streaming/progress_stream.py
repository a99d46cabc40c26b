"""Progress kept up to date by Structured Streaming.

``running_counts`` is a declarative fold in complete mode: redelivered events
are dropped within a watermark and counts are grouped by question.  Resets and
drops restart counters, which depends on order, so ``running_state`` keeps per
question the newest stamps (ts, seq, event_id) of drop and reset and the
stamped events after the drop.  A late drop or reset takes away only what was
before it, so the order of arrival changes nothing; the state of a question
holds its events since its last drop.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from quillforge.session import ship

EVENT_SCHEMA = (
    "event_id bigint, question_id string, bank_id string, device_id string, kind string, correct boolean, "
    "ts timestamp_ntz, seq int, received_at timestamp_ntz"
)


def read_events(spark: SparkSession, folder: str, pattern: str = "progress_events*.parquet", files_per_trigger: int = 64) -> DataFrame:
    """Parquet event files of a folder as a stream, event time as a timestamp."""
    stream = (
        spark.readStream.schema(EVENT_SCHEMA).option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", files_per_trigger).parquet(folder)
    )
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def once(stream: DataFrame, late: str = "30 days") -> DataFrame:
    """Each event once, however late within the watermark a copy arrives."""
    return stream.withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"])


def running_counts(stream: DataFrame) -> DataFrame:
    """``question_id, attempts, correct, wrong, starred, last_answered_at`` without resets."""
    answer = F.col("kind") == "answer"
    return (
        once(stream)
        .groupBy("question_id")
        .agg(
            F.count_if(answer).alias("attempts"),
            F.count_if(answer & F.col("correct")).alias("correct"),
            F.count_if(answer & ~F.col("correct")).alias("wrong"),
            (F.count_if(F.col("kind") == "star") % 2 == 1).alias("starred"),
            F.max(F.when(answer, F.col("ts"))).alias("last_answered_at"),
        )
    )


STATE = "kept string"
OUTPUT = "question_id string, attempts bigint, correct bigint, wrong bigint, starred boolean, live bigint"


def _advance(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    dropped, reset, live = json.loads(state.get[0]) if state.exists else ([], [], [])
    for rows in batches:
        for kind, right, ts, seq, event in zip(rows["kind"], rows["correct"], rows["ts"], rows["seq"], rows["event_id"]):
            at = [pd.Timestamp(ts).value, int(seq), int(event)]
            if kind == "drop":
                dropped = max(dropped, at)
            else:
                reset = max(reset, at) if kind == "reset_wrong" else reset
                live.append([at, kind, None if pd.isna(right) else bool(right)])
    live = [e for e in live if e[0] > dropped]
    answers = [(at, right) for at, kind, right in live if kind == "answer"]
    state.update((json.dumps([dropped, reset, live]),))
    yield pd.DataFrame(
        {
            "question_id": [key[0]],
            "attempts": [len(answers)],
            "correct": [sum(right is True for _, right in answers)],
            "wrong": [sum(right is False and at > reset for at, right in answers)],
            "starred": [sum(kind == "star" for _, kind, _ in live) % 2 == 1],
            "live": [len(live)],
        }
    )


def running_state(stream: DataFrame) -> DataFrame:
    """State with drops and resets, whatever the order of arrival; ``live`` is 0 if a drop left nothing."""
    ship(stream.sparkSession)
    rows = once(stream).select("question_id", "kind", "correct", "ts", "seq", "event_id")
    return rows.groupBy("question_id").applyInPandasWithState(_advance, OUTPUT, STATE, "update", GroupStateTimeout.NoTimeout)


def run_to_table(counts: DataFrame, name: str, mode: str = "complete", checkpoint: str | None = None) -> DataFrame:
    """Runs a stream over what is there now and returns the table it leaves."""
    writer = counts.writeStream.outputMode(mode).format("memory").queryName(name).trigger(availableNow=True)
    query = (writer.option("checkpointLocation", checkpoint) if checkpoint else writer).start()
    query.awaitTermination()
    return counts.sparkSession.table(name)


def merge_into_snapshot(counts: DataFrame, base: str, checkpoint: str):
    """Writes every update to a snapshot by key; one writer, so the last write of a key wins."""
    from quillforge.operators.progress import upsert
    from quillforge.sources.datasets import read_snapshot, write_snapshot

    def write(batch: DataFrame, _: int) -> None:
        try:
            stored = read_snapshot(batch.sparkSession, base)
        except FileNotFoundError:
            write_snapshot(batch, base)
            return
        write_snapshot(upsert(stored, batch, "question_id"), base, keep=False)

    return counts.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
