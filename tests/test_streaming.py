from datetime import datetime, timedelta

from quillforge.operators import progress
from quillforge.sources.datasets import read_snapshot
from quillforge.streaming import progress_stream as ps


def events(spark, rows):
    t0 = datetime(2025, 1, 1)
    made = [(i, q, "b", None, k, c, t0 + timedelta(minutes=m), i, t0) for i, q, k, c, m in rows]
    return spark.createDataFrame(made, ps.EVENT_SCHEMA)


ROWS = [
    (1, "q1", "answer", True, 1),
    (2, "q1", "answer", False, 2),
    (3, "q1", "star", None, 3),
    (4, "q1", "reset_wrong", None, 4),
    (5, "q1", "answer", False, 5),
    (5, "q1", "answer", False, 5),
    (6, "q2", "answer", False, 1),
    (7, "q2", "drop", None, 2),
    (8, "q2", "answer", None, 3),
    (9, "q3", "star", None, 1),
    (10, "q3", "star", None, 2),
]


def test_fold(spark):
    got = {r.question_id: (r.attempts, r.correct, r.wrong, r.starred) for r in progress.fold(events(spark, ROWS)).collect()}
    assert got == {"q1": (3, 1, 1, True), "q2": (1, 0, 0, False), "q3": (0, 0, 0, False)}
    assert progress.fold(events(spark, [])).count() == 0


def test_state_stream_matches_fold(spark, tmp_path):
    events(spark, ROWS).coalesce(1).write.parquet(str(tmp_path / "in/progress_events.parquet"))
    stream = ps.read_events(spark, str(tmp_path / "in"), "*.parquet")
    query = ps.merge_into_snapshot(ps.running_state(stream), str(tmp_path / "store"), str(tmp_path / "check"))
    query.awaitTermination()
    got = {r.question_id: (r.attempts, r.correct, r.wrong, r.starred) for r in read_snapshot(spark, str(tmp_path / "store")).collect()}
    assert got == {"q1": (3, 1, 1, True), "q2": (1, 0, 0, False), "q3": (0, 0, 0, False)}


def test_late_drops_and_resets(spark, tmp_path):
    """Batches out of order give what the fold gives of all events."""
    first = [(1, "q1", "answer", False, 1), (3, "q1", "answer", True, 5), (4, "q2", "answer", False, 1), (6, "q2", "answer", False, 5), (9, "q3", "answer", True, 2)]
    late = [(2, "q1", "drop", None, 2), (5, "q2", "reset_wrong", None, 2), (8, "q3", "drop", None, 2)]
    for i, rows in enumerate((first, late)):
        events(spark, rows).coalesce(1).write.parquet(str(tmp_path / f"in/{i}.parquet"))
        stream = ps.read_events(spark, str(tmp_path / "in"), "*.parquet")
        ps.merge_into_snapshot(ps.running_state(stream), str(tmp_path / "store"), str(tmp_path / "check")).awaitTermination()
    got = {r.question_id: (r.attempts, r.correct, r.wrong, r.starred) for r in read_snapshot(spark, str(tmp_path / "store")).collect()}
    want = {r.question_id: (r.attempts, r.correct, r.wrong, r.starred) for r in progress.fold(events(spark, first + late)).collect()}
    assert got == want == {"q1": (1, 1, 0, False), "q2": (2, 0, 1, False), "q3": (1, 1, 0, False)}
