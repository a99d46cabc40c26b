from datetime import datetime

import pytest

from quillforge.operators import drift

ALIASES = [("stem", 1, "题干"), ("stem", 2, "题目"), ("answer", 1, "答案"), ("answer", 2, "正确答案"), ("category", 8, "类别"), ("difficulty", 5, "难度"), ("difficulty", 4, "题目难度"), ("type", 1, "题型")]
SCHEMA = "file_id bigint, feed string, file_seq int, published_at timestamp, sheet_name string, row_num int, cells map<int,string>, col int, text string"


@pytest.fixture
def aliases(spark):
    return spark.createDataFrame(ALIASES, "field_name string, alias_rank int, alias_text string")


def rows(spark, files):
    """``files``: file id to (feed, seq, rows); each row is (number, cells)."""
    out = [(f, feed, seq, datetime(2024, 1, 1), "s", n, c, None, None) for f, (feed, seq, lines) in files.items() for n, c in lines]
    return spark.createDataFrame(out, SCHEMA)


def found(spark, aliases, files):
    return sorted(tuple(r) for r in drift.schema_changes(rows(spark, files), aliases).collect())


HEAD = {2: "题型", 3: "题干", 4: "答案", 5: "难度"}


def test_changes(spark, aliases):
    body = lambda d, a="A": (9, {2: "单选题", 3: "某题目的答案", 4: a, 5: d})
    files = {
        1: ("f", 1, [(1, {2: "题目汇总"}), (2, HEAD), body("简单")]),
        2: ("f", 3, [(1, {2: "题型", 3: "【题 干】", 4: "答案", 5: "难度", 6: "类别"}), body("3"), (10, {2: "题型", 3: "题干", 4: "答案", 5: "难度"})]),
        3: ("f", 4, [(1, {1: "题型", 2: "题目难度*", 3: "题目", 4: "正确答案"}), (2, {1: "x", 2: "4.5", 3: "s", 4: "1"})]),
        4: ("g", 1, [(1, HEAD), body("简单")]),
    }
    assert found(spark, aliases, files) == [
        (2, "category", "added"),
        (2, "difficulty", "retyped"),
        (3, "answer", "renamed"),
        (3, "answer", "retyped"),
        (3, "category", "removed"),
        (3, "difficulty", "renamed"),
        (3, "stem", "renamed"),
    ]


def test_edge_cases(spark, aliases):
    files = {1: ("f", 1, [(1, None), (2, {}), (3, {1: " ", 2: None})]), 2: ("f", 1, [(1, HEAD)])}
    assert {x[2] for x in found(spark, aliases, files)} == {"added"}
    assert found(spark, aliases, {}) == []
    assert found(spark, aliases.limit(0), {1: ("f", 1, [(1, HEAD)]), 2: ("f", 2, [(1, HEAD)])}) == []
    # Nothing to compare types with: an empty column is not retyped.
    files = {1: ("f", 1, [(1, HEAD), (2, {3: "s", 5: "1"})]), 2: ("f", 2, [(1, HEAD), (2, {3: "s"})])}
    assert found(spark, aliases, files) == []


def test_one_table(spark, aliases):
    lines = [(1, HEAD), (2, {3: "s" * 30_000, 4: "A", 5: "1"}), (3, {3: "t", 4: "B", 5: "2"}), (3, {3: "t", 4: "B", 5: "2"}), (4, {3: "u", 4: "C", 5: "难"}), (4, {3: "u", 4: "C", 5: "难"})]
    got = drift.consistent_table(rows(spark, {1: ("f", 1, lines)}), aliases).orderBy("row_num").collect()
    assert [(r.row_num, r.answer, r.difficulty, r.difficulty_number, r.failed_casts) for r in got] == [
        (2, "A", "1", 1.0, ""),
        (3, "B", "2", 2.0, ""),
        (3, "B", "2", 2.0, ""),
        (4, "C", "难", None, "difficulty"),
        (4, "C", "难", None, "difficulty"),
    ]
    assert len(got[0].stem) == 30_000


def test_every_field_is_typed(spark, aliases):
    """Numbers and failed casts of answers and stems, not only of category and difficulty."""
    lines = [(1, HEAD), (2, {3: "10", 4: "1", 5: "易"}), (3, {3: "11", 4: "2.5", 5: "难"}), (4, {3: "问", 4: "对", 5: "难"})]
    got = drift.consistent_table(rows(spark, {1: ("f", 1, lines)}), aliases).orderBy("row_num").collect()
    assert [(r.stem_number, r.answer_number, r.difficulty_number, r.answer, r.failed_casts) for r in got] == [
        (10.0, 1.0, None, "1", ""),
        (11.0, 2.5, None, "2.5", ""),
        (None, None, None, "对", "stem,answer"),
    ]
