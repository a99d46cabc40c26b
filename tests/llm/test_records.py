import collections

import regex
from pyspark.sql import functions as F

from quillforge.llm import records
from quillforge.session import table

SCHEMA = "id string, stem string, answers array<string>, keep_id int, f_stem string, n int"
BLANK = r"[\s\p{Z}\x1c-\x1f\x85]"


def counted(s):
    return regex.sub(BLANK + r"|(?<!\p{Nd})\p{P}|\p{P}(?!\p{Nd})", "", s.lower())


def key(stem, answers):
    parts = (counted(p) for a in answers or [] if a is not None for p in regex.split(records.SEPARATORS, a))
    return counted(stem or ""), tuple(sorted(p for p in parts if p))


def expected(rows):
    by = collections.defaultdict(set)
    for i, stem, answers in rows:
        if i is not None:
            by[key(stem, answers)].add(i)
    return {(min(v), i) for v in by.values() for i in v if i != min(v)}


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)


ROWS = [
    ("a", "What is 3.5 V?", ["A", "B"]),
    ("b", "what is３.5 v", ["B，A"]),
    ("c", "what is 3.5 V", ["b;a"]),
    ("d", "what is 35 v", ["a", "b"]),
    ("e", "what is 3. 5 v", ["a", "b"]),
    ("f", None, None),
    ("g", "", []),
    ("h", " 。", ["、,"]),
    ("i", "x", ["a", "a"]),
    ("j", "X!", ["a"]),
    ("k", "x", ["A", None, "a。"]),
    ("l", "y" * 40_000, ["1,5"]),
    ("m", "Y" * 40_000, ["5、1"]),
    ("m", "Y" * 40_000, ["5、1"]),
    (None, "x", ["a"]),
    ("n", "u​v", ["a"]),
    ("o", "uv", ["a"]),
]


def test_edges(spark):
    got = {tuple(r) for r in records.copies(frame(spark, ROWS)).collect()}
    assert got == expected(ROWS)
    assert {("f", "g"), ("f", "h"), ("l", "m"), ("i", "k"), ("a", "c")} <= got and ("a", "b") not in got
    assert records.copies(frame(spark, [])).count() == 0


def test_counts(spark):
    got = {r.keep_id: r.n_copies for r in records.collapsed(frame(spark, ROWS)).collect()}
    assert got["f"] == 3 and got["i"] == 2 and got["d"] == 2 and sum(got.values()) == len({r[0] for r in ROWS if r[0]})


def test_hot_group(spark):
    rows = [(f"q{i:05d}", "Same  stem", ["A"]) for i in range(3000)] + [(f"r{i}", f"other {i}x", ["A"]) for i in range(3000)]
    assert records.copies(frame(spark, rows)).count() == 2999


def test_collisions_are_told_apart(spark, monkeypatch):
    honest = records.fingerprinted
    monkeypatch.setattr(records, "fingerprinted", lambda q: honest(q).withColumns({"fp_a": F.lit(1).cast("bigint"), "fp_b": F.lit(1).cast("bigint")}))
    rows = [r for r in ROWS if r[0]]
    assert {tuple(r) for r in records.copies(frame(spark, rows)).collect()} == expected(rows)


def test_whole_table(spark, small):
    q = table(spark, small, "question")
    assert {tuple(r) for r in records.copies(q).collect()} == expected([(r.id, r.stem, r.answers) for r in q.collect()])
