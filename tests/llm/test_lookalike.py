import re
import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from quillforge.llm import lookalike
from quillforge.session import table

SCHEMA = "id string, stem string, options array<struct<key:string,text:string>>, answers array<string>, h string, c string"
MAP = dict(lookalike.mapping())


def form(s):
    return unicodedata.normalize("NFC", re.sub(" +", " ", "".join(MAP.get(c, c) for c in s)).strip(" "))


def expected(rows):
    out, rows = set(), [r for r in rows if r[0] is not None]
    for i, _, options, answers in rows:
        shown = [(k or "", t) for k, t in options or [] if t is not None]
        for k, t in shown:
            out |= {("option", i, i, k, m) for m, u in shown if k < m and t != u and form(t) == form(u)}
            out |= {("answer", i, i, "", k) for a in answers or [] if a is not None and a != t and form(a) == form(t)}
    stems = [(i, s) for i, s, *_ in rows if s is not None]
    return out | {("stem", i, j, "", "") for i, s in stems for j, t in stems if i < j and s != t and form(s) == form(t)}


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


def test_forms():
    same = [("Ａ，ｂ", "A,b"), ("a 　 b ", "a b"), ("a​b﻿", "ab"), ("é", "é"), ("РАсе", "PAce"), ("⼯⼈", "工人"), ("Ω", "Ω"), ("ﾊﾟ", "パ"), ("q̣̇", "q̣̇"), ("е́", "é")]
    assert all(form(a) == form(b) for a, b in same)
    assert all(form(a) != form(b) for a, b in [("a", "A"), ("é", "e"), ("。", "."), ("m³", "m3"), ("a b", "ab"), ("O", "0")])


ROWS = [
    ("a", "Ａ型 阀门", [("A", "x"), ("B", "ｘ"), ("C", None), (None, "x​")], ["ｘ", None, "B"]),
    ("b", "A型　阀门 ", None, None),
    ("c", "A型阀门", [], []),
    ("d", None, None, ["x"]),
    ("e", "", None, None),
    ("f", "​­", None, None),
    ("g", "é" * 20_000, None, None),
    ("h", "é" * 20_000, None, None),
    ("h", "é" * 20_000, None, None),
    (None, "A型 阀门", None, None),
    ("i", "q̣̇", None, None),
    ("j", "q̣̇", None, None),
    ("k", "tab\there", None, None),
    ("l", "tab here", None, None),
]


def test_edges(spark):
    got = {tuple(r) for r in lookalike.lookalikes(frame(spark, ROWS)).collect()}
    assert got == expected(ROWS)
    assert {("stem", "a", "b", "", ""), ("stem", "g", "h", "", ""), ("stem", "i", "j", "", ""), ("stem", "e", "f", "", ""), ("answer", "a", "a", "", "A")} <= got
    assert lookalike.lookalikes(frame(spark, [])).count() == 0


@given(st.lists(st.text("aаＡé ẹ́̇ ​к工⼯ｶﾞ，,", max_size=8), min_size=30, max_size=60))
@settings(max_examples=4, deadline=None)
def test_every_text_has_its_form(spark, texts):
    q = frame(spark, [(str(i), t, None, None) for i, t in enumerate(texts)])
    for r in lookalike.consistent_questions(q).collect():
        assert r.form == form(r.text)


def test_whole_table(spark, small):
    q = table(spark, small, "question")
    rows = [(r.id, r.stem, [(o.key, o.text) for o in r.options or []], r.answers) for r in q.collect()]
    assert {tuple(r) for r in lookalike.lookalikes(q).collect()} == expected(rows)


def test_more_scripts_and_hangul(spark):
    pairs = [("ӏl", "ll"), ("ρορ", "pop"), ("ոօ", "no"), ("ɡɑɡ", "gag"), ("𝐀𝑏", "Ab"), ("각나", "각나"), ("각", "각")]
    rows = [(i, t, t) for i, t in enumerate(x for p in pairs for x in p)]
    texts = spark.createDataFrame(rows, "i int, text string, t string").withColumn("h", lookalike.text_key(F.col("text")))
    got = {r.h: r.form for r in lookalike.consistent(texts).collect()}
    form = {r.t: got.get(r.h, r.t) for r in texts.collect()}
    assert all(form[a] == form[b] for a, b in pairs)
