import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quillforge.llm import canon
from quillforge.session import table

SCHEMA = "id string, type string, difficulty string, category string, norm string, canon_id int, k int"
CANON = "field_name string, canon_text string, aliases array<string>, canon_id bigint, n int"


def letters(s):
    return "".join(c for c in unicodedata.normalize("NFKC", s).lower() if unicodedata.category(c)[0] in "LN")


def distance(a, b):
    d = [[i + j if i * j == 0 else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def nearest(value, entries):
    v = letters(value)
    best = min(((distance(v, t) / max(len(v), len(t)), i) for i, texts in entries for t in map(letters, texts) if t), default=(1, 0))
    return best[1] if best[0] <= 0.5 else 0


def run(spark, values, entries):
    q = spark.createDataFrame([(str(i), v, None, "", "x", 1, 2) for i, v in enumerate(values)], SCHEMA)
    c = spark.createDataFrame([("type", t[0], t[1:], i, 0) for i, t in entries], CANON)
    return {r.question_id: r.canon_id for r in canon.map_values(q, c).collect()}


def test_edges(spark):
    entries = [(1, ["单选题", "Single Choice"]), (2, ["多选题", None]), (3, ["ab"]), (4, ["ba"])]
    values = ["单选题", "单选題", "选单题", "???", "Ｓｉｎｇｌｅ  choice!", "Sinlge Choice", None, "", "x" * 5000, "ab ", "单选题。", "单选题。"]
    got = run(spark, values, [(i, t) for i, t in entries])
    assert got == {"1": 1, "2": 1, "3": 0, "4": 1, "5": 1, "8": 0, "9": 3, "10": 1, "11": 1}
    # A tie goes to the smaller id.
    assert run(spark, ["单多"], [(9, ["单"]), (8, ["多"])]) == {"0": 8}
    assert run(spark, ["单选"], []) == {"0": 0}
    assert run(spark, [], [(1, ["单选题"])]) == {}


@given(st.lists(st.text("abcde", min_size=1, max_size=9), min_size=20, max_size=60, unique=True), st.lists(st.text("abcde", min_size=1, max_size=9), min_size=4, max_size=8, unique=True))
@settings(max_examples=4, deadline=None)
def test_against_brute_force(spark, values, texts):
    entries = [(i + 1, [t]) for i, t in enumerate(texts)]
    expected = {str(i): nearest(v, entries) for i, v in enumerate(values) if v not in texts}
    assert run(spark, values, entries) == expected


def test_whole_table(spark, small):
    q, c = table(spark, small, "question"), table(spark, small, "canon_value")
    rows = c.collect()
    exact = {(r.field_name, r.canon_text) for r in rows}
    entries = {f: [(r.canon_id, [r.canon_text, *r.aliases]) for r in rows if r.field_name == f] for f in canon.FIELDS}
    expected = {(r.id, f, nearest(r[f], entries[f])) for r in q.collect() for f in canon.FIELDS if r[f] and (f, r[f]) not in exact}
    assert {tuple(r) for r in canon.map_values(q, c).collect()} == expected


@pytest.mark.parametrize("a,b", [("ab", "ba"), ("abc", "acb"), ("ca", "abc"), ("abcdef", "badcfe")])
def test_swaps_count_once(spark, a, b):
    d, k = distance(a, b), max(len(a), len(b)) / 2
    assert run(spark, [a], [(1, [b])]) == {"0": 1 if d <= k else 0}
