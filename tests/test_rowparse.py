import csv
import io
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quillforge.operators import rowparse


def line(*fields, n=18):
    out = list(fields) + [""] * (n - len(fields))
    return ",".join(out)


def sheet(row="2", kind="单选题", options=("x", "y"), answer="A"):
    return ",".join([row, kind, "中等", "类", "题", *options, *[""] * (9 - len(options)), answer, "", "否", ""])


CASES = [
    (sheet(), None),
    (sheet(' 7 ', answer=" B "), None),
    (sheet('"7"', '"单选题"', ('"x, ""y"""', "z")), None),
    (sheet('7', options=('"a\nb"', "z")), None),
    (sheet('7', options=('a"b', "z")), "quoting"),
    (sheet('7', options=('"ab', "z")), "quoting"),
    (sheet('7', options=('"ab" ', "z")), "quoting"),
    (sheet() + ",", "column_count"),
    ("（本页空白）", "column_count"),
    ("", "column_count"),
    (None, "column_count"),
    (sheet("1"), "source_row"),
    (sheet("1048577"), "source_row"),
    (sheet("007"), "source_row"),
    (sheet("+7"), "source_row"),
    (sheet("１２"), "source_row"),
    (sheet("99999999999999999999"), "source_row"),
    (sheet(options=("x", "", "y")), "options"),
    (sheet(options=("x",)), "options"),
    (sheet(kind="判断题", answer="正确"), "options"),
    (sheet(answer="C"), "answers"),
    (sheet(answer="AB"), "answers"),
    (sheet(answer="a"), "answers"),
    (sheet(answer=""), "answers"),
    (sheet(kind="多选题", answer="AB"), None),
    (sheet(kind="多选题", answer="A"), "answers"),
    (sheet(kind="多选题", answer="AA"), "answers"),
    (sheet(kind="多选题", answer="A,B".replace(",", "、")), "answers"),
    (sheet(kind="判断题", options=(), answer="错误"), None),
    (sheet(kind="判断题", options=(), answer="对"), "answers"),
    (sheet(kind="填空题", options=(), answer="任何"), None),
    (sheet(kind="填空题", options=(), answer="  "), "answers"),
    (sheet(kind="简答题", options=(), answer=""), None),
    (sheet(kind="填空题", options=(), answer="长" * 50_000), None),
]


def test_reasons(spark):
    raw = spark.createDataFrame([(i, t, ",", "x") for i, (t, _) in enumerate(CASES)], "line_id bigint, line_text string, delim string, reason string")
    got = {r.line_id: r.reason for r in rowparse.rejected(raw).collect()}
    assert {i: got.get(i) for i in range(len(CASES))} == {i: e for i, (_, e) in enumerate(CASES)}
    good = {r.line_id: r for r in rowparse.accepted(raw).collect()}
    assert [o.text for o in good[2].options] == ['x, "y"', "z"] and good[1].answers == ["B"] and good[24].answers == ["A", "B"] and good[0].source_row == 2


def test_empty_and_other_delimiters(spark):
    none = spark.createDataFrame([], "line_id bigint, line_text string, delim string")
    assert rowparse.rejected(none).count() == 0
    raw = spark.createDataFrame([(1, sheet().replace(",", ";"), ";"), (2, sheet().replace(",", "\t"), "\t"), (3, sheet(), None)], "line_id bigint, line_text string, delim string")
    assert rowparse.rejected(raw).count() == 0


def test_recovery(spark):
    text = sheet("2") + "\n" + sheet("3", options=('"broken', "z")) + "\n" + sheet("4") + "\r\n" + sheet("5")
    raw = spark.createDataFrame([(1, text, ",")], "line_id bigint, line_text string, delim string")
    got = rowparse.parse_records(raw).orderBy("record_start").collect()
    assert [(r.fields[0], r.error_at is None) for r in got] == [("2", True), ("3", False), ("4", True), ("5", True)]
    assert text[got[1].error_at :].startswith('"broken')


@given(st.lists(st.text(alphabet='ab",\n; ', max_size=8), min_size=1, max_size=6))
@settings(max_examples=300, deadline=None)
def test_reads_what_a_writer_writes(fields):
    out = io.StringIO()
    csv.writer(out, lineterminator="").writerow(fields)
    got, end, error = rowparse.RecordParser(",").record(out.getvalue(), 0)
    assert error is None and got == fields and end == len(out.getvalue())


@given(st.text(alphabet='a",\n', max_size=30))
@settings(max_examples=300, deadline=None)
def test_never_fails(text):
    list(rowparse.RecordParser(",", True).records(text))
    list(rowparse.RecordParser(",").records(text))


def test_long_text_is_linear():
    def seconds(n):
        began = time.perf_counter()
        fields, end, error = rowparse.RecordParser(",").record('"' + 'a""' * n + '",' + "b\n" * n, 0)
        assert error is None and len(fields) == 2 and end == 5 * n + 3
        return time.perf_counter() - began

    seconds(1_000)
    assert seconds(400_000) < 100 * max(seconds(40_000), 0.002)


def test_records_after_a_broken_quote_are_judged(spark):
    from quillforge.plans.problems import QUERIES

    text = sheet("2") + "\n" + sheet("3", options=('"broken', "z")) + "\n" + sheet("4", answer="C") + "\n" + sheet("5")
    raw = spark.createDataFrame([(1, text, ",")], "line_id bigint, line_text string, delim string")
    got = rowparse.located(raw).orderBy("record_start").collect()
    assert [(r.line_id, r.reason) for r in rowparse.rejected(raw).collect()] == [(1, "quoting")]
    assert sorted(r.source_row for r in rowparse.accepted(raw).collect()) == [2, 5]
    assert [r.reason for r in got] == [None, "quoting", "answers", None] and text[got[1].error_at :].startswith('"broken')
    assert "p5_records" in QUERIES
