"""Rows that fail to parse.

An error-recovering recursive-descent parser reads delimited text:

    text   := record (line-break record)*
    record := field (delimiter field)*
    field  := quoted | bare
    quoted := '"' (character | '""')* '"'
    bare   := any characters but a double quote

After a broken quote it resumes at the next *anchor*, a line break followed by
what only a record can start with (a row number, a delimiter, a question type
and a delimiter), so one bad record never takes its successors along; other
line breaks are content.  It returns fields and located errors; all value
checks run in the JVM.  A line is set apart for its first bad record, and its
valid records are loaded all the same.

Defined cases
  * null ``line_text`` is a record without fields (``column_count``);
  * null or empty ``delim`` means a comma;
  * texts of any length are parsed whole, in time linear in their length;
  * repeated lines are judged one by one; an empty table gives an empty
    result; further columns of the input are not touched.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillforge.session import ship

COLUMNS = 18
OPTION_KEYS = "ABCDEFGHI"
# Question types of the sheet format.
CHOICE_SINGLE, CHOICE_MULTIPLE, JUDGE, FILL = "单选题", "多选题", "判断题", "填空题"
JUDGE_ANSWERS = ("正确", "错误")
#: In the order in which they are given.
REASONS = ("quoting", "column_count", "source_row", "options", "answers")


class RecordParser:
    """Parses delimited text.

    A line break between fields or in a bare field begins a new record where
    an anchor follows; with ``by_line`` it always does.
    """

    def __init__(self, delim: str, by_line: bool = False):
        d = re.escape(delim)
        self.width = len(delim)
        self.delim = delim
        anchor = rf'(?:\r?\n|\r)(?= *"?[1-9][0-9]{{0,6}}"? *{d} *"?[^"\r\n]{{1,12}}题"? *{d})'
        self.break_ = re.compile(r"\r?\n|\r" if by_line else anchor)
        end = self.break_.pattern
        self.quoted = re.compile(rf'"((?:[^"]|"")*+)"(?={d}|{end}|\Z)')
        # Most characters can neither end a field nor a record; the others are looked at one by one.
        plain = rf'[^"\r\n{re.escape(delim[0])}]'
        self.bare = re.compile(rf'((?:{plain}|(?!{d}|{end})[^"])*+)(?={d}|{end}|\Z)')
        self.anchor = re.compile(anchor)

    def field(self, text: str, pos: int) -> tuple[str | None, int]:
        """The field at ``pos`` and its end, or None and the place of the error."""
        if text.startswith('"', pos):
            m = self.quoted.match(text, pos)
            return (m.group(1).replace('""', '"'), m.end()) if m else (None, pos)
        m = self.bare.match(text, pos)
        return (m.group(1), m.end()) if m else (None, text.index('"', pos))

    def record(self, text: str, pos: int) -> tuple[list[str], int, int | None]:
        """Fields, end, and the place of a quoting error if there is one."""
        fields: list[str] = []
        while True:
            value, at = self.field(text, pos)
            if value is None:
                return fields, self.resume(text, at), at
            fields.append(value)
            if not text.startswith(self.delim, at):
                return fields, at, None
            pos = at + self.width

    def resume(self, text: str, at: int) -> int:
        m = self.anchor.search(text, at)
        return m.start() if m else len(text)

    def records(self, text: str) -> Iterator[tuple[int, list[str], int | None]]:
        """(start, fields, error place) of each record of the text."""
        pos = 0
        while True:
            fields, end, error = self.record(text, pos)
            yield pos, fields, error
            m = self.break_.match(text, end)
            if end >= len(text) or not m or m.end() >= len(text):
                return
            pos = m.end()


@lru_cache(64)
def parser(delim: str) -> RecordParser:
    return RecordParser(delim)


def parse_records(raw: DataFrame) -> DataFrame:
    """``line_id, record_start, fields, error_at``: every record of each row's text, resuming after broken quotes.

    ``record_start`` and ``error_at`` are 0-based places in the text; most
    texts are one record.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = [
                (line, start, fields, error)
                for line, text, delim in zip(pdf["line_id"], pdf["line_text"], pdf["delim"])
                for start, fields, error in ([(0, [], None)] if text is None else parser(delim or ",").records(text))
            ]
            cols = list(zip(*out)) if out else [[], [], [], []]
            yield pd.DataFrame({"line_id": list(cols[0]), "record_start": list(cols[1]), "fields": list(cols[2]), "error_at": pd.array(list(cols[3]), dtype="Int32")})

    ship(raw.sparkSession)
    kind = raw.schema["line_id"].dataType.simpleString()
    return raw.select("line_id", "line_text", "delim").mapInPandas(run, f"line_id {kind}, record_start int, fields array<string>, error_at int")


def judged(parsed: DataFrame) -> DataFrame:
    """Adds ``reason`` (null for valid rows) and the trimmed, typed parts."""
    f = F.transform("fields", lambda x: F.trim(x))
    df = parsed.withColumn("f", f)
    at = lambda i: F.get("f", F.lit(i))
    options = F.slice("f", 6, len(OPTION_KEYS))
    n_filled = F.size(F.filter("opts", lambda o: o != ""))
    first_empty = F.array_position("opts", "")
    gap = (first_empty > 0) & (n_filled >= first_empty)
    kind, answer = F.col("kind"), F.col("answer")
    is_choice = kind.isin(CHOICE_SINGLE, CHOICE_MULTIPLE)
    usable = F.forall(F.filter(F.split(answer, ""), lambda ch: ch != ""), lambda ch: F.array_contains(F.col("keys"), ch))
    distinct = F.size(F.array_distinct(F.filter(F.split(answer, ""), lambda ch: ch != "")))
    answer_ok = (
        F.when(kind == CHOICE_SINGLE, (F.length(answer) == 1) & usable)
        .when(kind == CHOICE_MULTIPLE, (F.length(answer) >= 2) & (distinct == F.length(answer)) & usable)
        .when(kind == JUDGE, answer.isin(*JUDGE_ANSWERS))
        .when(kind == FILL, answer != "")
        .otherwise(True)
    )
    row_ok = at(0).rlike(r"^[1-9][0-9]{0,6}\z") & F.try_element_at("f", F.lit(1)).try_cast("int").between(2, 1048576)
    df = df.withColumns({"opts": options, "kind": at(1), "answer": at(14)})
    df = df.withColumn("keys", F.filter(F.transform("opts", lambda o, i: F.when(o != "", F.substring(F.lit(OPTION_KEYS), i + 1, F.lit(1)))), lambda k: k.isNotNull()))
    wrong = (
        F.col("error_at").isNotNull(),
        F.size("f") != COLUMNS,
        ~row_ok,
        gap | (is_choice & (n_filled < 2)) | (~is_choice & (n_filled > 0)),
        ~answer_ok,
    )
    reason = F.lit(None).cast("string")
    for name, found in reversed(list(zip(REASONS, wrong))):
        reason = F.when(found, name).otherwise(reason)
    return df.withColumn("reason", reason)


def rejected(raw: DataFrame) -> DataFrame:
    """``line_id, reason`` of the lines set apart: the first reason of their first record that has one."""
    bad = judged(parse_records(raw)).filter(F.col("reason").isNotNull())
    # Place and reason in one number: few rows, hashed, not sorted.
    first = bad.select("line_id", (F.col("record_start").cast("bigint") * len(REASONS) + F.array_position(F.lit(list(REASONS)), F.col("reason")) - 1).alias("at"))
    return first.groupBy("line_id").agg(F.min("at").alias("at")).select("line_id", F.get(F.lit(list(REASONS)), (F.col("at") % len(REASONS)).cast("int")).alias("reason"))


def located(raw: DataFrame) -> DataFrame:
    """``line_id, record_start, error_at, reason`` of every record, valid ones with a null reason."""
    return judged(parse_records(raw)).select("line_id", "record_start", "error_at", "reason")


def accepted(raw: DataFrame) -> DataFrame:
    """The valid records as typed question rows."""
    df = judged(parse_records(raw)).filter(F.col("reason").isNull())
    at = lambda i: F.get("f", F.lit(i))
    options = F.transform("keys", lambda k, i: F.struct(k.alias("key"), F.get("opts", i).alias("text")))
    answers = F.when(F.col("kind").isin(CHOICE_SINGLE, CHOICE_MULTIPLE), F.filter(F.split("answer", ""), lambda ch: ch != "")).otherwise(F.array("answer"))
    return df.select(
        "line_id",
        at(0).cast("int").alias("source_row"),
        F.col("kind").alias("type"),
        at(2).alias("difficulty"),
        at(3).alias("category"),
        at(4).alias("stem"),
        options.alias("options"),
        answers.alias("answers"),
        at(15).alias("source"),
        F.lower(at(16)).isin("是", "true", "1", "yes").alias("lifesaving"),
        at(17).alias("note"),
    )
