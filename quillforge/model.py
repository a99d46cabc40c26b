"""Schemas of the question-bank relations and the built-in demo dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

OPTION = "struct<key:string,text:string>"
QUESTION = (
    "id string, bank_id string, source_row int, type string, answer_mode string, difficulty string, category string, stem string, "
    f"options array<{OPTION}>, answers array<string>, source string, lifesaving boolean, note string, case_context string"
)
BANK = "id string, name string, source_file string, question_count int, difficulties array<string>, types array<string>, imported_at string, origin string"
PROGRESS = "question_id string, attempts int, correct int, wrong int, last_answered_at string, starred boolean"
SESSION = (
    "id string, mode string, question_ids array<string>, cursor_pos int, responses map<string,array<string>>, "
    "judgements map<string,boolean>, started_at string, updated_at string"
)
SHEET_ROW = "file string, sheet string, sheet_ord int, row_ord int, row_num int, cells map<int,string>"
META = "key string, value string"
TABLES = {"question": QUESTION, "bank": BANK, "progress": PROGRESS, "practice_session": SESSION, "meta": META}


def empty(spark: SparkSession, name: str) -> DataFrame:
    """An empty relation: what opening a store without the table gives."""
    return spark.createDataFrame([], TABLES[name])


def demo_dataset(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """One bank of four questions, one per answer mode, used where no dataset is published."""
    bank = "bank-demo"
    made = [
        ("demo-1", "单选题", "single", "3 + 4 等于几？", [("A", "6"), ("B", "7"), ("C", "8")], ["B"]),
        ("demo-2", "多选题", "multiple", "下列哪些数是偶数？", [("A", "2"), ("B", "4"), ("C", "5")], ["A", "B"]),
        ("demo-3", "判断题", "judge", "9 大于 12。", [], ["F"]),
        ("demo-4", "填空题", "fill", "10 减去 5 等于 ____。", [], ["5"]),
    ]
    rows = [(i, bank, n + 2, kind, mode, "简单", "四则运算", stem, options, answers, "", False, "", "") for n, (i, kind, mode, stem, options, answers) in enumerate(made)]
    banks = [(bank, "演示题库", "demo", len(rows), ["简单"], [r[3] for r in rows], "2024-01-01T00:00:00.000Z", "bundled")]
    return spark.createDataFrame(banks, BANK), spark.createDataFrame(rows, QUESTION)
