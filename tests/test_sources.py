import json
import zipfile

import pytest
from pyspark.sql import functions as F

from quillforge import model
from quillforge.functions import text as T
from quillforge.operators import export, ingest, library
from quillforge.sources import datasets, xlsx


def raw_workbook(path, sheets, strings=(), sheet_xml=None):
    """A workbook of named sheets with given XML; ``sheets``: (name, state, rows XML)."""
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns:r="{rel}"><sheets>' + "".join(f'<sheet name="{n}" state="{s}" sheetId="{i}" r:id="r{i}"/>' for i, (n, s, _) in enumerate(sheets, 1)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", "<Relationships>" + "".join(f'<Relationship Id="r{i}" Target="worksheets/s{i}.xml"/>' for i in range(1, len(sheets) + 1)) + "</Relationships>")
        if strings:
            z.writestr("xl/sharedStrings.xml", "<sst>" + "".join(f"<si>{s}</si>" for s in strings) + "</sst>")
        for i, (_, _, rows) in enumerate(sheets, 1):
            z.writestr(f"xl/worksheets/s{i}.xml", f"<worksheet><sheetData>{rows}</sheetData></worksheet>")


def cells(row, values):
    return f'<row r="{row}">' + "".join(f'<c r="{xlsx.letters_of(c)}{row}" t="inlineStr"><is><t>{v}</t></is></c>' for c, v in values.items()) + "</row>"


def test_cells_strings_and_hidden_sheets(spark, tmp_path):
    rows = '<row r="2"><c r="A2" t="s"><v>1</v></c><c t="b"><v>1</v></c><c r="D2"/><c><v>3.50</v></c><c r="XFB2"><v>9</v></c></row><row r="3"/><row><c><v>x</v></c></row>'
    raw_workbook(tmp_path / "a.xlsx", [("one", "visible", rows), ("two", "hidden", cells(1, {1: "no"}))], ["<t>zero</t>", "<r><t>on</t></r><r><t>e&amp;</t></r>"])
    (tmp_path / "~$a.xlsx").write_text("lock")
    got = [(r.sheet, r.row_num, r.cells) for r in xlsx.read_workbooks(spark, str(tmp_path)).collect()]
    assert got == [("one", 2, {1: "one&", 2: "TRUE", 5: "3.50"}), ("one", 0, {1: "x"})]
    assert [s[1:4:2] for s in xlsx.sheet_catalogue(str(tmp_path / "a.xlsx"))] == [("one", True), ("two", False)]


def test_guardrails(spark, tmp_path):
    raw_workbook(tmp_path / "a.xlsx", [("one", "visible", cells(1, {1: "a"}) + cells(2, {1: "b"}))])
    with pytest.raises(Exception, match="too many rows"):
        xlsx.read_workbooks(spark, str(tmp_path), max_rows="1").collect()
    with pytest.raises(Exception, match="too large"):
        xlsx.read_workbooks(spark, str(tmp_path), max_entry_mb="0").collect()
    raw_workbook(tmp_path / "a.xlsx", [("one", "hidden", cells(1, {1: "a"}))])
    with pytest.raises(Exception, match="no visible sheet"):
        xlsx.read_workbooks(spark, str(tmp_path)).collect()
    with zipfile.ZipFile(tmp_path / "a.xlsx", "w") as z:
        z.writestr("xl/_rels/workbook.xml.rels", "<!DOCTYPE x><Relationships/>")
    with pytest.raises(Exception, match="document type"):
        xlsx.read_workbooks(spark, str(tmp_path)).collect()


def test_archive(spark, tmp_path):
    datasets.write_template(str(tmp_path / "t.xlsx"))
    with zipfile.ZipFile(tmp_path / "all.zip", "w") as z:
        z.write(tmp_path / "t.xlsx", "b/题库.xlsx")
        z.writestr("readme.txt", "x")
    got = xlsx.read_workbooks(spark, str(tmp_path), archive="true", encoding="utf-8")
    assert {r.file for r in got.select("file").collect()} == {"b/题库.xlsx"} and got.count() == 5


def test_template_round_trip(spark, tmp_path):
    datasets.write_template(str(tmp_path / "模板.xlsx"))
    got = ingest.import_rows(xlsx.read_workbooks(spark, str(tmp_path)))
    rows = got.questions.orderBy("source_row").collect()
    assert ["".join(r.answers) for r in rows] == ["B", "AB", "T", "5"]
    assert [r.answer_mode for r in rows] == ["single", "multiple", "judge", "fill"]
    graded = got.questions.select(T.is_correct(F.col("answer_mode"), F.col("answers"), F.col("answers")).alias("ok")).collect()
    assert all(r.ok for r in graded)
    assert rows[0].bank_id == spark.range(1).select(T.bank_id(F.lit("模板")).alias("x")).first().x


def test_context_repeated_header_and_warnings(spark, tmp_path):
    head = dict(enumerate(["题型", "难度", "类别", "试题内容", "A", "B", "正确答案", "备注"], 3))
    body = (
        cells(1, {3: "title"})
        + cells(2, head)
        + cells(3, {3: "案例题", 6: "context"})
        + cells(4, {3: "案例题", 6: "sub", 7: "A. x", 8: "B、y", 9: "A"})
        + cells(5, head)
        + cells(6, {3: "判断题", 6: "stem", 7: "A、错误", 8: "B、正确", 9: "B"})
        + cells(7, {3: "单选题", 6: "no answer", 7: "x", 8: "y"})
    )
    raw_workbook(tmp_path / "b.xlsx", [("notes", "visible", cells(1, {1: "only text"})), ("s", "visible", body)])
    got = ingest.import_rows(xlsx.read_workbooks(spark, str(tmp_path)))
    rows = {r.stem: r for r in got.questions.collect()}
    assert set(rows) == {"sub", "stem"}
    assert rows["sub"].case_context == "context" and rows["sub"].type == "案例题" and [o.text for o in rows["sub"].options] == ["x", "y"]
    assert rows["stem"].case_context == "" and rows["stem"].answers == ["T"]
    assert [r.source_row for r in got.rejected.collect()] == [7]
    assert [r.sheet for r in got.without_header.collect()] == ["notes"]


def test_bundle_and_snapshot(spark, tmp_path):
    version, banks, questions = datasets.load_dataset(spark, str(tmp_path))
    assert version == "demo" and banks.count() == 1 and questions.count() == 4
    assert questions.select(T.is_correct(F.col("answer_mode"), F.col("answers"), F.col("answers")).alias("ok")).filter("ok").count() == 4
    datasets.write_bundle(banks, questions, str(tmp_path), "v2")
    version, b2, q2 = datasets.load_dataset(spark, str(tmp_path))
    assert version == "v2" and b2.exceptAll(banks).count() == 0 and q2.exceptAll(questions).count() == 0 and q2.count() == 4
    manifest = json.loads((tmp_path / "manifest.json").read_text())
    assert manifest == {"schemaVersion": 1, "sourceVersion": "v2", "bankCount": 1, "questionCount": 4}
    doc = json.loads((tmp_path / "questions.json").read_text())
    assert doc["questions"][0].keys() >= {"bankId", "sourceRow", "answerMode", "caseContext"} and doc["banks"][0]["questionCount"] == 4
    store = library.Library(banks, questions, spark.createDataFrame([], model.PROGRESS))
    assert datasets.refreshed(spark, store, "v2", str(tmp_path))[0] is store
    again, stored_version = datasets.refreshed(spark, store, "demo", str(tmp_path))
    assert stored_version == "v2" and again.questions.count() == 4
    datasets.write_snapshot(questions, str(tmp_path / "store"), "bank_id")
    assert datasets.read_snapshot(spark, str(tmp_path / "store")).count() == 4
    (tmp_path / "manifest.json").write_text("<html>")
    assert datasets.manifest_version(spark, str(tmp_path / "manifest.json")) == "demo"


def question(i, bank):
    return (i, bank, 2, "单选题", "single", "", "", f"stem {i}", [("A", "x")], ["A"], "", False, "", "")


def store(spark):
    banks = spark.createDataFrame([("b1", "one", "", 2, [], [], "2024-01-01", "bundled"), ("up", "two", "", 1, [], [], "2024-01-01", "upload")], model.BANK)
    questions = spark.createDataFrame([question("keep", "b1"), question("remove", "b1"), question("mine", "up")], model.QUESTION)
    progress = spark.createDataFrame([(i, 1, 0, 1, None, False) for i in ("keep", "remove", "mine")], model.PROGRESS)
    return library.Library(banks, questions, progress)


def ids(df, c):
    return sorted(r[0] for r in df.select(c).collect())


def test_refresh_replace_delete(spark):
    lib = store(spark)
    new = spark.createDataFrame([question("keep", "b1"), question("new", "b1"), question("theirs", "up")], model.QUESTION)
    got = library.refresh_bundled(lib, lib.banks, new)
    assert ids(got.questions, "id") == ["keep", "mine", "new"] and ids(got.progress, "question_id") == ["keep", "mine"] and ids(got.banks, "id") == ["b1", "up"]
    moved = spark.createDataFrame([question("keep", "b2")], model.QUESTION)
    assert ids(library.refresh_bundled(lib, lib.banks.limit(0), moved).progress, "question_id") == ["mine"]
    one = lib.banks.filter("id = 'b1'")
    got = library.replace_banks(lib, one, new.filter("bank_id = 'b1'"))
    assert ids(got.progress, "question_id") == ["keep", "mine"] and got.banks.filter("id = 'b1'").first().origin == "upload"
    got = library.delete_banks(lib, spark.createDataFrame([("b1",)], "bank_id string"))
    assert ids(got.questions, "id") == ["mine"] and ids(got.progress, "question_id") == ["mine"] and ids(got.banks, "id") == ["up"]


def test_a_new_question_takes_the_place_of_one_in_another_bank(spark):
    lib = store(spark)
    got = library.replace_banks(lib, lib.banks.filter("id = 'b1'"), spark.createDataFrame([question("mine", "b1")], model.QUESTION))
    assert [(r.id, r.bank_id) for r in got.questions.collect()] == [("mine", "b1")]


def sheet_of(spark, *lines):
    rows = [("f.xlsx", "s", n, {i: t for i, t in enumerate(line, 1) if t}) for n, line in enumerate(lines, 1)]
    return spark.createDataFrame(rows, "file string, sheet string, row_num int, cells map<int,string>")


def test_template_headers_and_repeated_options(spark):
    head = ("题型", "难易度", "知识类别", "题干", "A", "B", "A", "答案", "出自规范", "是否保命题", ingest.NOTE_HEADER)
    rows = sheet_of(spark, head, ("单选题", "易", "类", "题", "first", "b", "last", "A", "规范1", "yes", "note"))
    assert ingest.sheet_headers(rows).first().score == 17
    r = ingest.import_rows(rows).questions.first()
    assert [(o.key, o.text) for o in r.options] == [("A", "last"), ("B", "b")] and (r.source, r.lifesaving, r.note) == ("规范1", True, "note")
    strict = ingest.import_rows(rows, strict=True).questions.first()
    assert not strict.lifesaving and strict.source == "规范1"
    other = sheet_of(spark, ("类型", "难度", "类别", "题目", "A", "B", "答案"), ("单选题", "易", "类", "题", "A. x", "b", "A"))
    assert ingest.import_rows(other, strict=True).questions.count() == 0 and ingest.import_rows(other).questions.first().options[0].text == "x"


def test_compatible_forms_match(spark):
    rows = sheet_of(spark, ("题型", "题干", "A", "B", "答案"), ("单选题", "题", "5㎏", "5㎡", "5 kg"))
    assert ingest.import_rows(rows).questions.first().answers == ["A"]


def test_first_two_warnings_of_a_failed_file(spark):
    rows = sheet_of(spark, ("题型", "题干", "A", "B", "答案"), *[("单选题", f"题{i}", "x", "y", "") for i in range(12)])
    got = ingest.failed_files(ingest.import_rows(rows), rows).first()
    assert (got.first_warning, got.second_warning) == ("s 2 no usable answer", "s 3 no usable answer")


def test_rekeying(spark):
    q = spark.createDataFrame([question("q1", "b1")], model.QUESTION)
    assert library.copied(q, q, "s")[1].first().id == "q1-s"
    assert tuple(library.rekeyed(q, F.lit("b1"), F.lit("b1-s")).select("id", "bank_id").first()) == ("q1-s", "b1-s")
    assert tuple(library.rekeyed(q, F.lit("b1"), F.lit("other")).select("id", "bank_id").first()) == ("q1", "other")


def test_missing_options_and_differences(spark):
    q = spark.createDataFrame([question("a", "b")[:9] + (["A", "C"], "", False, "", ""), question("c", "b")], model.QUESTION)
    assert [tuple(r) for r in export.missing_options(q).collect()] == [("a", "C")]
    other = q.withColumn("note", F.when(F.col("id") == "a", "x").otherwise(F.col("note")))
    assert [tuple(r) for r in export.differences(q, other, "id", export.COMPARED).collect()] == [("a", "note")]
