"""Spreadsheet workbooks as a Spark data source, and a writer.

    register(spark)
    spark.read.format("quill_xlsx").load("folder-or-file")

One partition per workbook; rows are streamed, entries that are not needed are
never opened.  Options: ``archive`` ("true": the paths are zip archives of
workbooks), ``encoding`` (of names in archives), ``include_hidden``,
``exclude`` (a folder to skip), ``max_entry_mb``, ``max_total_mb``,
``max_columns``, ``max_rows``.  Columns beyond the last allowed one are
dropped; larger entries or more rows raise, as does a document type
declaration.  A self-closed row is empty and does not take in its successor.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from pathlib import Path
from xml.etree import ElementTree
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from quillforge.model import SHEET_ROW
from quillforge.session import ship

# The guardrails of the reader.
LIMITS = {"max_entry_mb": 256, "max_total_mb": 512, "max_columns": 256, "max_rows": 250_000}
WORKBOOK, RELATIONS = "xl/workbook.xml", "xl/_rels/workbook.xml.rels"


class WorkbookError(ValueError):
    """A workbook that cannot or must not be read."""


def local(tag: str) -> str:
    return tag.rpartition("}")[2]


def column_of(reference: str) -> int:
    """A1 reference to column number; 0 without letters."""
    n = 0
    for ch in reference:
        if not ("A" <= ch.upper() <= "Z"):
            break
        n = n * 26 + ord(ch.upper()) - 64
    return n


def letters_of(column: int) -> str:
    out = ""
    while column:
        column, rest = divmod(column - 1, 26)
        out = chr(65 + rest) + out
    return out


def zip_path(target: str) -> str:
    """Target of a workbook relation as a path in the archive."""
    parts: list[str] = [] if target.startswith("/") else ["xl"]
    for p in target.replace("\\", "/").split("/"):
        if p == "..":
            parts = parts[:-1]
        elif p not in ("", "."):
            parts.append(p)
    return "/".join(parts)


class Workbook:
    def __init__(self, data, limits: dict[str, int]):
        self.zip = zipfile.ZipFile(data)
        self.limits = limits
        self.read_bytes = 0

    def open(self, name: str):
        try:
            info = self.zip.getinfo(name)
        except KeyError:
            raise WorkbookError(f"entry {name} is missing") from None
        if info.file_size > self.limits["max_entry_mb"] << 20:
            raise WorkbookError(f"entry {name} is too large")
        self.read_bytes += info.file_size
        if self.read_bytes > self.limits["max_total_mb"] << 20:
            raise WorkbookError("the workbook is too large")
        entry = self.zip.open(info)
        if b"<!DOCTYPE" in entry.read(4096):
            raise WorkbookError(f"entry {name} has a document type declaration")
        return self.zip.open(info)

    def tree(self, name: str):
        return ElementTree.parse(self.open(name)).getroot()

    def catalogue(self) -> list[tuple[int, str, str, bool]]:
        """(order, name, entry, visible) of the sheets that can be resolved."""
        targets = {r.get("Id"): r.get("Target") for r in self.tree(RELATIONS).iter() if local(r.tag) == "Relationship"}
        out = []
        for i, s in enumerate(x for x in self.tree(WORKBOOK).iter() if local(x.tag) == "sheet"):
            link = next((v for k, v in s.attrib.items() if local(k) == "id" and k != "sheetId"), None)
            if targets.get(link):
                out.append((i, s.get("name") or f"Sheet{i + 1}", zip_path(targets[link]), s.get("state", "visible") == "visible"))
        return out

    def strings(self) -> list[str]:
        """Shared strings: all text of each entry, read once."""
        name = "xl/sharedStrings.xml"
        if name not in self.zip.namelist():
            return []
        out = []
        for _, e in ElementTree.iterparse(self.open(name)):
            if local(e.tag) == "si":
                out.append(_texts(e))
                e.clear()
        return out

    def rows(self, entry: str, strings: list[str]) -> Iterator[tuple[int, int, dict[int, str]]]:
        """(ordinal, row number, cells) of the rows that have a value."""
        n = 0
        for _, row in ElementTree.iterparse(self.open(entry)):
            if local(row.tag) != "row":
                continue
            cells, column = {}, 0
            for c in row:
                if local(c.tag) != "c":
                    continue
                column = column_of(c.get("r", "")) or column + 1
                value = self.cell(c, strings)
                if value and column <= self.limits["max_columns"]:
                    cells[column] = value
            number = row.get("r", "0")
            if cells:
                if n >= self.limits["max_rows"]:
                    raise WorkbookError("a sheet has too many rows")
                yield n, int(number) if number.isdigit() else 0, cells
                n += 1
            row.clear()

    def cell(self, c, strings: list[str]) -> str:
        kind = c.get("t")
        if kind == "inlineStr":
            return _texts(c)
        value = next((v.text or "" for v in c if local(v.tag) == "v"), "")
        if kind == "s":
            i = int(value) if value.isdigit() else -1
            return strings[i] if 0 <= i < len(strings) else ""
        if kind == "b":
            return "TRUE" if value == "1" else "FALSE"
        return value


def _texts(e) -> str:
    return "".join(t.text or "" for t in e.iter() if local(t.tag) == "t")


def discover(path: str, suffix: str, exclude: str | None = None) -> list[str]:
    """Files below a folder in order of name, without lock files and the excluded folder."""
    root = Path(path)
    if root.is_file():
        return [str(root)]
    skip = Path(exclude).resolve() if exclude else None
    return sorted(str(p) for p in root.rglob(f"*{suffix}") if not p.name.startswith("~$") and not (skip and skip in p.resolve().parents))


class File(InputPartition):
    def __init__(self, path: str, member: str | None = None):
        super().__init__((path, member))
        self.path, self.member = path, member


class XlsxReader(DataSourceReader):
    def __init__(self, options):
        self.paths = [p for p in options.get("path", "").split(",") if p]
        self.archive = options.get("archive", "false").lower() == "true"
        self.encoding = options.get("encoding", "gbk")
        self.hidden = options.get("include_hidden", "false").lower() == "true"
        self.exclude = options.get("exclude")
        self.limits = {k: int(options.get(k, v)) for k, v in LIMITS.items()}

    def partitions(self):
        if not self.archive:
            return [File(f) for p in self.paths for f in discover(p, ".xlsx", self.exclude)]
        out = []
        for p in self.paths:
            for f in discover(p, ".zip", self.exclude):
                with zipfile.ZipFile(f, metadata_encoding=self.encoding) as z:
                    out += [File(f, n) for n in sorted(z.namelist()) if n.lower().endswith(".xlsx") and not Path(n).name.startswith("~$")]
        return out

    def read(self, partition):
        data = partition.path
        name = partition.path
        if partition.member:
            with zipfile.ZipFile(partition.path, metadata_encoding=self.encoding) as z:
                if z.getinfo(partition.member).file_size > self.limits["max_total_mb"] << 20:
                    raise WorkbookError("the workbook is too large")
                data, name = io.BytesIO(z.read(partition.member)), partition.member
        book = Workbook(data, self.limits)
        sheets = [s for s in book.catalogue() if s[3] or self.hidden]
        if not sheets:
            raise WorkbookError(f"{name}: no visible sheet")
        strings = book.strings()
        for order, sheet, entry, _ in sheets:
            for n, number, cells in book.rows(entry, strings):
                yield name, sheet, order, n, number, cells


class Written(WriterCommitMessage):
    def __init__(self, path: str):
        self.path = path


class XlsxWriter(DataSourceWriter):
    """Each partition becomes one workbook with a header row; a folder of workbooks is the result."""

    def __init__(self, options, schema, overwrite: bool):
        self.folder, self.columns, self.overwrite = Path(options["path"]), schema.fieldNames(), overwrite
        self.sheet = options.get("sheet", "Sheet1")

    def write(self, rows):
        from pyspark import TaskContext

        self.folder.mkdir(parents=True, exist_ok=True)
        context = TaskContext.get()
        target = self.folder / f"part-{context.partitionId() if context else 0:05d}.xlsx"
        write_workbook(target, self.sheet, self.columns, rows)
        return Written(str(target))

    def commit(self, messages):
        kept = {m.path for m in messages if m}
        if self.overwrite:
            for p in self.folder.glob("part-*.xlsx"):
                if str(p) not in kept:
                    p.unlink()

    def abort(self, messages):
        for m in messages:
            if m:
                Path(m.path).unlink(missing_ok=True)


class XlsxSource(DataSource):
    @classmethod
    def name(cls):
        return "quill_xlsx"

    def schema(self):
        return SHEET_ROW

    def reader(self, schema):
        return XlsxReader(self.options)

    def writer(self, schema, overwrite):
        return XlsxWriter(self.options, schema, overwrite)


def write_workbook(target, sheet: str, columns: list[str], rows) -> None:
    """A workbook of one sheet: frozen header row with a filter, text cells, streamed row by row."""
    head = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    main, rel = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    package = "http://schemas.openxmlformats.org/package/2006"
    kinds = "application/vnd.openxmlformats-officedocument.spreadsheetml"
    last = letters_of(len(columns))

    def line(number: int, values) -> str:
        cells = "".join(
            f'<c r="{letters_of(i)}{number}" t="inlineStr"><is><t xml:space="preserve">{escape(_clean(str(v)))}</t></is></c>' for i, v in enumerate(values, 1) if v is not None and v != ""
        )
        return f'<row r="{number}">{cells}</row>'

    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr(
            "[Content_Types].xml",
            f'{head}<Types xmlns="{package}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
            f'<Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="{kinds}.sheet.main+xml"/>'
            f'<Override PartName="/xl/worksheets/sheet1.xml" ContentType="{kinds}.worksheet+xml"/></Types>',
        )
        z.writestr("_rels/.rels", f'{head}<Relationships xmlns="{package}/relationships"><Relationship Id="rId1" Type="{rel}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        z.writestr(WORKBOOK, f'{head}<workbook xmlns="{main}" xmlns:r="{rel}"><sheets><sheet name="{escape(sheet[:31])}" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr(RELATIONS, f'{head}<Relationships xmlns="{package}/relationships"><Relationship Id="rId1" Type="{rel}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>')
        with z.open("xl/worksheets/sheet1.xml", "w") as f:
            view = '<sheetViews><sheetView workbookViewId="0"><pane ySplit="1" topLeftCell="A2" activePane="bottomLeft" state="frozen"/></sheetView></sheetViews>'
            f.write(f'{head}<worksheet xmlns="{main}">{view}<sheetData>{line(1, columns)}'.encode())
            n = 1
            for n, row in enumerate(rows, 2):
                f.write(line(n, row).encode())
            f.write(f'</sheetData><autoFilter ref="A1:{last}{n}"/></worksheet>'.encode())


_CONTROL = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f]")


def _clean(text: str) -> str:
    return _CONTROL.sub("", text)


def register(spark) -> None:
    ship(spark)
    spark.dataSource.register(XlsxSource)


def read_workbooks(spark, path: str, **options) -> DataFrame:
    register(spark)
    return spark.read.format("quill_xlsx").options(**options).load(path)


def sheet_catalogue(path: str) -> list[tuple[int, str, str, bool]]:
    """(order, name, entry, visible) of a workbook's sheets."""
    return Workbook(path, LIMITS).catalogue()
