"""Datasets as JSON bundles with a manifest, snapshots as Parquet, and the template sheet.

All paths are those of any storage Spark reads and writes.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quillforge import model
from quillforge.operators.export import COLUMNS, SHEET
from quillforge.operators.library import Library, refresh_bundled
from quillforge.session import hadoop
from quillforge.sources.xlsx import write_workbook

DEMO_VERSION = "demo"
SCHEMA_VERSION = 1
#: Bytes handed to the storage at once.
BLOCK = 1 << 20


def _camel(name: str) -> str:
    first, *more = name.split("_")
    return first + "".join(w.capitalize() for w in more)


def _published(ddl: str) -> StructType:
    """The schema of a relation as a bundle spells its fields."""
    out = StructType()
    for f in StructType.fromDDL(ddl):
        out.add(_camel(f.name), f.dataType)
    return out


def _stored(df: DataFrame, ddl: str) -> DataFrame:
    return df.select(*(F.col(_camel(f.name)).alias(f.name) for f in StructType.fromDDL(ddl)))


def read_bundle(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(banks, questions) of a JSON bundle ``{schemaVersion, sourceVersion, generatedAt, banks, questions}``."""
    parts = ((k, ddl, _published(ddl)) for k, ddl in (("banks", model.BANK), ("questions", model.QUESTION)))
    parts = list(parts)
    schema = "schemaVersion int, sourceVersion string, generatedAt string, " + ", ".join(f"{k} array<{t.simpleString()}>" for k, _, t in parts)
    doc = spark.read.schema(schema).json(path, multiLine=True)
    banks, questions = (_stored(doc.select(F.inline(k)), ddl) for k, ddl, _ in parts)
    return banks, questions


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file, or None where there is none."""
    fs, at = hadoop(spark, path)
    if not fs.exists(at):
        return None
    # Other programs replace such files without the checksum beside them; an instance of its own is told not to look.
    own = spark._jvm.org.apache.hadoop.fs.FileSystem.newInstance(fs.getUri(), spark._jsc.hadoopConfiguration())
    try:
        own.setVerifyChecksum(False)
        return spark._jvm.org.apache.commons.io.IOUtils.toString(own.open(at), "UTF-8")
    finally:
        own.close()


def write_text(spark: SparkSession, path: str, parts) -> None:
    """Texts one after the other into one file, in blocks."""
    fs, at = hadoop(spark, path)
    out = fs.create(at, True)
    held, size = [], 0
    for part in parts:
        data = part.encode("utf-8")
        held.append(data)
        size += len(data)
        if size >= BLOCK:
            out.write(bytearray(b"".join(held)))
            held, size = [], 0
    out.write(bytearray(b"".join(held)))
    out.close()


def manifest_version(spark: SparkSession, path: str) -> str:
    """The version a manifest names; the demo's where the file is missing, is no JSON or names none."""
    try:
        return str(json.loads(read_text(spark, path) or "")["sourceVersion"] or DEMO_VERSION)
    except (ValueError, KeyError, TypeError):
        return DEMO_VERSION


def load_dataset(spark: SparkSession, folder: str) -> tuple[str, DataFrame, DataFrame]:
    """(version, banks, questions) of a published folder, or the demo dataset without a manifest."""
    version = manifest_version(spark, f"{folder}/manifest.json")
    return (version, *(model.demo_dataset(spark) if version == DEMO_VERSION else read_bundle(spark, f"{folder}/questions.json")))


def refreshed(spark: SparkSession, stored: Library, stored_version: str | None, folder: str) -> tuple[Library, str]:
    """What opening the store gives: the library as it is if the published version is the stored one, else brought up to it; and the version to store with it."""
    version = manifest_version(spark, f"{folder}/manifest.json")
    if version == stored_version:
        return stored, version
    _, banks, questions = load_dataset(spark, folder)
    return refresh_bundled(stored, banks, questions), version


def write_bundle(banks: DataFrame, questions: DataFrame, folder: str, version: str, generated_at: str = "") -> None:
    """A dataset published as one file, written row by row; large ones are written as Parquet snapshots."""
    spark = banks.sparkSession
    counts = {}

    def rows(name: str, df: DataFrame):
        published = df.select(F.to_json(F.struct(*(F.col(c).alias(_camel(c)) for c in df.columns)), {"ignoreNullFields": "false"}))
        n = 0
        for n, r in enumerate(published.toLocalIterator(), 1):
            yield ("," if n > 1 else "") + r[0]
        counts[name] = n

    def whole():
        yield json.dumps({"schemaVersion": SCHEMA_VERSION, "sourceVersion": version, "generatedAt": generated_at}, ensure_ascii=False)[:-1]
        for name, df in (("banks", banks), ("questions", questions)):
            yield f', "{name}": ['
            yield from rows(name, df)
            yield "]"
        yield "}"

    write_text(spark, f"{folder}/questions.json", whole())
    manifest = {"schemaVersion": SCHEMA_VERSION, "sourceVersion": version, "bankCount": counts["banks"], "questionCount": counts["questions"]}
    write_text(spark, f"{folder}/manifest.json", [json.dumps(manifest)])


def archive_versions(spark: SparkSession, path: str) -> DataFrame:
    """``path, version`` of archives: the beginning of their SHA-1 and the schema's number."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", F.concat(F.substring(F.sha1("content"), 1, 16), F.lit(f".schema{SCHEMA_VERSION}")).alias("version"))


def write_snapshot(df: DataFrame, base: str, partition_by: str | None = None, keep: bool = True) -> str:
    """Writes a relation to a fresh path below ``base``, then points ``base/current`` at it in one step; without ``keep`` the one before is deleted."""
    spark = df.sparkSession
    before = read_text(spark, f"{base}/current")
    target = f"{base}/{uuid.uuid4().hex}"
    writer = df.write
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(target)
    write_text(spark, f"{base}/current.tmp", [target])
    jvm, hadoop_fs = spark._jvm, spark._jvm.org.apache.hadoop.fs
    how = spark.sparkContext._gateway.new_array(getattr(hadoop_fs, "Options$Rename"), 1)
    how[0] = getattr(hadoop_fs, "Options$Rename").OVERWRITE
    fs, at = hadoop(spark, f"{base}/current")
    context = hadoop_fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(jvm.org.apache.hadoop.fs.Path(f"{base}/current.tmp"), at, how)
    if before and not keep:
        fs.delete(hadoop(spark, before)[1], True)
    return target


def read_snapshot(spark: SparkSession, base: str, key: tuple[str, str] | None = None) -> DataFrame:
    """The current snapshot; with ``key`` (partition column, value) only that partition is read."""
    at = read_text(spark, f"{base}/current")
    if at is None:
        raise FileNotFoundError(f"{base}/current")
    df = spark.read.parquet(at)
    return df.filter(F.col(key[0]) == key[1]) if key else df


TEMPLATE_ROWS = (
    ("单选题", "简单", "四则运算", "6 + 3 等于几？", "8", "9", "10", "11", "", "", "", "", "", "B", "示例", "否", ""),
    ("多选题", "中等", "四则运算", "哪些数小于 5？", "2", "4", "7", "8", "", "", "", "", "", "AB", "示例", "否", ""),
    ("判断题", "简单", "四则运算", "7 比 4 大。", "", "", "", "", "", "", "", "", "", "正确", "示例", "否", ""),
    ("填空题", "简单", "四则运算", "2 + 3 = ____。", "", "", "", "", "", "", "", "", "", "5", "示例", "是", "一空一答"),
)


def write_template(path: str) -> None:
    """A workbook with the standard columns and one example of each kind."""
    write_workbook(path, SHEET, list(COLUMNS), TEMPLATE_ROWS)
