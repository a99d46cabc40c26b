"""Session helpers: table access and durable intermediate results."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import warnings
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A Parquet table (file or folder) of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Makes this package importable in the Python workers of all executors, once per application.

    The driver serves the archive, so executors that join later get it too.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="quillforge-code-")
    atexit.register(shutil.rmtree, folder, True)
    target = f"{folder}/{package.name}.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    context.addPyFile(target)
    _shipped.add(context.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``.

    Only where the cluster names none (tests, one machine) a folder of this
    process is made, recorded in the session and removed at exit; a session
    with other machines than this one is warned.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            warnings.warn("spark.checkpoint.dir is not set: intermediate results go to a folder of this machine, which other machines cannot read", stacklevel=2)
        own = tempfile.mkdtemp(prefix="quillforge-")
        atexit.register(shutil.rmtree, own, True)
        base = f"file://{own}"
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def hadoop(spark: SparkSession, path: str):
    """(file system, path) of the storage a path names."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


_kept: dict[str, str] = {}


def durable(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back.

    Cuts the lineage so that a result used by several branches is computed
    once, and survives the loss of any executor.  What is left when the
    program ends is deleted; ``discard`` deletes sooner.
    """
    spark = df.sparkSession
    folder = f"{shared_dir(spark)}/quillforge-{spark.sparkContext.applicationId}"
    if folder not in _kept:
        _kept[folder] = folder
        atexit.register(_clear, spark, folder)
    path = f"{folder}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._quillforge_path = path
    return out


def discard(df: DataFrame | None) -> None:
    """Deletes a durable result that nothing will read again."""
    path = getattr(df, "_quillforge_path", None)
    if path:
        fs, at = hadoop(df.sparkSession, path)
        fs.delete(at, True)


def _clear(spark: SparkSession, folder: str) -> None:
    try:
        fs, at = hadoop(spark, folder)
        fs.delete(at, True)
    except Exception:  # the session is gone: the folder is the cluster's to clear
        pass
