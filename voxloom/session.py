"""Session helpers: the shared work folder, materialised stages, partition counts."""

from __future__ import annotations

import atexit
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_written: list[tuple] = []  # what reaches the file system, also after the session has stopped, and the path


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or the context's checkpoint folder. Where neither is
    set, a local one serves a single machine; on a cluster that is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="voxloom-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, removed with :func:`clean`."""
    path = f"{shared_dir(spark)}/voxloom/{name}-{uuid.uuid4().hex}"
    _written.append((spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), path))
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a stage to the shared folder and read it again.

    This cuts the lineage with a table that outlives lost executors, and a stage that several
    branches read is computed once. The tables go when the Python process ends or with
    :func:`clean`.
    """
    return df.sparkSession.read.parquet(materialized_path(df, name))


def materialized_path(df: DataFrame, name: str) -> str:
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return path


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text as one file of whatever file system the path names: whole or not at all, and never over another."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if system.exists(where):
        raise FileExistsError(path)
    part = where.suffix(f".{uuid.uuid4().hex}.part")
    out = system.create(part, False)
    out.write(bytearray(text.encode()))
    out.close()
    if not system.rename(part, where):
        system.delete(part, False)
        raise FileExistsError(path)


@atexit.register
def clean() -> None:
    """Remove what this process has written to the shared folder."""
    while _written:
        jvm, configuration, path = _written.pop()
        try:
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(configuration).delete(where, True)
        except Exception:  # the JVM may be gone at exit; the shared folder has its own life time
            pass


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, for clusters where it isn't installed."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="voxloom-")) / f"{root.name}-package.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for path in sorted(root.rglob("*.py")):
            z.write(path, path.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(target))
    _shipped.add(application)


def partitions(spark: SparkSession) -> int:
    """The session's shuffle width, for explicit repartitions ahead of stages that expand rows
    (adaptive execution would size those by their small input)."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def digest(*cols):
    """Two independent 64-bit hashes of the columns: a 128-bit key that shuffles as two longs."""
    return F.xxhash64(*cols).alias("h1"), F.xxhash64(F.lit(1), *cols).alias("h2")
