"""Sources: pinned datasets, CSV manifests, JSON reports, Hive-partitioned Parquet, logs, file inventories."""

from __future__ import annotations

import copy
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.review import require_columns

CSV = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"', "emptyValue": "", "encoding": "UTF-8", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def parquet(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def pinned(df: DataFrame, source: str, revision: str) -> DataFrame:
    """One source at one revision; both tests reach the Parquet scan."""
    return df.filter((F.col("source") == source) & (F.col("dataset_revision") == revision))


def capped(df: DataFrame, n: int) -> DataFrame:
    """The first n rows of each source and split by their stored position; the test reaches the scan."""
    return df.filter(F.col("row_index") < n)


def csv_strings(spark: SparkSession, path: str, columns: list[str] | None = None, needed: list[str] | None = None) -> DataFrame:
    """A CSV manifest with all columns as text, quoted line ends included; blank cells are ''.

    Columns are found by the names in the header, in whatever order they stand there; ``columns`` chooses some of them, and those that it or ``needed``
    names and the file lacks are an error. Files of other headers than the first are an error, too."""
    df = spark.read.options(**CSV).options(inferSchema="false", enforceSchema="false").csv(path)
    df = require_columns(df, [*(needed or []), *(columns or [])])
    return (df.select(*[f"`{c}`" for c in columns]) if columns else df).fillna("")


def json_document(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", "true").json(path)


def group_members(groups: DataFrame) -> DataFrame:
    """Distinct record keys of a report's duplicate groups."""
    return groups.select(F.explode("members").alias("m")).select("m.source", "m.split", "m.row_index").distinct()


def mixture(spark: SparkSession, root: str) -> DataFrame:
    """A Hive-partitioned mixture; filters on corpus, split and language prune directories."""
    return spark.read.parquet(root)


def whole_texts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True)


def file_inventory(spark: SparkSession, root: str) -> DataFrame:
    """Paths and sizes of all files below a folder; contents aren't read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "length")


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", F.sha2("content", 256).alias("sha256"))


def panel_examples(document: DataFrame) -> DataFrame:
    """The examples of a panel document with their place in it."""
    return document.select(F.posexplode("examples").alias("place", "example")).select("place", "example.*")


def only_candidate(folders: list[str], needed: list[str]) -> str:
    """The first of the folders, in order of preference, that holds the needed files; an error if none does,
    or if several subfolders of one do."""
    for folder in folders:
        root = Path(folder)
        found = [p for p in [root, *sorted(x for x in root.glob("*") if x.is_dir())] if p.is_dir() and all((p / n).exists() for n in needed)]
        if len(found) > 1:
            raise ValueError(f"several candidates: {', '.join(map(str, found))}")
        if found:
            return str(found[0])
    raise FileNotFoundError(f"no folder holds {', '.join(needed)}")


def overridden(config: dict, changes: dict[str, object], held: dict[str, object] | None = None) -> dict:
    """A copy of a nested configuration with values at dotted names replaced; ``held`` are values that must be as given."""
    out = copy.deepcopy(config)
    for name, value in changes.items():
        *parents, last = name.split(".")
        at = out
        for p in parents:
            at = at[p]
        if last not in at:
            raise KeyError(name)
        at[last] = value
    for name, value in (held or {}).items():
        at = out
        for p in name.split("."):
            at = at[p]
        if at != value:
            raise ValueError(f"{name} is {at!r}, not {value!r}")
    return out


def require_range(name: str, value: float, above: float, upto: float) -> float:
    if not above < value <= upto:
        raise ValueError(f"{name} must be over {above} and at most {upto}")
    return value
