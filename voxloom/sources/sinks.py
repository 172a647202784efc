"""Sinks: CSV, TSV and JSON documents, Hive-partitioned Parquet, cards. None overwrites anything."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import partitions, write_text


def csv_table(df: DataFrame, path: str, fields: list[str], single: bool = False, allow_empty: bool = True) -> None:
    """Write the fields in order. Arrays go as ``|``-joined text; nulls as blank cells."""
    if not allow_empty and df.isEmpty():
        raise ValueError("there are no rows to write")
    kinds = dict(df.dtypes)
    columns = [F.concat_ws("|", c).alias(c) if kinds[c].startswith("array") else F.col(c) for c in fields]
    out = df.select(*columns)
    (out.coalesce(1) if single else out).write.mode("errorifexists").options(header="true", quote='"', escape='"', nullValue="", emptyValue="", ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false").csv(path)


def tsv_hours(weights: DataFrame, path: str, language: str) -> None:
    rows = weights.select("corpus", F.lit(language).alias("language"), F.format_string("%.6f", "hours").alias("hours")).orderBy("corpus", "language")
    rows.coalesce(1).write.mode("errorifexists").options(header="true", sep="\t").csv(path)


def text_document(text: str, path: str) -> None:
    """A small text as one file, on any file system the session reaches; written as a whole or not at all."""
    write_text(SparkSession.active(), path, text)


def json_document(content: dict | list, path: str) -> None:
    """A small result as one indented UTF-8 document."""
    text_document(json.dumps(content, ensure_ascii=False, indent=2), path)


def json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").json(path)


def mixture(df: DataFrame, root: str, rows_per_file: int = 100, rows_per_task: int = 20_000) -> None:
    """Parquet under ``corpus=/split=/language=``, zstd, at most rows_per_file rows a file.

    A directory's rows are counted first and spread over as many tasks as it has ``rows_per_task``, so that a corpus with a third of all
    rows isn't written by a few, and a small one not by many. The counts, a row per directory, are joined by broadcast.
    """
    keys = ["corpus", "split", "language"]
    counts = df.groupBy(*keys).agg(F.ceil(F.count("*") / rows_per_task).alias("__tasks")).collect()  # a row per directory
    tasks = df.sparkSession.createDataFrame([tuple(r) for r in counts], ", ".join(f"`__{k}` {dict(df.dtypes)[k]}" for k in keys) + ", __tasks long")
    found = df.join(F.broadcast(tasks), [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    hashed = F.xxhash64(*[c for c in df.columns if c not in keys and not dict(df.dtypes)[c].startswith("map")])
    spread = found.withColumn("__salt", F.pmod(hashed, F.col("__tasks"))).select(*df.columns, "__salt")
    (
        spread.repartition(max(partitions(df.sparkSession), sum(r["__tasks"] for r in counts)), *keys, "__salt").drop("__salt").write.mode("errorifexists").partitionBy(*keys)
        .option("compression", "zstd").option("maxRecordsPerFile", rows_per_file).parquet(root)
    )


def mixture_row_groups(df: DataFrame, root: str, rows_per_group: int = 100) -> DataFrame:
    """As :func:`mixture`, with row groups of exactly so many rows, which Spark's own writer sizes by bytes.

    Each task writes a file of its own name into the folder, a path or URI that all executors reach, a row group as soon as it is full; the paths come
    back. A repeated task replaces its file.
    """
    import pyarrow as pa
    import pyarrow.fs as fs
    import pyarrow.parquet as pq

    attempt = uuid.uuid4().hex

    def write(batches):
        from pyspark import TaskContext

        system, folder = fs.FileSystem.from_uri(root)
        task = TaskContext.get()
        path = f"{folder}/part-{task.partitionId():05d}.parquet"
        part, writer, held, rows = f"{path}.{attempt}.{task.taskAttemptId()}", None, None, 0
        for batch in batches:
            rows += batch.num_rows
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            if held.num_rows and writer is None:
                system.create_dir(folder, recursive=True)
                writer = pq.ParquetWriter(part, held.schema, filesystem=system, compression="zstd")
            whole = held.num_rows - held.num_rows % rows_per_group
            if whole:
                writer.write_table(held.slice(0, whole), row_group_size=rows_per_group)
                held = held.slice(whole)
        if writer is not None:
            if held.num_rows:
                writer.write_table(held)
            writer.close()
            system.move(part, path)
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([rows])], ["path", "rows"])

    return df.mapInArrow(write, "path string, rows long")


def row_groups(spark: SparkSession, paths: DataFrame) -> DataFrame:
    """``(path, row_group, rows)`` of Parquet files, from their footers."""
    import pyarrow as pa
    import pyarrow.fs as fs
    import pyarrow.parquet as pq

    def read(batches):
        for batch in batches:
            out = []
            for path in batch.column("path").to_pylist():
                system, at = fs.FileSystem.from_uri(path)
                meta = pq.ParquetFile(at, filesystem=system).metadata
                out += [(path, i, meta.row_group(i).num_rows) for i in range(meta.num_row_groups)]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate((pa.string(), pa.int32(), pa.int64()))], ["path", "row_group", "rows"])

    return paths.select("path").mapInArrow(read, "path string, row_group int, rows long")


def asset_card(name: str, root: str, hours: dict[str, float]) -> str:
    lines = [f"name: {name}", f"data: {root}", "corpora:"] + [f"  {c}: {h:.3f}" for c, h in sorted(hours.items())]
    return "\n".join(lines) + "\n"


def dataset_card(name: str, counts: list[dict]) -> str:
    head = f"# {name}\n\n| corpus | split | examples | hours |\n| --- | --- | --- | --- |\n"
    return head + "".join(f"| {r['corpus']} | {r['split']} | {r['examples']} | {r['hours']:.3f} |\n" for r in counts)
