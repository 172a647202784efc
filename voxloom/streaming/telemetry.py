"""Streaming forms of the telemetry operators, over files that appear in a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.telemetry import device_maxima

SAMPLES = "timestamp string, gpu_index string, memory_used_mib string, memory_total_mib string, utilization_percent string, temperature_celsius string, power_watts string"


def samples(spark: SparkSession, folder: str) -> DataFrame:
    """Device samples from CSV files; malformed rows keep the columns they have."""
    return spark.readStream.schema(SAMPLES).option("header", "true").option("mode", "PERMISSIVE").csv(folder)


def running_maxima(stream: DataFrame) -> DataFrame:
    """State is one row per device."""
    return device_maxima(stream, "gpu_index", memory="memory_used_mib", utilization="utilization_percent")


def table_stream(spark: SparkSession, folder: str, table: str, schema) -> DataFrame:
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{table}.parquet").parquet(folder)


def log_metrics(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """``(step, metric)`` from log lines as they come; a record must stand on one line."""
    lines = spark.readStream.text(folder)
    return lines.select(F.regexp_extract("value", pattern, 1).try_cast("long").alias("step"), F.regexp_extract("value", pattern, 2).try_cast("double").alias("metric")).filter("step is not null")


def windowed_counts(events: DataFrame, late: str = "10 minutes", size: str = "1 hour") -> DataFrame:
    """Events per type and window; state of windows older than the watermark goes."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", size), "event_type").agg(F.count("*").alias("events"), F.sum("value").alias("value"))


def drained(result: DataFrame, name: str, checkpoint: str, mode: str = "complete") -> DataFrame:
    """Process what is there and return the result, for bounded inputs and tests. Each micro-batch is written below the checkpoint's folder, once
    however often it is tried; of complete results the last one counts. Nothing is held on the driver."""
    out, done = f"{checkpoint}/result", []

    def write(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/n={n}")
        done.append(n)

    query = result.writeStream.outputMode(mode).queryName(name).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()
    query.awaitTermination()
    spark = result.sparkSession
    if not done:
        return spark.createDataFrame([], result.schema)
    return spark.read.schema(result.schema).parquet(*[f"{out}/n={n}" for n in (done[-1:] if mode == "complete" else sorted(set(done)))])
