"""Run telemetry: device maxima, checkpoint inventories, training logs, throughput."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import matched_pairs, occurrences, parsed
from .audit import ranged

# Files a complete checkpoint holds of each kind, per device.
KINDS = ("trainer", "model", "optimizer", "data_reader")


def device_maxima(samples: DataFrame, device: str, counted: str | None = None, **measures: str) -> DataFrame:
    """The greatest of each measure per device, at least 0, and the number of samples under the name ``counted``, if given. Rows whose device isn't a number are ignored, and
    so are unreadable measures, each on its own."""
    valid = samples.filter(F.col(device).cast("string").rlike("^[0-9]+$"))
    return valid.groupBy(F.col(device).cast("long").alias("device")).agg(*[F.greatest(F.lit(0.0), F.max(parsed(F.col(c).cast("string")))).alias(n) for n, c in measures.items()], *([F.count("*").alias(counted)] if counted else []))


def log_metrics(log: DataFrame, text: str, pattern: str, *more: str) -> DataFrame:
    """``(step, metric)``, and ``more`` columns of the log, of every match in whole texts; a record may wrap over lines."""
    pairs = log.select(*more, F.explode(matched_pairs(F.col(text), pattern)).alias("p"))
    number = lambda c: F.regexp_replace(c, r"\s", "")
    return pairs.select(*more, number(F.col("p.first")).try_cast("long").alias("step"), number(F.col("p.second")).try_cast("double").alias("metric"))


def overflow_count(text: Column, phrase: str = "Overflow detected at step") -> Column:
    return occurrences(text, phrase)


def step_history(metrics: DataFrame) -> DataFrame:
    """Each step's metric with the change since the step before.

    Steps are compared within ranges of (run, step); the first of a range with the last of the range before, of which a row per run and range is kept. So
    no run, however long, is one task's work."""
    placed = ranged(metrics, ["run"], ["step"])
    last = placed.groupBy("run", "__range").agg(F.max(F.struct("step", "metric")).alias("x"))
    last = last.select(F.col("run").alias("__run"), F.col("__range").alias("__at"), F.lag("x.metric").over(Window.partitionBy("run").orderBy("__range")).alias("__before"))
    within = Window.partitionBy("run", "__range").orderBy("step")
    rows = placed.withColumns({"__lag": F.lag("metric").over(within), "__first": F.row_number().over(within) == 1})
    rows = rows.join(last, F.col("run").eqNullSafe(F.col("__run")) & (F.col("__range") == F.col("__at")))
    return rows.select(*metrics.columns, (F.col("metric") - F.when(F.col("__first"), F.col("__before")).otherwise(F.col("__lag"))).alias("change"))


# Where files of each kind stand below a step's folder are the patterns of the next function
def checkpoint_files(files: DataFrame) -> DataFrame:
    """``(step, kind, length)`` of the files under ``step_<number>``; temporary and other directories are left out."""
    step = F.regexp_extract("path", r"/step_([0-9]+)/", 1)
    kind = (
        F.when(F.col("path").rlike(r"/trainer/rank_[0-9]+\.pt$"), "trainer")
        .when(F.col("path").rlike(r"/model/.*/sdp_[0-9]+\.pt$"), "model")
        .when(F.col("path").rlike(r"/optimizer/.*/sdp_[0-9]+\.pt$"), "optimizer")
        .when(F.col("path").rlike(r"/data_reader/dp_[0-9]+\.pt$"), "data_reader")
    )
    rows = files.select(step.try_cast("long").alias("step"), kind.alias("kind"), "length", F.col("path").contains(".tmp").alias("temporary"))
    return rows.filter("step is not null and not temporary").drop("temporary")


def checkpoint_states(files: DataFrame, devices: int, kinds: tuple[str, ...] = KINDS) -> DataFrame:
    """Per step: files of each kind, bytes, and whether each kind has a file for every device."""
    counts = files.groupBy("step").agg(*[F.count_if(F.col("kind") == k).alias(k) for k in kinds], F.sum("length").alias("bytes"))
    least = F.least(*kinds) if len(kinds) > 1 else F.col(kinds[0])
    return counts.withColumn("complete", least >= devices)


def directory_sizes(files: DataFrame, depth_pattern: str = r"^(.*/step_[0-9]+)/") -> DataFrame:
    """Bytes and files below each directory that the pattern's first group names."""
    return files.withColumn("directory", F.regexp_extract("path", depth_pattern, 1)).filter("directory <> ''").groupBy("directory").agg(F.sum("length").alias("bytes"), F.count("*").alias("files"))


def resume_step(states: DataFrame) -> DataFrame:
    return states.filter("complete").agg(F.max("step").alias("step"))


def extrapolated(seconds: Column, steps: Column, targets: tuple[int, ...] = (500, 5000)) -> list[Column]:
    """Seconds per step and minutes to each target, by proportion."""
    per = F.try_divide(seconds, steps)
    return [per.alias("seconds_per_step"), *[(per * n / 60).alias(f"minutes_{n}") for n in targets]]


def exit_code(code: Column, complete: Column) -> Column:
    """A run that ended well without reaching its target counts as failed, with code 3."""
    return F.when((code != 0) | complete, code).otherwise(3)


def real_time(rows: DataFrame, seconds: str, audio_seconds: str, *keys: str) -> DataFrame:
    """Seconds of work per second of audio, and seconds of audio a second, of all rows that have both, together."""
    both = rows.filter(F.col(seconds).isNotNull() & F.col(audio_seconds).isNotNull())
    s, a = F.sum(seconds), F.sum(audio_seconds)
    return both.groupBy(*keys).agg(F.try_divide(s, a).alias("real_time_factor"), F.try_divide(a, s).alias("throughput"))


def latency(rows: DataFrame, seconds: str, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.median(seconds).alias("median"), F.percentile(seconds, 0.95).alias("p95"), F.count("*").alias("events"))
