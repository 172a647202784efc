"""Manifests typed by reviewers: deciding rows, progress, cut lists, comparisons of key sets, queues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from .audit import latest, ranged


def deciding_rows(manifest: DataFrame) -> DataFrame:
    """The latest review of each record."""
    return latest(manifest, ["review_id"], "reviewed_at")


def progress(manifest: DataFrame) -> DataFrame:
    """Rows per decision as typed, trimmed and in lower case; blank and null ones are pending."""
    decision = text.safe_string(F.lower("final_decision"), "pending")
    return manifest.groupBy("source", decision.alias("decision")).agg(F.count("*").alias("count"))


def default_trim(duration: Column, leading: Column, trailing: Column) -> Column:
    """``struct(start, end)`` that cuts the silent edges off."""
    start = F.round(F.greatest(F.lit(0.0), leading), 3)
    return F.struct(start.alias("start"), F.round(F.greatest(start, duration - trailing), 3).alias("end"))


def trim_is_valid(start: Column, end: Column, duration: Column) -> Column:
    """``0 <= start < end <= duration``, with a millisecond's tolerance; unreadable numbers are invalid."""
    return F.coalesce((start >= 0) & (start < end) & (end <= duration + 1e-3), F.lit(False))


def cut_list_is_valid(cuts: Column, duration: Column) -> Column:
    """Ascending, without repeats or unreadable items, inside the recording."""
    inside = F.forall(cuts, lambda x: x.isNotNull() & (x > 0) & (x < duration))
    return F.coalesce((F.size(cuts) > 0) & inside & (F.array_sort(F.array_distinct(cuts)) == cuts), F.lit(False))


def key_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """``(key, side)`` of keys that only one side holds."""
    a, b = left.select(key).distinct(), right.select(key).distinct()
    return a.join(b, key, "left_anti").withColumn("side", F.lit("left")).unionByName(b.join(a, key, "left_anti").withColumn("side", F.lit("right")))


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("rows")).filter("rows > 1")


def foreign_values(df: DataFrame, column: str, allowed: list[str]) -> DataFrame:
    """Values outside a domain, with their rows; null counts as ''."""
    value = F.coalesce(F.col(column), F.lit(""))
    return df.filter(~value.isin(allowed)).groupBy(value.alias("value")).agg(F.count("*").alias("rows"))


def require_columns(df: DataFrame, needed: list[str]) -> DataFrame:
    missing = [c for c in needed if c not in df.columns]
    if missing:
        raise ValueError(f"columns are missing: {', '.join(missing)}")
    return df


def require_splits(df: DataFrame, splits: tuple[str, ...] = ("train", "validation", "test")) -> DataFrame:
    """``(source, split)`` that a source ought to have and hasn't."""
    have = df.select("source", "split").distinct()
    needed = df.select("source").distinct().select("source", F.explode(F.array(*map(F.lit, splits))).alias("split"))
    return needed.join(have, ["source", "split"], "left_anti")


def review_queue(manifest: DataFrame) -> DataFrame:
    """Rows still open, in order of work. The row index orders as a number."""
    return manifest.filter("suggested_decision <> 'keep'").orderBy("priority", "source", "split", "row_index")


def pending_rows(manifest: DataFrame, source: str | None = None, split: str | None = None) -> DataFrame:
    """Rows without a decision, of one source or split if given; each test reaches the scan."""
    out = manifest.filter(F.col("source") == source) if source is not None else manifest
    out = out.filter(F.col("split") == split) if split is not None else out
    return out.filter(text.safe_string(F.col("final_decision"), "") == "")


def next_pending(queue: DataFrame) -> DataFrame:
    """Per source, for each row the following pending one in order, the first after the last.

    Rows are looked through within ranges of (source, order); of each range only its rows and its first pending one are brought together, and the rows after its last
    pending one take the first of a later range. So a source with half of all rows is no one task's work."""
    order = ["priority", "split", "row_index", "review_id"]
    pending = F.when(text.safe_string(F.col("final_decision"), "") == "", F.col("review_id"))
    placed = ranged(queue.select("source", *order, pending.alias("__p")), ["source"], order)
    first = F.min_by("__p", F.when(F.col("__p").isNotNull(), F.struct(*order)))
    ranges = placed.groupBy("source", "__range").agg(F.count("*").alias("__n"), first.alias("__first"))
    by = Window.partitionBy("source").orderBy("__range")
    later, whole = by.rowsBetween(1, Window.unboundedFollowing), by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranges = ranges.select(
        F.col("source").alias("__s"), F.col("__range").alias("__at"), F.coalesce(F.sum("__n").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"),
        F.coalesce(F.first("__first", ignorenulls=True).over(later), F.first("__first", ignorenulls=True).over(whole)).alias("__next"),
    )
    forth, back = Window.partitionBy("source", "__range").orderBy(*order), Window.partitionBy("source", "__range").orderBy(*[F.desc(c) for c in order])
    # looked at from the end, the following pending row is the last one seen: a running value, not a new frame per row
    rows = placed.withColumns({"__place": F.row_number().over(forth), "__after": F.last("__p", ignorenulls=True).over(back.rowsBetween(Window.unboundedPreceding, -1))})
    rows = rows.join(ranges, F.col("source").eqNullSafe(F.col("__s")) & (F.col("__range") == F.col("__at")))
    return rows.select("review_id", "source", (F.col("__place") + F.col("__before")).alias("place"), F.coalesce("__after", "__next").alias("next_pending"))


def missing_audio(manifest: DataFrame, audio: DataFrame) -> DataFrame:
    """Manifest rows whose recording isn't there."""
    return manifest.join(audio.select("source", "split", "row_index").distinct(), ["source", "split", "row_index"], "left_anti")


def with_audio(manifest: DataFrame, audio: DataFrame) -> DataFrame:
    """The manifest's rows with their recordings, one each; a row without a recording is an error, found when it is read."""
    marked = manifest.join(audio.withColumn("__there", F.lit(True)), ["source", "split", "row_index"], "left")
    there = F.when(F.col("__there"), F.col("source")).otherwise(F.raise_error(F.concat(F.lit("no recording for "), F.concat_ws(":", "source", "split", "row_index"))))
    return marked.withColumn("source", there).drop("__there")


def with_bounds_of_its_kind(decision: Column, trim_start: Column, trim_end: Column, boundaries: Column, trims: tuple[str, ...], segments: tuple[str, ...]) -> list[Column]:
    """A decision keeps the bounds its kind uses and loses the others: trims of decisions in ``trims``, cut points of those in ``segments``."""
    keep = lambda c, kinds: F.when(F.lower(F.trim(decision)).isin(*kinds), c)
    return [keep(trim_start, trims), keep(trim_end, trims), keep(boundaries, segments)]


def apply_decisions(rows: DataFrame, decisions: DataFrame, key: str, column: str) -> DataFrame:
    """Rows with ``column`` taken from the decisions where those have the key."""
    new = decisions.select(key, F.col(column).alias("__new"))
    return rows.join(new, key, "left").withColumn(column, F.coalesce("__new", column)).drop("__new")
