"""Audit of recordings: quality flags, duplicate groups, summaries."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from ..session import materialize, partitions


@dataclass(frozen=True)
class Thresholds:
    """Limits of the quality flags, all exclusive but the silent peak's."""

    # The limits' defaults
    shortest_seconds: float = 1.0
    longest_seconds: float = 35.0
    silent_peak: float = 1e-6
    lowest_rms_dbfs: float = -45.0
    most_clipping: float = 0.001
    longest_leading: float = 1.5
    longest_trailing: float = 2.0
    lowest_words_per_second: float = 0.4
    highest_words_per_second: float = 3.5


def quality_flags(t: Thresholds = Thresholds()) -> Column:
    """Names of the flags a row of measures raises, in their fixed order. A row that couldn't be decoded has
    a decode flag in place of those on measures; null measures raise nothing."""
    c = F.col
    # Names of the flags
    measured = {
        "too_short": c("duration_seconds") < t.shortest_seconds,
        "too_long_requires_alignment": c("duration_seconds") > t.longest_seconds,
        "silent_audio": c("peak") <= t.silent_peak,
        "very_low_rms": c("rms_dbfs") < t.lowest_rms_dbfs,
        "clipping": c("clipping_fraction") > t.most_clipping,
        "long_leading_silence": c("leading_silence_seconds") > t.longest_leading,
        "long_trailing_silence": c("trailing_silence_seconds") > t.longest_trailing,
        "low_text_audio_ratio": c("words_per_second") < t.lowest_words_per_second,
        "high_text_audio_ratio": c("words_per_second") > t.highest_words_per_second,
    }
    decoded = F.coalesce(c("decode_ok"), F.lit(False))
    flags = [F.when(F.coalesce(F.trim("text_normalized"), F.lit("")) == "", "empty_normalized_text")]
    flags += [F.when(decoded & test, name) for name, test in measured.items()]
    flags.append(F.when(~decoded, "decode_error"))
    return F.filter(F.array(*flags), lambda x: x.isNotNull())


def format_actions() -> Column:
    """What has to be done to the format: other rates are resampled, more channels mixed down."""
    return F.filter(
        F.array(F.when(F.col("sample_rate") != 16000, "resample_to_16khz"), F.when(F.col("channels") != 1, "downmix_to_mono")),
        lambda x: x.isNotNull(),
    )


def severity(flags: Column) -> Column:
    """reject for what can't be used at all, review for any other flag, else accept."""
    useless = F.arrays_overlap(flags, F.array(*map(F.lit, ["decode_error", "empty_normalized_text", "silent_audio", "too_short"])))
    return F.when(useless, "reject").when(F.size(flags) > 0, "review").otherwise("accept")


def first_match(rules: list[tuple[Column, Column]], otherwise: Column) -> Column:
    """The value of the first rule whose condition is true; null conditions count as false."""
    out = None
    for test, value in rules:
        out = F.when(F.coalesce(test, F.lit(False)), value) if out is None else out.when(F.coalesce(test, F.lit(False)), value)
    return otherwise if out is None else out.otherwise(otherwise)


def _keyed(df: DataFrame, *present: str) -> DataFrame:
    for c in present:
        df = df.filter(F.trim(F.col(c)) != "")
    return df


def duplicate_groups(df: DataFrame, key: str, *present: str) -> DataFrame:
    """``(sha256, count, cross_split)`` of values of ``key`` that several rows share.

    Rows with a blank key, or a blank column of ``present``, take no part: they would form one giant group.
    cross_split compares split names, whatever the sources. Counts combine before the shuffle, so a value
    in a third of all rows is no more work than another; its rows are in :func:`duplicate_members`.
    """
    groups = _keyed(df, key, *present).groupBy(F.col(key).alias("sha256")).agg(F.count("*").alias("count"), (F.min("split") != F.max("split")).alias("cross_split"))
    return groups.filter("count >= 2")


MEMBER = ("source", "split", "row_index", "example_id", "speaker_id")


def _nested(rows: DataFrame, member: tuple[str, ...], *part: str) -> DataFrame:
    return rows.groupBy(F.col("__key").alias("sha256"), "count", "cross_split", *part).agg(F.sort_array(F.collect_list(F.struct(*member))).alias("members"))


def nested_groups(df: DataFrame, key: str, *present: str, most: int = 100_000) -> DataFrame:
    """The groups with ``members``, in the order of their keys, inside each row.

    A row can't be split, so a group of more than ``most`` members is an error here, found before
    anything is gathered; :func:`group_parts` and :func:`duplicate_members` have no such limit.
    """
    counts = duplicate_groups(df, key, *present).withColumn("count", F.when(F.col("count") <= most, F.col("count")).otherwise(F.raise_error(F.lit(f"a group has more than {most} members")).cast("long")))
    return _nested(_keyed(df, key, *present).withColumn("__key", F.col(key)).join(counts.withColumnRenamed("sha256", "__key"), "__key"), MEMBER)


def group_parts(df: DataFrame, key: str, *present: str, most: int = 100_000, member: tuple[str, ...] = MEMBER) -> DataFrame:
    """The groups as a report holds them: ``(sha256, count, cross_split, part, members)``, whatever their sizes.

    A group of at most ``most`` members is one row, part 0. A larger one is several, of ``most`` members each but
    the last; joined by part they are all members, in the order of the columns ``member``. count and
    cross_split are the whole group's. Only members of larger groups are numbered, by :func:`positions`.
    """
    groups = materialize(duplicate_groups(df, key, *present).withColumnRenamed("sha256", "__key"), "groups")
    keyed = _keyed(df, key, *present).select(F.col(key).alias("__key"), *member)
    whole = _nested(keyed.join(groups.filter(F.col("count") <= most), "__key"), member).select("sha256", "count", "cross_split", F.lit(0).cast("long").alias("part"), "members")
    large = groups.filter(F.col("count") > most)
    if large.isEmpty():
        return whole
    placed = positions(keyed.join(large, "__key"), ["__key"], list(member), "__at")
    return whole.unionByName(_nested(placed.withColumn("part", F.floor(F.col("__at") / most)), member, "part"))


def duplicate_members(df: DataFrame, key: str, *present: str) -> DataFrame:
    """The rows in duplicate groups with their group's count and cross_split: only counts are
    aggregated, before the shuffle, so no group gathers in one task."""
    keyed = _keyed(df, key, *present)
    groups = keyed.groupBy(key).agg(F.count("*").alias("group_count"), (F.min("split") != F.max("split")).alias("cross_split"))
    return keyed.join(groups.filter("group_count >= 2"), key)


def group_summary(df: DataFrame) -> DataFrame:
    """Per source and split: rows, decoded rows, speakers, hours, shortest and longest. Rows without a speaker
    count as one speaker, 'unknown'."""
    speaker = text.safe_string(F.col("speaker_id"), "unknown")
    return df.groupBy("source", "split").agg(
        F.count("*").alias("examples"),
        F.count_if(F.col("decode_ok")).alias("decoded"),
        F.countDistinct(speaker).alias("speakers"),
        (F.sum("duration_seconds") / 3600).alias("hours"),
        F.min("duration_seconds").alias("shortest"),
        F.max("duration_seconds").alias("longest"),
    )


def item_histogram(df: DataFrame, items: Column, *keys: str) -> DataFrame:
    """``(keys, item, count)`` over the items of an array column."""
    return df.select(*keys, F.explode(items).alias("item")).groupBy(*keys, "item").agg(F.count("*").alias("count"))


def grouped(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("count")).orderBy(*keys)


def totals(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count("*").alias("examples"), F.count_if(F.col("decode_ok")).alias("decoded"),
        *[F.count_if(F.col("status") == s).alias(s) for s in ("accept", "review", "reject")],
        F.count_if(F.coalesce("audio_duplicate_cross_split", F.lit(False))).alias("audio_cross_split"),
        F.count_if(F.coalesce("text_duplicate_cross_split", F.lit(False))).alias("text_cross_split"),
        (F.sum("duration_seconds") / 3600).alias("hours"),
    )


def speaker_overlap(df: DataFrame) -> DataFrame:
    """Speakers, as written, with records in more than one split."""
    named = df.filter(F.trim("speaker_id") != "")
    splits = named.groupBy("source", "speaker_id").agg(F.countDistinct("split").alias("splits"), F.count("*").alias("rows"))
    return splits.filter("splits > 1")


def length_statistics(df: DataFrame, limit: float = 35.0, accuracy: int | None = None) -> DataFrame:
    """Per source: rows up to and over the limit, their hours, and the median words per second.

    The exact median keeps a count of each distinct value of a source in memory; with an ``accuracy`` it is
    the approximate one, of bounded memory (an error of 1 / accuracy in rank)."""
    over = F.col("duration_seconds") > limit
    hours = lambda test: F.sum(F.when(test, F.col("duration_seconds"))) / 3600
    return df.filter("decode_ok").groupBy("source").agg(
        F.count_if(~over).alias("rows_within"), F.count_if(over).alias("rows_over"), hours(~over).alias("hours_within"), hours(over).alias("hours_over"),
        (F.median("words_per_second") if accuracy is None else F.percentile_approx("words_per_second", 0.5, accuracy)).alias("median_words_per_second"),
    )


def leakage_flags(df: DataFrame, key: str) -> DataFrame:
    """Every row, with whether its key occurs in several splits. Done by a join with the few keys that do."""
    shared = df.filter(F.trim(F.col(key)) != "").groupBy(key).agg(F.min("split").alias("a"), F.max("split").alias("b")).filter("a <> b").select(key, F.lit(True).alias("in_several"))
    return df.join(shared, key, "left").withColumn("in_several", F.coalesce("in_several", F.lit(False)))


def latest(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The row of the latest ``order`` per key, by an aggregate that combines before the shuffle; of
    equally late rows the greatest. Not for columns of map type."""
    rest = [c for c in df.columns if c not in keys]
    packed = df.groupBy(*keys).agg(F.max(F.struct(order, *[c for c in rest if c != order])).alias("x"))
    return packed.select(*[F.col(c) if c in keys else F.col(f"x.{c}").alias(c) for c in df.columns])


def top_rows(df: DataFrame, order: list, n: int) -> DataFrame:
    """The first n rows of an order: each task keeps its own n, so nothing is sorted as a whole."""
    return df.orderBy(*order).limit(n)


def ranged(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The rows spread by ranges of (key, order), the range's number in ``__range``; materialised, since the ranges must stay as they are."""
    return materialize(df.repartitionByRange(partitions(df.sparkSession), *keys, *order).withColumn("__range", F.spark_partition_id()), "positions")


def positions(df: DataFrame, keys: list[str], order: list[str], name: str = "position") -> DataFrame:
    """A 0-based position within each key by an explicit order.

    Rows are spread by ranges of (key, order), numbered within each range, and shifted by what the
    ranges before hold: no key, however large, is numbered by one task. Only a count per key and range
    is brought together.
    """
    placed = ranged(df, keys, order)
    before = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy(*keys, "__range").agg(F.count("*").alias("__n"))
    shifts = counts.withColumn("__shift", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    local = placed.withColumn(name, F.row_number().over(Window.partitionBy(*keys, "__range").orderBy(*order)) - 1)
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in [*keys, "__range"]]
    on = same[0]
    for s in same[1:]:
        on = on & s
    return local.alias("a").join(shifts.alias("b"), on).select(*[F.col(f"a.{c}") for c in df.columns], (F.col(f"a.{name}") + F.col("b.__shift")).alias(name))
