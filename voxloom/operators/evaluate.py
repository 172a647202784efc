"""Evaluation of recognisers: panels, error rates, slices, intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import distance
from .audit import positions


def scored(predictions: DataFrame) -> DataFrame:
    """Word and character errors and lengths of ``reference`` and ``hypothesis`` word lists; a null hypothesis is an empty one."""
    r, h = F.col("reference"), F.coalesce(F.col("hypothesis"), F.array().cast("array<string>"))
    return predictions.withColumns({
        "words": F.size(F.coalesce(r, F.array().cast("array<string>"))), "word_errors": distance.token_distance(r, h),
        "characters": F.length(F.concat_ws("", r)), "character_errors": distance.character_distance(F.concat_ws("", r), F.concat_ws("", h)),
    })


def micro(rows: DataFrame, *keys: str) -> DataFrame:
    """Error rates of all rows together, per key."""
    rate = lambda e, n: F.sum(e) / F.greatest(F.lit(1), F.sum(n))
    return rows.groupBy(*keys).agg(
        F.count("*").alias("examples"), rate("word_errors", "words").alias("wer"), rate("character_errors", "characters").alias("cer"),
        F.avg((F.col("word_errors") == 0).cast("double")).alias("exact"), F.avg(F.when(F.size(F.coalesce("hypothesis", F.array())) == 0, 1.0).otherwise(0.0)).alias("empty"),
    )


def macro(rows: DataFrame, key: str) -> DataFrame:
    """The mean of the keys' error rates, and the worst key."""
    per = micro(rows, key)
    return per.agg(F.avg("wer").alias("macro_wer"), F.avg("cer").alias("macro_cer"), F.max("wer").alias("worst_wer"), F.max_by(key, F.struct("wer", key)).alias("worst"))


def slices(rows: DataFrame, *keys: str) -> DataFrame:
    """Error rates over all rows, per key, and per combination, from one pass."""
    return rows.cube(*keys).agg(F.count("*").alias("examples"), (F.sum("word_errors") / F.greatest(F.lit(1), F.sum("words"))).alias("wer"))


def short_corpora(rows: DataFrame, least: int, most: int, k: int = 2) -> DataFrame:
    """``(corpus, rows)`` of corpora with fewer than k rows of admissible length."""
    fits = F.col("audio_size").between(least, most)
    return rows.groupBy("corpus").agg(F.count_if(fits).alias("rows")).filter(F.col("rows") < k)


def panel(rows: DataFrame, least: int, most: int, k: int = 2, whole: bool = False) -> DataFrame:
    """The k rows of each corpus that come first by their audio's hash, among those of admissible length. A corpus that has fewer gives those
    it has or, with ``whole``, is an error."""
    if whole and (short := short_corpora(rows, least, most, k).collect()):  # a row per corpus at most
        raise ValueError(f"fewer than {k} rows: {', '.join(sorted(str(r['corpus']) for r in short))}")
    order = Window.partitionBy("corpus").orderBy("audio_sha256", "record_no")
    chosen = rows.filter(F.col("audio_size").between(least, most)).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    label = F.format_string("dev_%02d", F.row_number().over(Window.partitionBy().orderBy("corpus", "rank")))  # k rows a corpus
    return chosen.withColumn("label", label)


# The distribution of Poisson(1), summed up to 6
_POISSON = [0.36787944, 0.73575888, 0.91969860, 0.98101184, 0.99634015, 0.99940582, 0.99991676]


def _times(round_: Column, unit: str, seed: int) -> Column:
    """How often a unit is drawn in a round: Poisson by a seeded hash that any engine has, the same at every run."""
    digest = F.substring(F.md5(F.concat_ws(":", F.lit(seed), round_, F.col(unit)).cast("binary")), 1, 8)
    u = (F.conv(digest, 16, 10).cast("double") + 0.5) / 2.0**32
    return sum((F.when(u > s, 1).otherwise(0) for s in _POISSON), F.lit(0))


def bootstrap(rows: DataFrame, key: str, unit: str, rounds: int = 200, seed: int = 7) -> DataFrame:
    """95 % interval of the micro word error rate by a Poisson bootstrap: each round counts a row as
    often as a seeded hash of it says, so no row moves and rounds add up per task."""
    drawn = rows.select(key, unit, "word_errors", "words", F.explode(F.sequence(F.lit(1), F.lit(rounds))).alias("round")).withColumn("times", _times(F.col("round"), unit, seed))
    rates = drawn.groupBy(key, "round").agg((F.sum(F.col("word_errors") * F.col("times")) / F.greatest(F.lit(1), F.sum(F.col("words") * F.col("times")))).alias("wer"))
    return rates.groupBy(key).agg(F.percentile("wer", 0.025).alias("low"), F.percentile("wer", 0.975).alias("high"))


def paired_difference(first: DataFrame, second: DataFrame, unit: str, rounds: int = 200, seed: int = 7) -> DataFrame:
    """Difference of two systems' micro word error rates on the units both scored, with a 95 % interval that draws the
    same units for both."""
    a = first.select(unit, F.col("word_errors").alias("ea"), F.col("words").alias("wa"))
    b = second.select(unit, F.col("word_errors").alias("eb"), F.col("words").alias("wb"))
    both = a.join(b, unit)
    rate = lambda e, w, k: F.sum(F.col(e) * k) / F.greatest(F.lit(1), F.sum(F.col(w) * k))
    # round 0 takes every unit once and gives the difference itself
    drawn = both.select("*", F.explode(F.sequence(F.lit(0), F.lit(rounds))).alias("round")).withColumn("k", F.when(F.col("round") == 0, 1).otherwise(_times(F.col("round"), unit, seed)))
    rates = drawn.groupBy("round").agg((rate("ea", "wa", F.col("k")) - rate("eb", "wb", F.col("k"))).alias("d"))
    of = lambda test: F.when(test, F.col("d"))
    return rates.agg(F.max(of(F.col("round") == 0)).alias("difference"), F.percentile(of(F.col("round") > 0), 0.025).alias("low"), F.percentile(of(F.col("round") > 0), 0.975).alias("high"))


def edit_totals(rows: DataFrame, *keys: str) -> DataFrame:
    """Substitutions, deletions and insertions, summed per key."""
    kinds = rows.select(*keys, distance.edit_kinds(F.col("reference"), F.col("hypothesis")).alias("e"))
    return kinds.groupBy(*keys).agg(*[F.sum(f"e.{c}").alias(c) for c in ("substitutions", "deletions", "insertions")])


def positional_zip(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows of two tables paired by place in the order of ``key`` within a corpus, as two files read side by side."""
    a, b = positions(left, ["corpus"], [key], "place"), positions(right, ["corpus"], [key], "place").withColumnRenamed(key, f"other_{key}")
    return a.join(b, ["corpus", "place"]).withColumn("place", F.col("place") + 1)


def unknown_characters(inventory: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Characters of an inventory that a vocabulary lacks."""
    return inventory.join(vocabulary, "character", "left_anti")


