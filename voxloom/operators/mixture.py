"""Materialised mixtures: hours, sampling weights, batches, parts, verification."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .audit import positions

SAMPLE_RATE = 16_000

# Names of the splits once materialised
OUTPUT_SPLITS = {"train": "train", "validation": "dev", "test": "test"}


def output_split(split: Column) -> Column:
    """The materialised name of a split; any other name is an error."""
    out = F
    for name, new in OUTPUT_SPLITS.items():
        out = out.when(split == name, new)
    return out.otherwise(F.raise_error(F.concat(F.lit("unknown split "), F.coalesce(split, F.lit("null")))))


def hours(size: Column) -> Column:
    return F.sum(size) / SAMPLE_RATE / 3600


def counts_and_hours(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("examples"), F.sum("audio_size").alias("samples"), hours(F.col("audio_size")).alias("hours"))


def sampling_weights(rows: DataFrame, beta: float = 0.5) -> DataFrame:
    """Share of training hours per corpus and its tempered weight, ``share ** beta`` made to sum to 1.
    beta 1 samples by duration, 0 equally."""
    h = rows.filter("split = 'train'").groupBy("corpus").agg(hours(F.col("audio_size")).alias("hours"))
    whole = Window.partitionBy()  # one row per corpus
    tempered = F.pow(F.col("hours") / F.sum("hours").over(whole), F.lit(beta))
    return h.withColumn("t", tempered).withColumn("weight", F.col("t") / F.sum("t").over(whole)).drop("t")


def within_length(rows: DataFrame, least: int, most: int) -> DataFrame:
    return rows.filter(F.col("audio_size").between(least, most))


def part_numbers(rows: DataFrame, keys: list[str], order: list[str], rows_per_part: int = 100) -> DataFrame:
    """The file each row goes to, ``rows_per_part`` rows a file, by an explicit order within the keys."""
    numbered = positions(rows, keys, order, "__n")
    return numbered.withColumn("part", F.format_string("part-%05d", F.floor(F.col("__n") / rows_per_part).cast("int"))).drop("__n")


def batches(rows: DataFrame, keys: list[str], order: list[str], most: int, bucket_rows: int = 1000, shuffle_window: int | None = None, seed: int = 0) -> DataFrame:
    """Number the batches of at most ``most`` samples in all, filled greedily in the given order.

    Rows are numbered in order within their key, and every ``bucket_rows`` following ones are a bucket that one task fills: batches don't depend on the table's size
    and no key is one task's work. A batch lies within a bucket. A row longer than ``most`` makes a batch of its own. With a ``shuffle_window``, rows change
    places with those of the same window of so many rows first, by a seeded hash.
    """
    kept = rows.select(*keys, *[c for c in order if c not in keys and c != "audio_size"], "audio_size")
    placed = positions(kept, keys, order, "__at").withColumn("bucket", F.floor(F.col("__at") / bucket_rows))
    if shuffle_window:
        window = F.floor(F.col("__at") / shuffle_window)
        placed = placed.withColumn("__turn", F.struct(window.alias("w"), F.xxhash64(F.lit(seed), F.col("__at")).alias("h")))
        placed = placed.withColumn("__at", F.row_number().over(Window.partitionBy(*keys, "bucket").orderBy("__turn")))
        placed = placed.drop("__turn")

    def fill(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("__at", kind="stable")
        out, number, held = [], 0, 0
        for size in group["audio_size"]:
            size = 0 if pd.isna(size) else int(size)
            if held and held + size > most:
                number, held = number + 1, 0
            held += size
            out.append(number)
        return group.assign(batch=out, place=range(len(out))).drop(columns="__at")

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema) + ", bucket long, batch long, place long"
    return placed.groupBy(*keys, "bucket").applyInPandas(fill, schema)


def verification(rows: DataFrame) -> DataFrame:
    return rows.agg(
        F.count("*").alias("rows"), F.min("audio_size").alias("smallest"), F.max("audio_size").alias("largest"),
        F.array_join(F.sort_array(F.collect_set("corpus")), "|").alias("corpora"), F.array_join(F.sort_array(F.collect_set("split")), "|").alias("splits"),
        F.array_join(F.sort_array(F.collect_set("language")), "|").alias("languages"), F.count_if(F.col("text").isNull() | (F.trim("text") == "")).alias("blank_texts"),
    )


def stratified_sample(rows: DataFrame, strata: list[str], key: str, k: int, seed: int = 0) -> DataFrame:
    """k rows of each stratum, the same ones at every run."""
    order = Window.partitionBy(*strata).orderBy(F.sha2(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")), 256), key)
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
