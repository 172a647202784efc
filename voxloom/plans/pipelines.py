"""End-to-end runs made of the operators: audit, mixture, evaluation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import signal, text
from ..operators import audit, evaluate, ingest, mixture
from ..session import materialize
from ..sources import sinks

# Columns of the audit table, in their order
FIELDS = [
    "source", "dataset_id", "dataset_revision", "split", "row_index", "example_id",
    "speaker_id", "text_raw", "text_normalized", "text_words", "text_characters", "words_per_second",
    "text_sha256", "decode_ok", "sample_rate", "channels", "num_samples", "duration_seconds",
    "peak", "peak_dbfs", "rms", "rms_dbfs", "clipping_fraction", "leading_silence_seconds",
    "trailing_silence_seconds", "silence_amplitude_threshold", "audio_sha256", "status", "preprocessing_actions", "review_reasons",
    "audio_duplicate_cross_split", "text_duplicate_cross_split",
]


def _rows(df: DataFrame) -> list[dict]:
    return [r.asDict(recursive=True) for r in df.collect()]


def audit_run(sources: list[tuple[DataFrame, ingest.Source]], folder: str, limits: audit.Thresholds = audit.Thresholds(), most_per_split: int | None = None) -> DataFrame:
    """Audit all sources into ``folder``: the audit and the review list as CSV, duplicate groups and the character
    inventory as JSON lines, and a summary document. Returns the audit rows."""
    examples = reduce(DataFrame.unionByName, [ingest.raw_examples(df, s, most_per_split=most_per_split) for df, s in sources])
    rows = materialize(ingest.audit_rows(examples, limits), "audit")
    sinks.csv_table(rows, f"{folder}/dataset_audit", FIELDS)
    sinks.csv_table(rows.filter("status <> 'accept'"), f"{folder}/manual_review", FIELDS)
    for name, key, present in (("audio", "audio_sha256", ()), ("normalized_text", "text_sha256", ("text_normalized",))):
        sinks.json_lines(audit.group_parts(rows, key, *present), f"{folder}/duplicate_groups/kind={name}")
    inventory = text.character_inventory(rows, "text_raw", "source").withColumn("form", F.lit("raw")).unionByName(text.character_inventory(rows, "text_normalized", "source").withColumn("form", F.lit("normalized")))
    sinks.json_lines(text.describe_characters(inventory).orderBy("source", "form", "character"), f"{folder}/characters")
    summary = {"totals": _rows(audit.totals(rows))[0], "groups": _rows(audit.group_summary(rows).orderBy("source", "split")), "reasons": _rows(audit.item_histogram(rows, F.col("review_reasons"), "source", "split"))}
    sinks.json_document(summary, f"{folder}/summary.json")
    return rows


def mixture_run(examples: DataFrame, chosen: DataFrame, root: str, language: str, start: Column | None = None, end: Column | None = None, rows_per_file: int = 100) -> tuple[DataFrame, DataFrame]:
    """Materialise the chosen records (``source, split, row_index, text`` and optional trim columns) of raw examples.

    Audio is joined and decoded for chosen rows only. Returns counts and hours of what was written, and
    the rows that couldn't be prepared with their errors.
    """
    none = F.lit(None).cast("double")
    joined = chosen.join(examples.select("source", "split", "row_index", "audio"), ["source", "split", "row_index"], "left")
    made = materialize(joined.withColumn("p", signal.prepared(F.col("audio"), none if start is None else start, none if end is None else end)).drop("audio"), "prepared")
    good = made.filter("p.error is null").select("text", "p.audio_bytes", "p.audio_size", F.col("source").alias("corpus"), mixture.output_split(F.col("split")).alias("split"), F.lit(language).alias("language"))
    sinks.mixture(good, root, rows_per_file)
    written = examples.sparkSession.read.parquet(root)
    return mixture.counts_and_hours(written, "corpus", "split"), made.filter("p.error is not null").select("source", "split", "row_index", "p.error")


def evaluation_run(predictions: DataFrame) -> dict:
    """Error rates overall, per corpus, and their interval, of normalised word lists."""
    rows = materialize(evaluate.scored(predictions), "scored")
    return {"overall": _rows(evaluate.micro(rows))[0], "corpora": _rows(evaluate.micro(rows, "corpus").orderBy("corpus")), "macro": _rows(evaluate.macro(rows, "corpus"))[0], "intervals": _rows(evaluate.bootstrap(rows, "corpus", "record_no").orderBy("corpus"))}
