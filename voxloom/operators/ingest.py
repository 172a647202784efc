"""From raw examples to audit rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import signal, text
from . import audit


@dataclass(frozen=True)
class Source:
    """Where a source's examples stand and what its columns are called."""

    source: str
    dataset_id: str
    revision: str
    text_column: str
    speaker_column: str | None = None
    id_column: str | None = None
    audio_column: str = "audio"


def raw_examples(df: DataFrame, s: Source, splits: tuple[str, ...] = ("train", "validation", "test"), most_per_split: int | None = None) -> DataFrame:
    """A source's examples under common names. Audio, of bytes or of a struct of array, bytes and path, stays encoded. ``split`` and the stored ``row_index`` must be there;
    a missing split is an error."""
    missing = set(splits) - {r["split"] for r in df.select("split").distinct().collect()}
    if missing:
        raise ValueError(f"{s.source} has no split {', '.join(sorted(missing))}")
    rows = df.filter(F.col("split").isin(*splits))
    if most_per_split is not None:
        rows = rows.filter(F.col("row_index") < most_per_split)
    none = F.lit(None).cast("string")
    data = signal.payload(df.schema[s.audio_column].dataType, F.col(s.audio_column))
    identity = text.safe_string(F.col(s.id_column) if s.id_column else none, F.concat(F.lit("row-"), F.col("row_index").cast("string")))
    speaker = text.safe_string(F.col(s.speaker_column) if s.speaker_column else none, "unknown")
    return rows.select(
        F.lit(s.source).alias("source"), F.lit(s.dataset_id).alias("dataset_id"), F.lit(s.revision).alias("dataset_revision"), "split", "row_index", identity.alias("example_id"),
        F.concat(F.lit(f"{s.source}:"), speaker).alias("speaker_id"), F.coalesce(F.col(s.text_column).cast("string"), F.lit("")).alias("text_raw"), data.alias("audio"),
    )


def audit_rows(examples: DataFrame, limits: audit.Thresholds = audit.Thresholds()) -> DataFrame:
    """The audit row of each example: text measures in the JVM, all audio measures from one decoding, flags, and
    whether text or audio recur in another split (which turns accept into review)."""
    measured = examples.withColumn("text_normalized", text.spoken_form(F.col("text_raw"))).withColumn("m", signal.measured(F.col("audio"))).drop("audio")
    rows = measured.select("*", "m.*").drop("m")
    words = text.word_count(F.col("text_normalized"))
    rows = rows.withColumns({
        "text_words": words, "text_characters": F.length("text_normalized"), "words_per_second": text.per_second(words, F.col("duration_seconds")), "text_sha256": F.sha2("text_normalized", 256),
        "preprocessing_actions": audit.format_actions(),
    })
    flags = F.transform(audit.quality_flags(limits), lambda f: F.when(f == "decode_error", F.concat(f, F.lit(":"), F.coalesce("error", F.lit("")))).otherwise(f))
    rows = rows.withColumn("severity", audit.severity(audit.quality_flags(limits))).withColumn("flags", flags)
    blank = F.when(F.col("text_normalized") != "", F.col("text_sha256"))
    for kind, key in (("audio", F.col("audio_sha256")), ("text", blank)):
        rows = audit.leakage_flags(rows.withColumn("__key", key), "__key").withColumnRenamed("in_several", f"{kind}_duplicate_cross_split").drop("__key")
    more = [F.when(F.col(f"{k}_duplicate_cross_split"), f"{k}_duplicate_cross_split") for k in ("audio", "text")]
    reasons = F.concat("flags", F.filter(F.array(*more), lambda x: x.isNotNull()))
    status = F.when((F.col("severity") == "accept") & (F.size(reasons) > 0), "review").otherwise(F.col("severity"))
    return rows.withColumns({"review_reasons": reasons, "status": status}).drop("flags", "severity", "error")
