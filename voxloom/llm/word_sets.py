"""Records as sets of different words, shared by the cross-split and near-duplicate operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import digest, materialize, partitions
from .one_form import with_one_form, words_of


def set_rows(audit: DataFrame, least_words: int, texts: bool = False) -> DataFrame:
    """One row per delivery, materialised: keys of the text in the one form (f1, f2) and of its word set
    (c1, c2), the set itself as ascending 64-bit word hashes and, with ``texts``, the words' hashes as they stand in the text. A row with fewer than
    ``least_words`` different words, or without text, has a null set and no partners."""
    rows = with_one_form(audit.select("record_no", "loaded_at", "split", "source", "text_normalized"), "text_normalized")
    rows = rows.withColumn("words", F.transform(words_of(F.col("form")), lambda w: F.xxhash64(w)))
    rows = rows.select("record_no", "loaded_at", "split", "source", "form", "words", F.array_sort(F.array_distinct("words")).alias("seq")).withColumn("seq", F.when(F.size("seq") >= least_words, F.col("seq")))
    (f1, f2), (c1, c2) = digest(F.col("form")), digest(F.col("seq"))
    return materialize(rows.select("record_no", "loaded_at", "split", "source", f1.alias("f1"), f2.alias("f2"), c1.alias("c1"), c2.alias("c2"), "seq", *(["words"] if texts else [])), "word-sets")


def classes_and_members(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Classes of equal word sets ``(cid, seq, n, train, evaluation)``, with the ``words`` of one of their texts if the rows have them, and records' membership
    ``(record_no, split, source, f1, f2, cid)``; the latest delivery of a record decides.

    However many records share a text, its set is searched for once.
    """
    held = rows.filter("seq is not null")
    train = F.col("split") == "train"
    texts = [F.min("words").alias("words")] if "words" in rows.columns else []
    # as many parts as the session shuffles into: what reads the classes is more work than their size shows
    classes = held.repartition(partitions(rows.sparkSession), "c1", "c2").groupBy("c1", "c2").agg(F.first("seq").alias("seq"), *texts, F.max(train).alias("train"), F.max(F.col("split").isin("validation", "test")).alias("evaluation"))
    # ids are fixed once written, whatever is computed again later
    classes = materialize(classes.select(F.monotonically_increasing_id().alias("cid"), "c1", "c2", F.size("seq").alias("n"), "train", "evaluation", "seq", *(["words"] if texts else [])), "word-classes")
    latest = F.max(F.struct("loaded_at", F.col("seq").isNotNull().alias("full"), "split", "source", "f1", "f2", "c1", "c2")).alias("x")
    members = rows.groupBy("record_no").agg(latest).filter("x.full").select("record_no", "x.split", "x.source", "x.f1", "x.f2", "x.c1", "x.c2")
    members = members.join(classes.select("cid", "c1", "c2"), ["c1", "c2"]).drop("c1", "c2")
    return classes, members
