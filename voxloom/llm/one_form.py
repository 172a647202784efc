"""Bringing equal-looking texts to one form (problem 1).

Texts that need work are exploded to positioned code points, which a broadcast table decomposes
and names look-alikes for; marks are put in order of their combining class, letters recomposed,
and words and texts rebuilt. Texts that can't change, most of them, are told by patterns made
from the same tables and skip all that.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..session import digest, materialize, partitions
from . import unicode_tables as tables

_ROW = "cp int, out array<struct<c: string, ccc: int, look: string, kind: int, second: boolean>>"


@F.pandas_udf(StringType())
def _recompose(letters: pd.Series) -> pd.Series:
    """A sequential fold (each composition changes what the next mark is tried on), so it runs in
    Python, on the words that hold a composable mark only."""
    return letters.map(lambda x: None if x is None else tables.compose(list(x)))


def needs_work(text: Column) -> Column:
    far, changed_far, changed_near, moved_near, moved_far = tables.patterns()
    # what can be changed below U+0370 is an ASCII control, a grave accent, or begins with one of three bytes
    data = text.cast("binary")
    near = F.contains(text, F.lit("`")) | text.rlike(r"[\x00-\x1F\x7F]")
    for lead in (0xC2, 0xCA, 0xCD):
        near = near | F.contains(data, F.lit(bytes([lead])))
    return F.coalesce((near & text.rlike(changed_near)) | text.rlike(moved_near) | (text.rlike(far) & (text.rlike(changed_far) | text.rlike(moved_far))), F.lit(False))


def plain_blanks(text: Column) -> Column:
    """Single plain blanks, none at the ends."""
    untidy = F.startswith(text, F.lit(" ")) | F.endswith(text, F.lit(" "))
    for blank in ("\t", "\n", "\r", "  "):
        untidy = untidy | F.contains(text, F.lit(blank))
    return F.when(untidy, F.trim(F.regexp_replace(text, "[ \t\n\r]+", " "))).otherwise(text)


def forms_of(texts: DataFrame) -> DataFrame:
    """``(h1, h2, form)`` for a table of ``(h1, h2, text)``; equal texts are handled once."""
    spark = texts.sparkSession
    table = F.broadcast(spark.createDataFrame(tables.rows(), _ROW))
    once = texts.repartition(partitions(spark), "h1", "h2").groupBy("h1", "h2").agg(F.first("text").alias("text"))
    kind = F.when(F.col("ch").rlike(r"\p{L}"), 2).otherwise(0)
    itself = F.array(F.struct(F.col("ch").alias("c"), F.lit(0).alias("ccc"), F.lit(None).cast("string").alias("look"), kind.alias("kind"), F.lit(False).alias("second")))
    chars = (
        once.select("h1", "h2", F.posexplode(F.split("text", "")).alias("pos", "ch"))
        .filter("ch <> ''")
        .withColumn("cp", F.ascii("ch"))
        .join(table, "cp", "left")
        .select("h1", "h2", "pos", F.posexplode(F.coalesce("out", itself)).alias("k", "o"))
        .select("h1", "h2", "pos", "k", "o.*")
    )
    at = Window.partitionBy("h1", "h2").orderBy("pos", "k").rowsBetween(Window.unboundedPreceding, 0)
    words = (
        chars.withColumn("word", F.sum((F.col("kind") == 3).cast("int")).over(at))
        .withColumn("block", F.sum((F.col("ccc") == 0).cast("int")).over(at))
        .filter("kind <> 3")
        .groupBy("h1", "h2", "word")
        .agg(
            F.sort_array(F.collect_list(F.struct("block", "ccc", "pos", "k", "c", "look"))).alias("a"),
            (F.max((F.col("kind") == 1).cast("int")) > F.max((F.col("kind") == 2).cast("int"))).alias("latin"),
            F.max("second").alias("second"),
        )
        .withColumn("letters", F.transform("a", lambda x: F.when(F.col("latin"), F.coalesce(x.look, x.c)).otherwise(x.c)))
        .withColumn("form", F.coalesce(_recompose(F.when(F.col("second"), F.col("letters"))), F.concat_ws("", "letters")))
    )
    whole = words.groupBy("h1", "h2").agg(F.sort_array(F.collect_list(F.struct("word", "form"))).alias("w"))
    # a text of nothing but invisible characters and blanks has no words and so no row here
    return whole.select("h1", "h2", F.concat_ws(" ", F.col("w.form")).alias("form"))


def with_one_form(df: DataFrame, text: str, form: str = "form") -> DataFrame:
    """Add the one form of the column ``text``.

    No invisible characters; single plain blanks; NFC; ordinary width; ``'`` for every
    apostrophe-like mark; Latin letters for look-alikes in words that hold Latin letters and
    otherwise no letters of another script. Null stays null; empty, blank or invisible text gives
    ''. Repeated rows stay repeated. Hot texts are handled once; the join back is split by adaptive
    execution where it is skewed.
    """
    flag, h1, h2, out = (f"__{form}_{x}" for x in ("work", "h1", "h2", "out"))
    work = needs_work(F.col(text))
    clean = df.filter(~work).withColumn(form, plain_blanks(F.col(text)))
    a, b = digest(F.col(text))
    dirty = df.filter(work).withColumns({h1: a, h2: b})
    made = forms_of(dirty.select(F.col(h1).alias("h1"), F.col(h2).alias("h2"), F.col(text).alias("text")))
    made = made.select(F.col("h1").alias(h1), F.col("h2").alias(h2), F.col("form").alias(out))
    joined = dirty.join(made, [h1, h2], "left").withColumn(form, F.coalesce(out, F.lit(""))).drop(h1, h2, out)
    return clean.unionByName(joined).drop(flag)


def words_of(form: Column) -> Column:
    """The words of a text in the one form; none for null or ''."""
    return F.filter(F.split(F.coalesce(form, F.lit("")), " "), lambda w: w != "")


def fields_in_one_form(audit: DataFrame) -> DataFrame:
    """``(record_no, loaded_at, field, text, form)``: both text fields of every delivery."""
    two = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("text")) for c in ("text_raw", "text_normalized")]))
    return with_one_form(audit.select("record_no", "loaded_at", two.alias("x")).select("record_no", "loaded_at", "x.*"), "text")


def _form_keys(audit: DataFrame, least_words: int) -> DataFrame:
    """``(record_no, field, f1, f2, s1, s2)`` of the fields of full records: keys of the one form and of what is stored, materialised. A record's latest
    delivery counts."""
    f1, f2 = digest(F.col("form"))
    s1, s2 = digest(F.col("text"))
    full = (F.col("field") == "text_normalized") & (F.size(F.array_distinct(words_of(F.col("form")))) >= least_words)
    keys = fields_in_one_form(audit).select(
        "record_no", "loaded_at", "field", full.alias("full"),
        F.when(F.col("text").isNotNull(), F.struct(f1.alias("f1"), f2.alias("f2"), s1.alias("s1"), s2.alias("s2"))).alias("key"),
    )
    latest = lambda name: F.max(F.when(F.col("field") == name, F.struct("loaded_at", "full", "key")))["key"].alias(name)
    full_of = F.max(F.when(F.col("field") == "text_normalized", F.struct("loaded_at", "full")))["full"]
    records = keys.groupBy("record_no").agg(latest("text_raw"), latest("text_normalized"), full_of.alias("full")).filter("full")
    two = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("key")) for c in ("text_raw", "text_normalized")]))
    rows = records.select("record_no", two.alias("x")).filter("x.key is not null").select("record_no", "x.field", "x.key.*")
    return materialize(rows, "form-keys")  # read by several branches


def equal_looking_pairs(audit: DataFrame, least_words: int = 10) -> DataFrame:
    """``(field, record_a, record_b)``: full records whose field is equal in the one form, stored differently.

    A record's latest delivery counts. Null fields have no partners. Only keys of 16 bytes travel:
    texts are compared by 128-bit hashes. All pairs of a form come out, copies included,
    since the pairs are the result; forms stored in one way only are dropped before the join.
    """
    rows = _form_keys(audit, least_words)
    forms = (
        rows.groupBy("field", "f1", "f2")
        .agg(F.min(F.struct("s1", "s2")).alias("lo"), F.max(F.struct("s1", "s2")).alias("hi"))
        .filter("lo <> hi")
        .select("field", "f1", "f2")
    )
    kept = rows.join(forms, ["field", "f1", "f2"], "left_semi")
    a = kept.withColumnsRenamed({"record_no": "record_a", "s1": "a1", "s2": "a2"})
    b = kept.withColumnsRenamed({"record_no": "record_b", "s1": "b1", "s2": "b2"})
    return a.join(b, ["field", "f1", "f2"]).filter("record_a < record_b and (a1 <> b1 or a2 <> b2)").select("field", "record_a", "record_b")


def equal_looking_classes(audit: DataFrame, least_words: int = 10) -> DataFrame:
    """``(field, record_no, class_id, class_records, links)``: a row for each field of a full record that others equal in the one form but not as stored.

    class_id is the least record_no of those equal in the one form, class_records their number, links the number of those stored differently. Counted by stored
    variant: however many copies a text has, no pair is made."""
    rows, form = _form_keys(audit, least_words), ["field", "f1", "f2"]
    variants = rows.groupBy(*form, "s1", "s2").agg(F.count("*").alias("n"), F.min("record_no").alias("least"))
    classes = variants.groupBy(*form).agg(F.min("least").alias("class_id"), F.sum("n").alias("class_records"), F.count("*").alias("variants")).filter("variants > 1")
    known = variants.join(classes, form).select(*form, "s1", "s2", "class_id", "class_records", (F.col("class_records") - F.col("n")).alias("links"))
    return rows.join(known, [*form, "s1", "s2"]).select("field", "record_no", "class_id", "class_records", "links")
