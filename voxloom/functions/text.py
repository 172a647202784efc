"""Text functions on columns. Built-in expressions throughout, but for NFC, character names and exact
decimal formatting, which Spark has no function for."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Code points written for the apostrophe, of which there are six.
APOSTROPHES = "’‘ʼ＇`´"


@F.pandas_udf(StringType())
def _nfc(text: pd.Series) -> pd.Series:
    return text.map(lambda x: unicodedata.normalize("NFC", x), na_action="ignore")


@F.pandas_udf(StringType())
def _three_decimals(x: pd.Series) -> pd.Series:
    return x.map(lambda v: None if pd.isna(v) else f"{v:.3f}")


def _described(ch: pd.Series) -> pd.DataFrame:
    return pd.DataFrame({"name": [unicodedata.name(c, "UNKNOWN") for c in ch], "category": [unicodedata.category(c) for c in ch]})


def nfc(text: Column) -> Column:
    """Canonical composition. Text below U+0300 is composed already and never leaves the JVM."""
    return F.coalesce(_nfc(F.when(text.rlike(r"[^\x{0}-\x{2FF}]"), text)), text)


def safe_string(value: Column, fallback: Column | str) -> Column:
    """The value without blanks of any kind around it; the fallback for null and blank values."""
    bare = F.regexp_replace(value.cast("string"), r"(?U)^\s+|\s+$", "")
    return F.coalesce(F.when(bare != "", bare), fallback if isinstance(fallback, Column) else F.lit(fallback))


def strip_annotations(text: Column) -> Column:
    return F.regexp_replace(text, r"\[[^\]]*\]", " ")


def plain_apostrophes(text: Column) -> Column:
    return F.translate(text, APOSTROPHES, "'" * len(APOSTROPHES))


def collapse(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def spoken_form(text: Column) -> Column:
    """Lower-case words only: NFC, no ``[annotations]``, one apostrophe, letters, marks, digits, no numbers
    standing alone. Null gives ''."""
    x = plain_apostrophes(strip_annotations(nfc(F.coalesce(text, F.lit("")))))
    x = collapse(F.regexp_replace(F.lower(x), r"[^\p{L}\p{M}\p{N}']", " "))
    return collapse(F.regexp_replace(x, r"(?U)(?<!\S)\d+(?!\S)", " "))


def words(text: Column) -> Column:
    return F.filter(F.split(text, " "), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.size(words(F.coalesce(text, F.lit(""))))


def per_second(count: Column, seconds: Column) -> Column:
    """Null for a duration that is null or zero."""
    return F.try_divide(count.cast("double"), seconds)


def listed(joined: Column) -> Column:
    """The items of a ``|``-joined text, without blank ones; empty for null."""
    return F.filter(F.split(F.coalesce(joined, F.lit("")), r"\|"), lambda x: F.trim(x) != "")


def joined(items: Column) -> Column:
    return F.concat_ws("|", items)


def record_key(source: Column, split: Column, row_index: Column) -> Column:
    return F.concat_ws(":", source, split, row_index.cast("string"))


def parsed(number: Column) -> Column:
    """A typed number, or null: NaN is unreadable as well."""
    x = number.try_cast("double")
    return F.when(~F.isnan(x), x)


def three_decimals(x: Column) -> Column:
    """``%.3f`` by the exact binary value, ties to even (``format_string`` rounds decimal halves up)."""
    return _three_decimals(x.cast("double"))


def matched_pairs(text: Column, pattern: str) -> Column:
    """All ``(first, second)`` groups of a pattern over a whole text, line ends included."""
    a, b = (F.regexp_extract_all(text, F.lit("(?s)" + pattern), F.lit(i)) for i in (1, 2))
    return F.zip_with(a, b, lambda x, y: F.struct(x.alias("first"), y.alias("second")))


def occurrences(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def base64_text(data: Column) -> Column:
    """Base64 on one line."""
    return F.translate(F.base64(data), "\r\n", "")


# The kinds of files a page shows or plays
MIME = {"wav": "audio/wav", "flac": "audio/flac", "mp3": "audio/mpeg", "ogg": "audio/ogg", "m4a": "audio/mp4", "json": "application/json", "csv": "text/csv", "txt": "text/plain"}


def mime_of(name: Column) -> Column:
    """The kind of a file by its ending; octets for any other."""
    return F.coalesce(F.get(F.map_values(F.map_filter(F.create_map(*[F.lit(x) for kv in MIME.items() for x in kv]), lambda k, _: k == F.lower(F.regexp_extract(name, r"\.([A-Za-z0-9]+)$", 1)))), F.lit(0)), F.lit("application/octet-stream"))


def html_escaped(text: Column) -> Column:
    """Text safe in a page and in its attributes."""
    for mark, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        text = F.replace(text, F.lit(mark), F.lit(name))
    return text


def data_uri(data: Column, mime: str) -> Column:
    return F.concat(F.lit(f"data:{mime};base64,"), base64_text(data))


def register(spark: SparkSession, prefix: str = "vox_") -> None:
    """Make text functions callable from SQL, as session functions that the optimizer sees through."""
    spark.udf.register(f"{prefix}nfc", _nfc)
    spark.udf.register(f"{prefix}three_decimals", _three_decimals)
    bodies = {
        "word_count(t STRING) RETURNS INT": "size(filter(split(coalesce(t, ''), ' '), w -> w <> ''))",
        "bare(t STRING) RETURNS STRING": r"regexp_replace(t, r'(?U)^\s+|\s+$', '')",
        "listed(t STRING) RETURNS ARRAY<STRING>": r"filter(split(coalesce(t, ''), r'\|'), x -> trim(x) <> '')",
        "decibels(v DOUBLE) RETURNS DOUBLE": "20 * log10(greatest(v, 1e-12D))",
        "parsed(t STRING) RETURNS DOUBLE": "nullif(try_cast(t AS DOUBLE), double('NaN'))",
    }
    for head, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{head} RETURN {body}")


def character_inventory(df: DataFrame, text: str, *keys: str) -> DataFrame:
    """``(keys, character, count)`` of all characters but blanks. Counts are summed before the shuffle, so
    it moves an alphabet per task, not the text."""
    ch = df.select(*keys, F.explode(F.split(F.coalesce(text, F.lit("")), "")).alias("character"))
    return ch.filter(~F.col("character").rlike(r"(?U)^\s?$")).groupBy(*keys, "character").agg(F.count("*").alias("count"))


def describe_characters(df: DataFrame, ch: str = "character") -> DataFrame:
    """Add ``codepoint``, ``name`` and ``category`` to a table of characters."""
    described = F.pandas_udf(_described, "name string, category string")
    return df.withColumn("codepoint", F.format_string("U+%04X", F.ascii(ch))).withColumn("__d", described(ch)).select("*", "__d.name", "__d.category").drop("__d")
