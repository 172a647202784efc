"""Queries of the text functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import audit, review
from ..session import scratch_path
from ..sources.readers import parquet
from .registry import query

SPOKEN = """array_to_string(list_filter(string_split(regexp_replace(lower(translate(regexp_replace(nfc_normalize(coalesce({0}, '')),
    '\\[[^\\]]*\\]', ' ', 'g'), '’‘ʼ＇`´', '''''''''''''')), '[^\\p{{L}}\\p{{M}}\\p{{N}}'']', ' ', 'g'), ' '),
    lambda w: w <> '' and not regexp_full_match(w, '\\p{{Nd}}+')), ' ')"""
BARE = r"regexp_replace({0}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"


@query(f"select record_no, loaded_at, {SPOKEN.format('text_raw')} as spoken from dataset_audit")
def normalize_text(spark, d):
    return parquet(spark, d, "dataset_audit").select("record_no", "loaded_at", T.spoken_form(F.col("text_raw")).alias("spoken"))


@query(f"select doc_id, {SPOKEN.format('text')} as spoken from documents")
def normalize_documents(spark, d):
    return parquet(spark, d, "documents").select("doc_id", T.spoken_form(F.col("text")).alias("spoken"))


@query("select doc_id, nfc_normalize(text) as composed from documents")
def compose_text(spark, d):
    return parquet(spark, d, "documents").select("doc_id", T.nfc(F.col("text")).alias("composed"))


@query("""select record_no, loaded_at, len(list_filter(string_split(coalesce(text_normalized, ''), ' '), lambda w: w <> ''))::int as words,
    length(text_normalized)::int as characters, round(len(list_filter(string_split(coalesce(text_normalized, ''), ' '), lambda w: w <> ''))::double / nullif(duration_seconds, 0), 6) as per_second,
    sha256(text_normalized) as sha from dataset_audit""")
def text_stats(spark, d):
    t = F.col("text_normalized")
    words = T.word_count(t)
    return parquet(spark, d, "dataset_audit").select(
        "record_no", "loaded_at", words.alias("words"), F.length(t).alias("characters"), F.round(T.per_second(words, F.col("duration_seconds")), 6).alias("per_second"), F.sha2(t, 256).alias("sha")
    )


@query(f"""select record_no, loaded_at, source || ':' || coalesce(nullif({BARE.format('speaker_id')}, ''), 'unknown') as speaker,
    coalesce(nullif({BARE.format('example_id')}, ''), 'row-' || row_index) as example from dataset_audit""")
def safe_identifiers(spark, d):
    speaker = F.concat("source", F.lit(":"), T.safe_string(F.col("speaker_id"), "unknown"))
    example = T.safe_string(F.col("example_id"), F.concat(F.lit("row-"), F.col("row_index").cast("string")))
    return parquet(spark, d, "dataset_audit").select("record_no", "loaded_at", speaker.alias("speaker"), example.alias("example"))


@query("""select source, c as character, count(*) as count from (select source, unnest(string_split(text_raw, '')) as c from dataset_audit where text_raw is not null)
    where not regexp_full_match(c, '[\\s\\p{Z}\\x85\\x1c-\\x1f]?') group by 1, 2""")
def char_inventory(spark, d):
    return T.character_inventory(parquet(spark, d, "dataset_audit"), "text_raw", "source")


@query()
def char_descriptions(spark, d):
    return T.describe_characters(T.character_inventory(parquet(spark, d, "dataset_audit"), "text_normalized"))


# General categories of characters
_CATEGORIES = ["Lu", "Ll", "Lt", "Lm", "Lo", "Mn", "Mc", "Me", "Nd", "Nl", "No", "Pc", "Pd", "Ps", "Pe", "Pi", "Pf", "Po", "Sm", "Sc", "Sk", "So", "Zs", "Zl", "Zp", "Cc", "Cf", "Co"]


@query(f"""select character, printf('U+%04X', unicode(character)) as codepoint, case {" ".join(f"when regexp_full_match(character, '\\p{{{c}}}') then '{c}'" for c in _CATEGORIES)} else 'Cn' end as category
    from (select distinct unnest(string_split(text_raw, '')) as character from dataset_audit where text_raw is not null) where not regexp_full_match(character, '[\\s\\p{{Z}}\\x85\\x1c-\\x1f]?')""")
def char_codepoints(spark, d):
    """Code point and category of each character; names, which SQL doesn't know, are in char_descriptions."""
    return T.describe_characters(T.character_inventory(parquet(spark, d, "dataset_audit"), "text_raw")).select("character", "codepoint", "category")


@query("""select item, count(*) as count from (select unnest(string_split(review_reasons, '|')) as item from dataset_audit) where trim(item) <> '' group by 1""")
def reason_items(spark, d):
    return audit.item_histogram(parquet(spark, d, "dataset_audit"), T.listed(F.col("review_reasons")))


@query("""select review_id, concat_ws(':', source, split, row_index) as key, split_part(review_id, ':', 1) as head, array_to_string(list_slice(string_split(review_id, ':'), 2, 99), ':') as rest,
    try_cast(duration_seconds as double) as seconds, reviewed_at from decision_manifest_reviewed""")
def manifest_keys(spark, d):
    m = parquet(spark, d, "decision_manifest_reviewed")
    parts = F.split("review_id", ":", 2)
    return m.select("review_id", T.record_key(F.col("source"), F.col("split"), F.col("row_index")).alias("key"), parts[0].alias("head"), parts[1].alias("rest"), T.parsed(F.col("duration_seconds")).alias("seconds"), "reviewed_at")


@query("select record_no, loaded_at, printf('%.3f', duration_seconds) as seconds, printf('%.3f', words_per_second) as per_second from dataset_audit")
def fixed_decimals(spark, d):
    return parquet(spark, d, "dataset_audit").select("record_no", "loaded_at", T.three_decimals(F.col("duration_seconds")).alias("seconds"), T.three_decimals(F.col("words_per_second")).alias("per_second"))


@query("""select review_id, reviewed_at, len(c)::int as cuts, coalesce(len(c) > 0 and len(list_filter(c, lambda x: x is null or not (x > 0 and x < dur))) = 0 and list_sort(list_distinct(c)) = c, false) as valid
    from (select review_id, reviewed_at, try_cast(duration_seconds as double) as dur, list_transform(list_filter(string_split(coalesce(segment_boundaries_seconds, ''), ','), lambda x: trim(x) <> ''),
    lambda x: case when regexp_full_match(trim(x), '[0-9]+(\\.[0-9]*)?') then try_cast(trim(x) as double) end) as c from decision_manifest_reviewed)""")
def cut_lists(spark, d):
    items = F.filter(F.split(F.coalesce("segment_boundaries_seconds", F.lit("")), ","), lambda x: F.trim(x) != "")
    cuts = F.transform(items, lambda x: F.when(F.trim(x).rlike(r"^[0-9]+(\.[0-9]*)?$"), F.trim(x).try_cast("double")))
    m = parquet(spark, d, "decision_manifest_reviewed").withColumn("c", cuts)
    return m.select("review_id", "reviewed_at", F.size("c").alias("cuts"), review.cut_list_is_valid(F.col("c"), T.parsed(F.col("duration_seconds"))).alias("valid"))


@query("select doc_id, base64(encode(text)) as encoded, 'data:text/plain;base64,' || base64(encode(text)) as uri from documents")
def data_uris(spark, d):
    data = F.encode("text", "UTF-8")
    return parquet(spark, d, "documents").select("doc_id", T.base64_text(data).alias("encoded"), T.data_uri(data, "text/plain").alias("uri"))


@query("""select distinct record_no, split_part(dataset_id || '@' || dataset_revision, '@', 1) as id, split_part(dataset_id || '@' || dataset_revision, '@', 2) as revision,
    'dev_' || lpad((row_index % 100)::varchar, 2, '0') as label from dataset_audit""")
def labels_and_revisions(spark, d):
    both = F.concat_ws("@", "dataset_id", "dataset_revision")
    return parquet(spark, d, "dataset_audit").select("record_no", F.split_part(both, F.lit("@"), F.lit(1)).alias("id"), F.split_part(both, F.lit("@"), F.lit(2)).alias("revision"), F.format_string("dev_%02d", F.col("row_index") % 100).alias("label")).distinct()


@query("select 'lost' as side, 0::bigint as rows union all select 'gained', 0 union all select 'read', count(*) from decision_manifest_reviewed")
def csv_round_trip(spark, d):
    """The manifest written as CSV and read again, held against the table: differing rows of either side."""
    from ..sources import readers, sinks

    m = parquet(spark, d, "decision_manifest_reviewed").drop("reviewed_at")
    path = scratch_path(spark, "csv")
    sinks.csv_table(m, path, m.columns)
    back = readers.csv_strings(spark, path, m.columns, ["review_id", "final_decision"])
    want = m.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in m.columns])
    left, right = want.groupBy(*m.columns).agg(F.count("*").alias("n")), back.groupBy(*m.columns).agg(F.count("*").alias("n"))
    count = lambda df, side: df.agg(F.count("*").alias("rows")).select(F.lit(side).alias("side"), "rows")
    return count(left.exceptAll(right), "lost").unionByName(count(right.exceptAll(left), "gained")).unionByName(count(back, "read"))


@query("""select record_no, loaded_at, len(list_filter(string_split(coalesce(text_raw, ''), ' '), lambda w: w <> ''))::int as words, array_to_string(list_filter(string_split(coalesce(review_reasons, ''), '|'), lambda x: trim(x) <> ''), ',') as reasons,
    case when peak is not null then round(20 * log10(greatest(peak, 1e-12)), 6) end as peak_dbfs, nfc_normalize(text_raw) as composed, try_cast(example_id as double) as number from dataset_audit""")
def sql_functions(spark, d):
    """The functions as SQL sees them."""
    T.register(spark)
    parquet(spark, d, "dataset_audit").createOrReplaceTempView("vox_audit")
    return spark.sql("""select record_no, loaded_at, vox_word_count(text_raw) as words, array_join(vox_listed(review_reasons), ',') as reasons, case when peak is not null then round(vox_decibels(peak), 6) end as peak_dbfs,
        vox_nfc(text_raw) as composed, vox_parsed(example_id) as number from vox_audit""")
