"""Queries of the audit, review and mixture operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import signal as S
from ..functions import text as T
from ..operators import audit, mixture, review
from ..session import scratch_path
from ..sources import readers, sinks
from ..sources.readers import parquet
from .registry import query

_TEST = {
    "too_short": "duration_seconds < 1.0", "too_long_requires_alignment": "duration_seconds > 35.0", "silent_audio": "peak <= 1e-6", "very_low_rms": "rms_dbfs < -45.0",
    "clipping": "clipping_fraction > 0.001", "long_leading_silence": "leading_silence_seconds > 1.5", "long_trailing_silence": "trailing_silence_seconds > 2.0",
    "low_text_audio_ratio": "words_per_second < 0.4", "high_text_audio_ratio": "words_per_second > 3.5",
}
FLAGS = "list_filter([case when trim(coalesce(text_normalized, '')) = '' then 'empty_normalized_text' end, " + ", ".join(f"case when decode_ok and {t} then '{n}' end" for n, t in _TEST.items()) + ", case when not coalesce(decode_ok, false) then 'decode_error' end], lambda x: x is not null)"
STATUS = "case when list_has_any(f, ['decode_error', 'empty_normalized_text', 'silent_audio', 'too_short']) then 'reject' when len(f) > 0 then 'review' else 'accept' end"


@query(f"select record_no, loaded_at, array_to_string(f, '|') as flags, {STATUS} as severity, actions from (select record_no, loaded_at, {FLAGS} as f, array_to_string(list_filter([case when sample_rate <> 16000 then 'resample_to_16khz' end, case when channels <> 1 then 'downmix_to_mono' end], lambda x: x is not null), '|') as actions from dataset_audit)")
def audit_status(spark, d):
    flags = audit.quality_flags()
    return parquet(spark, d, "dataset_audit").select("record_no", "loaded_at", T.joined(flags).alias("flags"), audit.severity(flags).alias("severity"), T.joined(audit.format_actions()).alias("actions"))


@query(f"select source, split, item, count(*) as count from (select source, split, unnest({FLAGS}) as item from dataset_audit) group by 1, 2, 3")
def audit_reason_counts(spark, d):
    return audit.item_histogram(parquet(spark, d, "dataset_audit"), audit.quality_flags(), "source", "split")


@query("""select source, split, count(*) as examples, count(*) filter (decode_ok) as decoded, count(distinct coalesce(nullif(regexp_replace(speaker_id, '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g'), ''), 'unknown')) as speakers,
    round(sum(duration_seconds) / 3600, 6) as hours, min(duration_seconds) as shortest, max(duration_seconds) as longest from dataset_audit group by 1, 2""")
def audit_group_summary(spark, d):
    return audit.group_summary(parquet(spark, d, "dataset_audit")).withColumn("hours", F.round("hours", 6))


@query("select source, split, status, count(*) as count from dataset_audit group by 1, 2, 3")
def status_counts(spark, d):
    return audit.grouped(parquet(spark, d, "dataset_audit"), "source", "split", "status")


@query("""select count(*) as examples, count(*) filter (decode_ok) as decoded, count(*) filter (status = 'accept') as accept, count(*) filter (status = 'review') as review, count(*) filter (status = 'reject') as reject,
    count(*) filter (audio_duplicate_cross_split) as audio_cross_split, count(*) filter (text_duplicate_cross_split) as text_cross_split, round(sum(duration_seconds) / 3600, 6) as hours from dataset_audit""")
def audit_totals(spark, d):
    return audit.totals(parquet(spark, d, "dataset_audit")).withColumn("hours", F.round("hours", 6))


def _groups_sql(key, present="true", members=""):
    return f"""select {key} as sha256, count(*) as count, count(distinct split) > 1 as cross_split{members} from dataset_audit where trim({key}) <> '' and {present} group by 1 having count(*) >= 2"""


@query(_groups_sql("text_sha256", "trim(text_normalized) <> ''"))
def dup_groups_text(spark, d):
    return audit.duplicate_groups(parquet(spark, d, "dataset_audit"), "text_sha256", "text_normalized")


@query(_groups_sql("audio_sha256"))
def dup_groups_audio(spark, d):
    return audit.duplicate_groups(parquet(spark, d, "dataset_audit"), "audio_sha256")


def _report(rows, **limits):
    """A row per group, as the SQL has it, so the parts of a large group are put together as text."""
    parts = audit.group_parts(rows.withColumn("at", F.concat_ws(":", "source", "split", F.col("row_index").cast("string"))), "audio_sha256", member=("at",), **limits)
    texts = parts.select("sha256", "count", "cross_split", F.struct("part", F.array_join("members.at", ",").alias("text")).alias("x"))
    return texts.groupBy("sha256", "count", "cross_split").agg(F.array_join(F.sort_array(F.collect_list("x")).text, ",").alias("members"))


@query(_groups_sql("audio_sha256", members=", array_to_string(list_sort(list(source || ':' || split || ':' || row_index)), ',') as members"))
def dup_report_audio(spark, d):
    """The groups as the report has them, with their members."""
    return _report(parquet(spark, d, "dataset_audit"))


@query("""select record_no, loaded_at, group_count, cross_split from (select *, count(*) over (partition by audio_sha256) as group_count, min(split) over (partition by audio_sha256) <> max(split) over (partition by audio_sha256) as cross_split
    from dataset_audit where trim(audio_sha256) <> '') where group_count >= 2""")
def dup_members_audio(spark, d):
    return audit.duplicate_members(parquet(spark, d, "dataset_audit"), "audio_sha256").select("record_no", "loaded_at", "group_count", "cross_split")


@query("""select record_no, loaded_at, coalesce(n > 1, false) as in_several from dataset_audit left join (select text_sha256 as k, count(distinct split) as n from dataset_audit where trim(text_sha256) <> '' group by 1) on text_sha256 = k""")
def cross_split_flags(spark, d):
    return audit.leakage_flags(parquet(spark, d, "dataset_audit"), "text_sha256").select("record_no", "loaded_at", "in_several")


@query("select distinct m.source, m.split, m.row_index from (select unnest(members) as m from duplicate_groups)")
def duplicate_member_keys(spark, d):
    return readers.group_members(parquet(spark, d, "duplicate_groups"))


@query("""select a.record_no, a.loaded_at, k.row_index is not null as reported from dataset_audit a left join (select distinct m.source, m.split, m.row_index from (select unnest(members) as m from duplicate_groups)) k
    on a.source = k.source and a.split = k.split and a.row_index = k.row_index""")
def reported_duplicates(spark, d):
    keys = readers.group_members(parquet(spark, d, "duplicate_groups")).withColumn("reported", F.lit(True))
    marked = parquet(spark, d, "dataset_audit").join(keys, ["source", "split", "row_index"], "left")
    return marked.select("record_no", "loaded_at", F.coalesce("reported", F.lit(False)).alias("reported"))


@query("select source, speaker_id, count(distinct split) as splits, count(*) as rows from dataset_audit where trim(speaker_id) <> '' group by 1, 2 having count(distinct split) > 1")
def speaker_overlap(spark, d):
    return audit.speaker_overlap(parquet(spark, d, "dataset_audit"))


@query("""select source, count(*) filter (duration_seconds <= 35) as rows_within, count(*) filter (duration_seconds > 35) as rows_over, round(sum(duration_seconds) filter (duration_seconds <= 35) / 3600, 6) as hours_within,
    round(sum(duration_seconds) filter (duration_seconds > 35) / 3600, 6) as hours_over, round(median(words_per_second), 6) as median_words_per_second from dataset_audit where decode_ok group by 1""")
def length_statistics(spark, d):
    out = audit.length_statistics(parquet(spark, d, "dataset_audit"))
    return out.withColumns({c: F.round(c, 6) for c in ("hours_within", "hours_over", "median_words_per_second")})


@query("select sample_rate, channels, count(*) as count, count(*) filter (contains(text_raw, chr(10)) and duration_seconds > 35) as long_multi_line from dataset_audit group by 1, 2")
def format_counts(spark, d):
    both = F.col("text_raw").contains("\n") & (F.col("duration_seconds") > 35)
    return parquet(spark, d, "dataset_audit").groupBy("sample_rate", "channels").agg(F.count("*").alias("count"), F.count_if(both).alias("long_multi_line"))


@query("select source, split, row_index, record_no, loaded_at from dataset_audit where row_index < 25")
def rows_capped(spark, d):
    return readers.capped(parquet(spark, d, "dataset_audit"), 25).select("source", "split", "row_index", "record_no", "loaded_at")


@query("select record_no, loaded_at, split from dataset_audit where source = (select max(source) from dataset_audit) and dataset_revision = (select max(dataset_revision) from dataset_audit where source = (select max(source) from dataset_audit))")
def pinned_source(spark, d):
    df = parquet(spark, d, "dataset_audit")
    source, revision = df.agg(F.max(F.struct("source", "dataset_revision")).alias("x")).select("x.*").first()
    return readers.pinned(df, source, revision).select("record_no", "loaded_at", "split")


@query("select record_no, source, split, row_index, text_raw from dataset_audit qualify row_number() over (partition by record_no order by loaded_at desc) = 1")
def latest_deliveries(spark, d):
    df = parquet(spark, d, "dataset_audit").select("record_no", "loaded_at", "source", "split", "row_index", "text_raw")
    return audit.latest(df, ["record_no"], "loaded_at").drop("loaded_at")


@query("select distinct source, split, row_index, record_no, dense_rank() over (partition by source, split order by row_index) - 1 as position from dataset_audit")
def stored_positions(spark, d):
    rows = parquet(spark, d, "dataset_audit").select("source", "split", "row_index", "record_no").distinct()
    return audit.positions(rows, ["source", "split"], ["row_index"]).withColumn("position", F.col("position").cast("bigint"))


@query("select source, 'train' as split, count(*) as rows from dataset_audit where split = 'train' group by 1 union all select source, 'other', count(*) from dataset_audit where split <> 'train' group by 1")
def split_union_counts(spark, d):
    df = parquet(spark, d, "dataset_audit")
    both = df.filter("split = 'train'").select("source", F.lit("train").alias("split")).unionByName(df.filter("split <> 'train'").select("source", F.lit("other").alias("split")))
    return both.groupBy("source", "split").agg(F.count("*").alias("rows"))


@query("select s.source, n.split from (select distinct source from dataset_audit) s cross join (values ('train'), ('validation'), ('test'), ('held_out')) n(split) where not exists (select 1 from dataset_audit a where a.source = s.source and a.split = n.split)")
def missing_splits(spark, d):
    return review.require_splits(parquet(spark, d, "dataset_audit"), ("train", "validation", "test", "held_out"))


# --- manifests


@query("select * exclude (reviewed_at) from decision_manifest_reviewed qualify row_number() over (partition by review_id order by reviewed_at desc) = 1")
def deciding_rows(spark, d):
    return review.deciding_rows(parquet(spark, d, "decision_manifest_reviewed")).drop("reviewed_at")


@query("select source, coalesce(nullif(regexp_replace(lower(final_decision), '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g'), ''), 'pending') as decision, count(*) as count from decision_manifest_reviewed group by 1, 2")
def review_progress(spark, d):
    return review.progress(parquet(spark, d, "decision_manifest_reviewed"))


@query("select suggested_decision, priority, count(*) as count from decision_manifest_reviewed group by 1, 2")
def suggestion_counts(spark, d):
    return audit.grouped(parquet(spark, d, "decision_manifest_reviewed"), "suggested_decision", "priority")


@query("select priority, source, split, row_index, review_id, reviewed_at from decision_manifest_reviewed where suggested_decision <> 'keep' order by priority, source, split, row_index")
def review_queue(spark, d):
    return review.review_queue(parquet(spark, d, "decision_manifest_reviewed")).select("priority", "source", "split", "row_index", "review_id", "reviewed_at")


@query("select review_id, reviewed_at from decision_manifest_reviewed where split = 'train' and trim(coalesce(final_decision, '')) = ''")
def pending_reviews(spark, d):
    return review.pending_rows(parquet(spark, d, "decision_manifest_reviewed"), split="train").select("review_id", "reviewed_at")


@query("select distinct record_no, duration_seconds from dataset_audit where duration_seconds is not null order by duration_seconds desc, record_no limit 100")
def longest_recordings(spark, d):
    rows = parquet(spark, d, "dataset_audit").select("record_no", "duration_seconds").distinct().filter("duration_seconds is not null")
    return audit.top_rows(rows, [F.desc("duration_seconds"), "record_no"], 100)


@query("""with q as (select * from decision_manifest_reviewed qualify row_number() over (partition by review_id order by reviewed_at desc) = 1),
    p as (select *, case when trim(coalesce(final_decision, '')) = '' then review_id end as pending from q)
    select review_id, source, row_number() over w as place, coalesce(first_value(pending ignore nulls) over (partition by source order by priority, split, row_index, review_id rows between 1 following and unbounded following),
    first_value(pending ignore nulls) over (partition by source order by priority, split, row_index, review_id rows between unbounded preceding and unbounded following)) as next_pending from p
    window w as (partition by source order by priority, split, row_index, review_id)""")
def next_pending(spark, d):
    out = review.next_pending(review.deciding_rows(parquet(spark, d, "decision_manifest_reviewed")))
    return out.withColumn("place", F.col("place").cast("bigint"))


@query("""select distinct concat_ws(':', source, split, row_index) as review_id, 'left' as side from dataset_audit where concat_ws(':', source, split, row_index) not in (select review_id from decision_manifest_reviewed)
    union all select distinct review_id, 'right' from decision_manifest_reviewed where review_id not in (select concat_ws(':', source, split, row_index) from dataset_audit)""")
def manifest_key_diff(spark, d):
    keys = parquet(spark, d, "dataset_audit").select(T.record_key(F.col("source"), F.col("split"), F.col("row_index")).alias("review_id"))
    return review.key_difference(keys, parquet(spark, d, "decision_manifest_reviewed"), "review_id")


@query("select review_id, count(*) as rows from decision_manifest_reviewed group by 1 having count(*) > 1")
def repeated_reviews(spark, d):
    return review.repeated_keys(parquet(spark, d, "decision_manifest_reviewed"), "review_id")


@query("select coalesce(final_decision, '') as value, count(*) as rows from decision_manifest_reviewed where coalesce(final_decision, '') not in ('', 'keep', 'trim', 'segment', 'exclude') group by 1")
def foreign_decisions(spark, d):
    return review.foreign_values(parquet(spark, d, "decision_manifest_reviewed"), "final_decision", ["", "keep", "trim", "segment", "exclude"])


@query("""select record_no, loaded_at, round(greatest(0.0, leading_silence_seconds), 3) as trim_start, round(greatest(round(greatest(0.0, leading_silence_seconds), 3), duration_seconds - trailing_silence_seconds), 3) as trim_end
    from dataset_audit where decode_ok and duration_seconds is not null and leading_silence_seconds is not null and trailing_silence_seconds is not null""")
def default_trims(spark, d):
    rows = parquet(spark, d, "dataset_audit").filter("decode_ok").dropna(subset=["duration_seconds", "leading_silence_seconds", "trailing_silence_seconds"])
    trim = review.default_trim(F.col("duration_seconds"), F.col("leading_silence_seconds"), F.col("trailing_silence_seconds"))
    return rows.select("record_no", "loaded_at", trim.alias("t")).select("record_no", "loaded_at", F.col("t.start").alias("trim_start"), F.col("t.end").alias("trim_end"))


@query("""select review_id, reviewed_at, coalesce(s >= 0 and s < e and e <= dur + 1e-3, false) as valid from (select review_id, reviewed_at, case when not isnan(try_cast(trim_start_seconds as double)) then try_cast(trim_start_seconds as double) end as s,
    case when not isnan(try_cast(trim_end_seconds as double)) then try_cast(trim_end_seconds as double) end as e, try_cast(duration_seconds as double) as dur from decision_manifest_reviewed)""")
def trim_validity(spark, d):
    m = parquet(spark, d, "decision_manifest_reviewed")
    valid = review.trim_is_valid(T.parsed(F.col("trim_start_seconds")), T.parsed(F.col("trim_end_seconds")), T.parsed(F.col("duration_seconds")))
    return m.select("review_id", "reviewed_at", valid.alias("valid"))


@query("""select a.record_no, coalesce(m.final_decision, 'open') as decision from (select record_no, any_value(concat_ws(':', source, split, row_index)) as review_id from dataset_audit group by 1) a
    left join (select review_id, final_decision from decision_manifest_reviewed qualify row_number() over (partition by review_id order by reviewed_at desc) = 1) m using (review_id)""")
def decisions_applied(spark, d):
    rows = parquet(spark, d, "dataset_audit").select("record_no", T.record_key(F.col("source"), F.col("split"), F.col("row_index")).alias("review_id")).distinct().withColumn("final_decision", F.lit("open"))
    made = review.deciding_rows(parquet(spark, d, "decision_manifest_reviewed").select("review_id", "reviewed_at", "final_decision"))
    return review.apply_decisions(rows, made, "review_id", "final_decision").select("record_no", F.col("final_decision").alias("decision"))


@query("""select m.review_id, m.reviewed_at, a.record_no, a.audio_sha256 from decision_manifest_reviewed m join (select distinct source, split, row_index, record_no, audio_sha256 from dataset_audit) a
    on m.source = a.source and m.split = a.split and m.row_index = a.row_index""")
def manifest_with_audio(spark, d):
    audio = parquet(spark, d, "dataset_audit").select("source", "split", "row_index", "record_no", "audio_sha256").distinct()
    return parquet(spark, d, "decision_manifest_reviewed").join(audio, ["source", "split", "row_index"]).select("review_id", "reviewed_at", "record_no", "audio_sha256")


# --- mixtures


@query("select distinct record_no, split, case split when 'train' then 'train' when 'validation' then 'dev' when 'test' then 'test' end as output_split, source as corpus, 'und' as language from dataset_audit")
def output_splits(spark, d):
    return parquet(spark, d, "dataset_audit").select("record_no", "split", mixture.output_split(F.col("split")).alias("output_split"), F.col("source").alias("corpus"), F.lit("und").alias("language")).distinct()


@query("select corpus, split, count(*) as examples, sum(audio_size)::bigint as samples, round(sum(audio_size) / 16000.0 / 3600, 6) as hours from mixture_rows group by 1, 2")
def mixture_counts(spark, d):
    return mixture.counts_and_hours(parquet(spark, d, "mixture_rows"), "corpus", "split").withColumn("hours", F.round("hours", 6))


@query("""with h as (select corpus, sum(audio_size) / 16000.0 / 3600 as hours from mixture_rows where split = 'train' group by 1), t as (select *, pow(hours / sum(hours) over (), 0.5) as t from h)
    select corpus, round(hours, 6) as hours, round(t / sum(t) over (), 6) as weight from t""")
def mixture_weights(spark, d):
    return mixture.sampling_weights(parquet(spark, d, "mixture_rows")).withColumns({"hours": F.round("hours", 6), "weight": F.round("weight", 6)})


@query("""with h as (select corpus, sum(audio_size) / 16000.0 / 3600 as hours from mixture_rows where split = 'train' group by 1)
    select corpus, round(hours / sum(hours) over (), 6) as proportional, round(1.0::double / count(*) over (), 6) as equal from h""")
def mixture_alternatives(spark, d):
    rows = parquet(spark, d, "mixture_rows")
    a = mixture.sampling_weights(rows, 1.0).select("corpus", F.round("weight", 6).alias("proportional"))
    return a.join(mixture.sampling_weights(rows, 0.0).select("corpus", F.round("weight", 6).alias("equal")), "corpus")


@query("select record_no, corpus, split, audio_size from mixture_rows where audio_size between 16000 and 320000")
def length_filter(spark, d):
    return mixture.within_length(parquet(spark, d, "mixture_rows"), 16_000, 320_000).select("record_no", "corpus", "split", "audio_size")


@query("""select record_no, corpus, split, printf('part-%05d', ((row_number() over (partition by corpus, split order by record_no) - 1) // 100)::int) as part from (select distinct record_no, corpus, split from mixture_rows)""")
def part_numbers(spark, d):
    rows = parquet(spark, d, "mixture_rows").select("record_no", "corpus", "split").distinct()
    return mixture.part_numbers(rows, ["corpus", "split"], ["record_no"])


@query("""select count(*) as rows, min(audio_size) as smallest, max(audio_size) as largest, array_to_string(list_sort(list(distinct corpus)), '|') as corpora, array_to_string(list_sort(list(distinct split)), '|') as splits,
    array_to_string(list_sort(list(distinct language)), '|') as languages, count(*) filter (text is null or trim(text) = '') as blank_texts from mixture_rows""")
def mixture_verification(spark, d):
    return mixture.verification(parquet(spark, d, "mixture_rows"))


@query("select corpus, split, language, record_no, audio_size, text from mixture_rows where split = 'dev' and audio_size <= 320000")
def hive_round_trip(spark, d):
    """Written under Hive directories and read again, with the filters pushed to directories and row groups."""
    root = scratch_path(spark, "mixture")
    sinks.mixture(parquet(spark, d, "mixture_rows"), root)
    return readers.mixture(spark, root).filter("split = 'dev' and audio_size <= 320000").select("corpus", "split", "language", "record_no", "audio_size", "text")


@query()
def length_batches(spark, d):
    rows = parquet(spark, d, "mixture_rows").filter("split = 'train'")
    return mixture.batches(rows, ["corpus"], ["record_no", "audio_size"], 2_000_000)


@query("select record_no, corpus, split, rank from (select record_no, corpus, split, row_number() over (partition by corpus, split order by sha256('0:' || record_no), record_no) as rank from (select distinct record_no, corpus, split from mixture_rows)) where rank <= 5")
def listening_sample(spark, d):
    rows = parquet(spark, d, "mixture_rows").select("record_no", "corpus", "split").distinct()
    return mixture.stratified_sample(rows, ["corpus", "split"], "record_no", 5).withColumn("rank", F.col("rank").cast("bigint"))


@query("""select record_no, sha256(b) as sha256, sha256(b) as sha256_arrow from (select record_no, unhex(array_to_string(list_transform(audio_bytes, lambda x: printf('%02x', (x::int + 256) % 256)), '')) as b from mixture_rows)""")
def audio_byte_hashes(spark, d):
    """SHA-256 of the bytes behind the signed-byte lists; an expression and an Arrow function give the same."""
    b = F.col("audio_bytes")
    return parquet(spark, d, "mixture_rows").select("record_no", S.bytes_fingerprint(S.signed_to_binary(b)).alias("sha256"), S.bytes_fingerprint(S.signed_to_binary_long(b)).alias("sha256_arrow"))


@query("""select 'empty_split' as guard, (select count(*) from (values ('train'), ('dev'), ('test')) n(s) where s not in (select split from mixture_rows))::bigint as violations
    union all select 'leaking_text', (select count(*) from (select text from mixture_rows where text <> '' group by text having count(distinct split) > 1))::bigint
    union all select 'too_many_rejects', (select (avg((status = 'reject')::int) > 0.2)::int from dataset_audit)::bigint""")
def abort_guards(spark, d):
    rows, audited = parquet(spark, d, "mixture_rows"), parquet(spark, d, "dataset_audit")
    empty = rows.agg(F.collect_set("split").alias("s")).select(F.lit("empty_split").alias("guard"), F.size(F.array_except(F.array(*map(F.lit, ["train", "dev", "test"])), "s")).cast("bigint").alias("violations"))
    leaks = rows.filter("text <> ''").groupBy("text").agg(F.countDistinct("split").alias("n")).filter("n > 1").agg(F.count("*").alias("violations")).select(F.lit("leaking_text").alias("guard"), "violations")
    rejects = audited.agg((F.avg((F.col("status") == "reject").cast("int")) > 0.2).cast("bigint").alias("violations")).select(F.lit("too_many_rejects").alias("guard"), "violations")
    return empty.unionByName(leaks).unionByName(rejects)
