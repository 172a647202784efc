"""Queries of evaluation, waveforms and telemetry."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import signal as S
from ..functions import text as T
from ..operators import evaluate, telemetry
from ..session import scratch_path
from ..sources.readers import parquet
from ..streaming import telemetry as streams
from .registry import query

# a dynamic program row by row: the accumulator is the table's last row
_R, _H = "list_transform(coalesce(reference, []), lambda w: coalesce(w, ''))", "list_transform(coalesce(hypothesis, []), lambda w: coalesce(w, ''))"
_DP = """list_last(list_reduce({r}, lambda prev, w: list_reduce(range(1, len({h}) + 1),
    lambda acc, j: list_append(acc, least(acc[j] + 1, prev[j + 1] + 1, prev[j] + ({h}[j] <> w)::bigint)), [prev[1] + 1]), range(0, len({h}) + 1)))"""
SCORED = f"""(select *, len(coalesce(reference, []))::int as words, {_DP.format(r='rr', h='hh')}::int as word_errors, length(array_to_string(rr, ''))::int as characters,
    {_DP.format(r='rc', h='hc')}::int as character_errors from (select *, {_R} as rr, {_H} as hh, string_split(array_to_string({_R}, ''), '') as rc0, string_split(array_to_string({_H}, ''), '') as hc0,
    list_filter(rc0, lambda x: x <> '' and x <> ' ') as rc, list_filter(hc0, lambda x: x <> '' and x <> ' ') as hc from panel_predictions))"""


def _scored(spark, d):
    return evaluate.scored(parquet(spark, d, "panel_predictions"))


@query(f"select record_no, corpus, split, words, word_errors, round(word_errors::double / greatest(1, words), 6) as wer, character_errors from {SCORED}")
def wer_pairs(spark, d):
    wer = F.round(F.col("word_errors") / F.greatest(F.lit(1), F.col("words")), 6)
    return _scored(spark, d).select("record_no", "corpus", "split", "words", "word_errors", wer.alias("wer"), "character_errors")


@query(f"""select corpus, count(*) as examples, round(sum(word_errors)::double / greatest(1, sum(words)), 6) as wer, round(sum(character_errors)::double / greatest(1, sum(characters)), 6) as cer,
    round(avg((word_errors = 0)::int), 6) as exact, round(avg((len(coalesce(hypothesis, [])) = 0)::int), 6) as empty from {SCORED} group by 1""")
def wer_micro(spark, d):
    return evaluate.micro(_scored(spark, d), "corpus").withColumns({c: F.round(c, 6) for c in ("wer", "cer", "exact", "empty")})


@query(f"""with m as (select corpus, sum(word_errors)::double / greatest(1, sum(words)) as wer, sum(character_errors)::double / greatest(1, sum(characters)) as cer from {SCORED} group by 1)
    select round(avg(wer), 6) as macro_wer, round(avg(cer), 6) as macro_cer, round(max(wer), 6) as worst_wer, (select corpus from m order by wer desc, corpus desc limit 1) as worst from m""")
def wer_macro(spark, d):
    return evaluate.macro(_scored(spark, d), "corpus").withColumns({c: F.round(c, 6) for c in ("macro_wer", "macro_cer", "worst_wer")})


@query(f"select corpus, split, count(*) as examples, round(sum(word_errors)::double / greatest(1, sum(words)), 6) as wer from {SCORED} group by cube (corpus, split)")
def wer_slices(spark, d):
    return evaluate.slices(_scored(spark, d), "corpus", "split").withColumn("wer", F.round("wer", 6))


_DRAWN = " + ".join(f"(u > {x})::int" for x in evaluate._POISSON)


@query(f"""select corpus, round(quantile_cont(wer, 0.025), 6) as low, round(quantile_cont(wer, 0.975), 6) as high from (select corpus, round, sum(word_errors * times)::double / greatest(1, sum(words * times)) as wer
    from (select corpus, round, word_errors, words, {_DRAWN} as times from (select *, (('0x' || substr(md5('7:' || round || ':' || record_no), 1, 8))::bigint + 0.5) / 4294967296.0 as u from {SCORED}, range(1, 201) t(round))) group by 1, 2) group by 1""")
def wer_intervals(spark, d):
    return evaluate.bootstrap(_scored(spark, d), "corpus", "record_no").withColumns({c: F.round(c, 6) for c in ("low", "high")})


@query()
def wer_edit_kinds(spark, d):
    return evaluate.edit_totals(parquet(spark, d, "panel_predictions"), "corpus")


@query("""select corpus, record_no, audio_sha256, rank, 'dev_' || lpad((row_number() over (order by corpus, rank))::varchar, 2, '0') as label from (select p.corpus, p.record_no, p.audio_sha256,
    row_number() over (partition by p.corpus order by p.audio_sha256, p.record_no) as rank from (select distinct record_no, corpus, audio_sha256 from panel_predictions) p
    join (select record_no, max(audio_size) as audio_size from mixture_rows group by 1) m using (record_no) where audio_size between 64000 and 224000) where rank <= 2""")
def panel_topk(spark, d):
    sizes = parquet(spark, d, "mixture_rows").groupBy("record_no").agg(F.max("audio_size").alias("audio_size"))
    rows = parquet(spark, d, "panel_predictions").select("record_no", "corpus", "audio_sha256").distinct().join(sizes, "record_no")
    return evaluate.panel(rows, 64_000, 224_000).select("corpus", "record_no", "audio_sha256", F.col("rank").cast("bigint").alias("rank"), "label")


@query("""with p as (select *, row_number() over (partition by audio_sha256 order by record_no desc) as k from panel_predictions), a as (select audio_sha256, max(record_no) as audit_record from dataset_audit where audio_sha256 is not null group by 1)
    select p.record_no, a.audit_record from p left join a using (audio_sha256) where k = 1""")
def panel_join(spark, d):
    """Panel rows matched to audited audio by hash; a repeated hash's last row counts, and unmatched ones stay with a null."""
    p = parquet(spark, d, "panel_predictions").groupBy("audio_sha256").agg(F.max("record_no").alias("record_no"))
    a = parquet(spark, d, "dataset_audit").filter("audio_sha256 is not null").groupBy("audio_sha256").agg(F.max("record_no").alias("audit_record"))
    return p.join(a, "audio_sha256", "left").select("record_no", "audit_record")


@query("""with l as (select corpus, record_no, row_number() over (partition by corpus order by record_no) as place from (select distinct corpus, record_no from panel_predictions where split = 'dev')),
    r as (select corpus, record_no as other_record_no, row_number() over (partition by corpus order by record_no) as place from (select distinct corpus, record_no from panel_predictions where split = 'test'))
    select l.corpus, l.place, record_no, other_record_no from l join r on l.corpus = r.corpus and l.place = r.place""")
def positional_zip(spark, d):
    p = parquet(spark, d, "panel_predictions").select("corpus", "record_no", "split").distinct()
    out = evaluate.positional_zip(p.filter("split = 'dev'").drop("split"), p.filter("split = 'test'").drop("split"), "record_no")
    return out.select("corpus", F.col("place").cast("bigint").alias("place"), "record_no", "other_record_no")


@query("""select c as character, count(*) as count from (select unnest(string_split(text, '')) as c from documents where text is not null) where not regexp_full_match(c, '[\\s\\p{Z}\\x85\\x1c-\\x1f]?')
    and c not in (select unnest(string_split(text_normalized, '')) from dataset_audit where text_normalized is not null) group by 1""")
def unknown_characters(spark, d):
    vocabulary = T.character_inventory(parquet(spark, d, "dataset_audit"), "text_normalized").select("character")
    return evaluate.unknown_characters(T.character_inventory(parquet(spark, d, "documents"), "text"), vocabulary)


# --- waveforms: an embedding's 64 numbers stand for samples at a rate of 16

_W = "list_transform(embedding, lambda x: x::double)"


@query(f"""select vec_id, round(p, 9) as peak, round(20 * log10(greatest(p, 1e-12)), 6) as peak_dbfs, round(r, 9) as rms, round(20 * log10(greatest(r, 1e-12)), 6) as rms_dbfs, len(w)::double / 16 as seconds,
    len(list_filter(w, lambda x: abs(x) >= 0.3))::double / len(w) as clipped from (select vec_id, w, list_max(list_transform(w, lambda x: abs(x))) as p, sqrt(list_sum(list_transform(w, lambda x: x * x)) / len(w)) as r
    from (select vec_id, {_W} as w from embeddings))""")
def signal_metrics(spark, d):
    w = F.col("embedding")
    return parquet(spark, d, "embeddings").select(
        "vec_id", F.round(S.peak(w), 9).alias("peak"), F.round(S.decibels(S.peak(w)), 6).alias("peak_dbfs"), F.round(S.rms(w), 9).alias("rms"), F.round(S.decibels(S.rms(w)), 6).alias("rms_dbfs"),
        S.seconds(w, F.lit(16)).alias("seconds"), S.clipping_fraction(w, 0.3).alias("clipped"),
    )


@query(f"""select vec_id, (list_position(a, true) - 1)::double / 16 as leading, (list_position(list_reverse(a), true) - 1)::double / 16 as trailing, round(t, 9) as threshold from
    (select vec_id, t, list_transform(w, lambda x: abs(x) >= t) as a from (select vec_id, w, greatest(1e-4, 0.01 * list_max(list_transform(w, lambda x: abs(x)))) as t from (select vec_id, {_W} as w from embeddings)))""")
def edge_silence(spark, d):
    return parquet(spark, d, "embeddings").select("vec_id", S.edge_silence(F.col("embedding"), F.lit(16)).alias("e")).select("vec_id", "e.leading", "e.trailing", F.round("e.threshold", 9).alias("threshold"))


@query(f"select vec_id, len(w)::int as samples, round(list_sum(w), 6) as total from (select vec_id, list_slice({_W}, 9, 40) as w from embeddings)")
def trimmed_signal(spark, d):
    w = S.trimmed(F.col("embedding"), F.lit(0.5), F.lit(2.5), 16)
    return parquet(spark, d, "embeddings").select("vec_id", F.size(w).alias("samples"), F.round(F.aggregate(w, F.lit(0.0), lambda a, x: a + x.cast("double")), 6).alias("total"))


@query("select vec_id, round(list_sum(list_transform(range(1, 33), lambda i: (embedding[i]::double + embedding[i + 32]::double) / 2)), 6) as total, 32 as samples from embeddings")
def downmixed_signal(spark, d):
    two = F.array(F.slice("embedding", 1, 32), F.slice("embedding", 33, 32))
    m = S.downmix(two)
    return parquet(spark, d, "embeddings").select("vec_id", F.round(F.aggregate(m, F.lit(0.0), lambda a, x: a + x), 6).alias("total"), F.size(m).alias("samples"))


@query("select vec_id, len(list_filter(embedding, lambda x: isnan(x) or isinf(x))) = 0 and len(embedding) > 0 as valid from embeddings")
def signal_validity(spark, d):
    return parquet(spark, d, "embeddings").select("vec_id", S.is_valid(F.col("embedding"), F.lit(16)).alias("valid"))


@query()
def sample_hashes(spark, d):
    return parquet(spark, d, "embeddings").select("vec_id", S.sample_fingerprint(F.col("embedding"), F.lit(16)).alias("sha256"))


# --- telemetry


@query("select user_id as device, greatest(0.0, max(value)) as highest, count(*) as samples from events group by 1")
def telemetry_maxima(spark, d):
    e = parquet(spark, d, "events")
    return telemetry.device_maxima(e, "user_id", "samples", highest="value")


@query("select user_id as device, greatest(0.0, max(value)) as highest from events group by 1")
def streamed_maxima(spark, d):
    """The same from a file stream that is drained once."""
    e = parquet(spark, d, "events")
    stream = streams.table_stream(spark, d, "events", e.schema)
    return streams.drained(telemetry.device_maxima(stream, "user_id", highest="value"), f"maxima_{uuid.uuid4().hex}", scratch_path(spark, "stream"))


@query("select user_id as step, count(*) filter (event_type = 'click') as click, count(*) filter (event_type = 'view') as view, count(*) filter (event_type = 'error') as error, sum(event_id)::bigint as bytes, least(click, view, error) >= 20 as complete from events group by 1")
def checkpoint_complete(spark, d):
    files = parquet(spark, d, "events").select(F.col("user_id").alias("step"), F.col("event_type").alias("kind"), F.col("event_id").alias("length"))
    return telemetry.checkpoint_states(files, 20, ("click", "view", "error"))


@query("select event_type, round(median(value), 6) as median, round(quantile_cont(value, 0.95), 6) as p95, count(*) as events from events group by 1")
def latency(spark, d):
    return telemetry.latency(parquet(spark, d, "events"), "value", "event_type").withColumns({c: F.round(c, 6) for c in ("median", "p95")})


@query("""select user_id as run, event_id as step, round(value - lag(value) over (partition by user_id order by event_id), 6) as change from events""")
def step_history(spark, d):
    m = parquet(spark, d, "events").select(F.col("user_id").alias("run"), F.col("event_id").alias("step"), F.col("value").alias("metric"))
    return telemetry.step_history(m).select("run", "step", F.round("change", 6).alias("change"))


@query("select user_id, round(sum(value) / count(*), 6) as seconds_per_step, round(sum(value) / count(*) * 500 / 60, 6) as minutes_500, round(sum(value) / count(*) * 5000 / 60, 6) as minutes_5000 from events group by 1")
def extrapolation(spark, d):
    sums = parquet(spark, d, "events").groupBy("user_id").agg(F.sum("value").alias("s"), F.count("*").alias("n"))
    per, a, b = telemetry.extrapolated(F.col("s"), F.col("n"))
    return sums.select("user_id", F.round(per, 6).alias("seconds_per_step"), F.round(a, 6).alias("minutes_500"), F.round(b, 6).alias("minutes_5000"))


@query("""select event_type, try_cast(json_extract_string(props, '$.k') as bigint) as k, count(*) as events from events group by 1, 2""")
def json_properties(spark, d):
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    return parquet(spark, d, "events").groupBy("event_type", k.alias("k")).agg(F.count("*").alias("events"))
