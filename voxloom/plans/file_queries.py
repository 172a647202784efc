"""Queries of sources, sinks, encoded audio and whole runs: what is written comes back, held against the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import signal as S
from ..functions import text as T
from ..operators import audit, evaluate, ingest, mixture, review, telemetry
from ..session import partitions, scratch_path, write_text
from ..sources import readers, sinks
from ..sources.readers import parquet
from ..streaming import telemetry as streams
from . import pipelines
from .registry import query
from .run_queries import SCORED


@query("select review_id, coalesce(final_decision, '') as final_decision, coalesce(segment_boundaries_seconds, '') as cuts from decision_manifest_reviewed")
def csv_by_header(spark, d):
    """Some columns of a CSV manifest, asked for in another order than they stand in."""
    m = parquet(spark, d, "decision_manifest_reviewed").drop("reviewed_at")
    path = scratch_path(spark, "csv")
    sinks.csv_table(m, path, m.columns[::-1], allow_empty=False)
    back = readers.csv_strings(spark, path, ["final_decision", "review_id", "segment_boundaries_seconds"], ["source"])
    return back.select("review_id", "final_decision", F.col("segment_boundaries_seconds").alias("cuts"))


@query("select * from (values ('columns that are missing'), ('existing CSV'), ('existing document'), ('no rows'), ('value out of range')) t(refused)")
def refusals(spark, d):
    """What readers and sinks refuse, tried out on the manifest."""
    m, refused = parquet(spark, d, "decision_manifest_reviewed").select("review_id", "source"), []
    csv, document = scratch_path(spark, "csv"), scratch_path(spark, "document")
    sinks.csv_table(m, csv, m.columns)
    sinks.json_document({}, document)
    tries = {
        "columns that are missing": lambda: readers.csv_strings(spark, csv, ["review_id"], ["final_decision"]), "existing CSV": lambda: sinks.csv_table(m, csv, m.columns), "existing document": lambda: sinks.json_document({}, document),
        "no rows": lambda: sinks.csv_table(m.filter("source is null and source is not null"), scratch_path(spark, "csv"), m.columns, allow_empty=False), "value out of range": lambda: readers.require_range("seconds", 41.0, 0.0, 40.0),
    }
    for name, attempt in tries.items():
        try:
            attempt()
        except Exception:  # each kind of refusal has its own error, which the tests name
            refused.append((name,))
    return spark.createDataFrame(refused, "refused string")


@query("select source, split, count(*) as examples, count(*) filter (decode_ok) as decoded from dataset_audit group by 1, 2")
def json_summary(spark, d):
    """The summary document of an audit, written as a whole and read again."""
    path = scratch_path(spark, "summary")
    sinks.json_document({"groups": [r.asDict() for r in audit.group_summary(parquet(spark, d, "dataset_audit")).collect()]}, path)
    return readers.json_document(spark, path).select(F.explode("groups").alias("g")).select("g.source", "g.split", "g.examples", "g.decoded")


@query(f"select row_number() over (order by label) - 1 as place, record_no, audio_sha256, label from ({query.sql['panel_topk']})")
def json_panel(spark, d):
    """The listening panel as a document of examples, by their place in it."""
    path = scratch_path(spark, "panel")
    rows = query.queries["panel_topk"](spark, d).orderBy("label").collect()  # a few rows a corpus
    sinks.json_document({"examples": [{k: r[k] for k in ("record_no", "audio_sha256", "label")} for r in rows]}, path)
    return readers.panel_examples(readers.json_document(spark, path)).select(F.col("place").cast("bigint").alias("place"), "record_no", "audio_sha256", "label")


def _logs(spark, d, template: str) -> str:
    """A log record of each event, in as many files as the table has parts."""
    path = scratch_path(spark, "logs")
    events = parquet(spark, d, "events")
    fault = F.when(F.col("event_type") == "error", F.format_string("\nOverflow detected at step %d", "event_id")).otherwise("")
    events.select(F.concat(F.format_string(template, "event_id", F.col("value").cast("string")), fault)).write.text(path)
    return path


@query("select event_id as step, value as metric from events")
def log_extract(spark, d):
    """Steps and metrics out of whole log files whose records wrap over lines."""
    return telemetry.log_metrics(readers.whole_texts(spark, _logs(spark, d, "step %d | validation\n  wer: %s")), "value", r"step (\d+) \| validation\s+wer:\s*([\d.E+-]+)")


@query("select count(*) filter (event_type = 'error') as overflows from events")
def log_overflows(spark, d):
    logs = readers.whole_texts(spark, _logs(spark, d, "step %d wer %s"))
    return logs.agg(F.sum(telemetry.overflow_count(F.col("value"))).cast("bigint").alias("overflows"))


@query("select event_id as step, value as metric from events")
def log_stream(spark, d):
    """The same from a stream of lines."""
    stream = streams.log_metrics(spark, _logs(spark, d, "step %d wer %s"), r"step (\d+) wer ([\d.E+-]+)")
    return streams.drained(stream, "log_stream", scratch_path(spark, "stream"), "append")


@query("select user_id as device, greatest(0.0, max(value)) as memory, greatest(0.0, max(event_id)) as utilization from events group by 1")
def sample_stream(spark, d):
    """Device maxima from a stream of CSV samples."""
    path, none = scratch_path(spark, "samples"), F.lit("").alias
    e = parquet(spark, d, "events")
    e.select(F.col("ts").cast("string").alias("timestamp"), F.col("user_id").alias("gpu_index"), F.col("value").alias("memory_used_mib"), none("memory_total_mib"), F.col("event_id").alias("utilization_percent"), none("temperature_celsius"), none("power_watts")).write.option("header", "true").csv(path)
    return streams.drained(streams.running_maxima(streams.samples(spark, path)), "sample_stream", scratch_path(spark, "stream"))


# --- file trees: a file for each nation stands for a device's part of a checkpoint, its region for the step

_KINDS = ("trainer/rank_{}.pt", "model/pp_00/sdp_{}.pt", "optimizer/pp_00/sdp_{}.pt", "data_reader/dp_{}.pt")
_KIND_SQL = "case n_nationkey % 4 when 0 then 'trainer' when 1 then 'model' when 2 then 'optimizer' else 'data_reader' end"


def _tree(spark, d) -> str:
    root = scratch_path(spark, "tree")
    for r in parquet(spark, d, "nation").collect():  # a table of fixed size
        write_text(spark, f"{root}/step_{r['n_regionkey']}/{_KINDS[r['n_nationkey'] % 4].format(r['n_nationkey'])}", r["n_name"])
    write_text(spark, f"{root}/step_9.tmp/trainer/rank_0.pt", "left out")
    return root


@query(f"""select n_regionkey::bigint as step, count(*) filter (k = 'trainer') as trainer, count(*) filter (k = 'model') as model, count(*) filter (k = 'optimizer') as optimizer, count(*) filter (k = 'data_reader') as data_reader,
    sum(length(n_name))::bigint as bytes, least(trainer, model, optimizer, data_reader) >= 1 as complete from (select *, {_KIND_SQL} as k from nation) group by 1""")
def checkpoint_tree(spark, d):
    return telemetry.checkpoint_states(telemetry.checkpoint_files(readers.file_inventory(spark, _tree(spark, d))), 1)


@query(f"select max(step)::bigint as step from (select n_regionkey as step from nation group by 1 having count(distinct {_KIND_SQL}) = 4)")
def resume_step(spark, d):
    return telemetry.resume_step(checkpoint_tree(spark, d))


@query("select 'step_' || n_regionkey as directory, sum(length(n_name))::bigint as bytes, count(*) as files from nation group by 1")
def directory_sizes(spark, d):
    sizes = telemetry.directory_sizes(readers.file_inventory(spark, _tree(spark, d)))
    return sizes.select(F.regexp_extract("directory", "[^/]+$", 0).alias("directory"), "bytes", "files")


@query("select n_nationkey::int as device, sha256(n_name) as sha256 from nation")
def file_hashes(spark, d):
    """Hashes of the files of one depth."""
    root = _tree(spark, d)
    both = [readers.file_hashes(spark, f"{root}/step_[0-9]/{p}") for p in ("trainer/*.pt", "data_reader/*.pt", "*/pp_00/*.pt")]
    return both[0].union(both[1]).union(both[2]).select(F.regexp_extract("path", r"_(\d+)\.pt$", 1).cast("int").alias("device"), "sha256")


@query("select 'step_' || n_regionkey || '/trainer/rank_' || n_nationkey || '.pt' as file, 'left' as side from nation where n_nationkey % 4 <> 0")
def missing_files(spark, d):
    """Files that every device ought to have and that a tree lacks."""
    needed = parquet(spark, d, "nation").select(F.format_string("step_%d/trainer/rank_%d.pt", "n_regionkey", "n_nationkey").alias("file"))
    there = readers.file_inventory(spark, _tree(spark, d)).select(F.regexp_extract("path", r"(step_\d+/trainer/[^/]+)$", 1).alias("file")).filter("file <> ''")
    return review.key_difference(needed, there, "file")


@query("select n_name as name, n_nationkey + 100 as value, n_regionkey as held from nation")
def settings(spark, d):
    """A nested configuration with a value changed for each nation and the others as they were."""
    rows = parquet(spark, d, "nation").collect()  # a table of fixed size
    given = {"run": {r["n_name"]: {"value": r["n_nationkey"], "held": r["n_regionkey"]} for r in rows}}
    new = readers.overridden(given, {f"run.{r['n_name']}.value": r["n_nationkey"] + 100 for r in rows}, {f"run.{r['n_name']}.held": r["n_regionkey"] for r in rows})
    return spark.createDataFrame([(k, v["value"], v["held"]) for k, v in new["run"].items()], "name string, value int, held int")


# --- mixtures


@query("select corpus, split, language, count(*) as rows, 0::bigint as too_long from mixture_rows group by 1, 2, 3")
def mixture_files(spark, d):
    """Rows of each directory of a mixture as written, and its files of more rows than a file may have."""
    root = scratch_path(spark, "mixture")
    sinks.mixture(parquet(spark, d, "mixture_rows"), root, 100)
    files = readers.mixture(spark, root).groupBy("corpus", "split", "language", F.input_file_name().alias("file")).agg(F.count("*").alias("n"))
    return files.groupBy("corpus", "split", "language").agg(F.sum("n").alias("rows"), F.count_if(F.col("n") > 100).alias("too_long"))


@query("select count(*) as rows, 0::bigint as broken from mixture_rows")
def mixture_row_groups(spark, d):
    """Rows in files of exact row groups, and groups but a file's last that aren't of 100 rows."""
    groups = sinks.row_groups(spark, sinks.mixture_row_groups(parquet(spark, d, "mixture_rows"), scratch_path(spark, "row-groups"), 100))
    files = groups.groupBy("path").agg(F.sum("rows").alias("rows"), F.max("row_group").alias("last"), F.count_if(F.col("rows") == 100).alias("full"))
    return files.agg(F.sum("rows").alias("rows"), F.count_if(F.col("full") < F.col("last")).alias("broken"))


@query("select corpus, 'und' as language, printf('%.6f', sum(audio_size) / 16000 / 3600) as hours from mixture_rows where split = 'train' group by 1")
def tsv_distribution(spark, d):
    path = scratch_path(spark, "tsv")
    sinks.tsv_hours(mixture.sampling_weights(parquet(spark, d, "mixture_rows")), path, "und")
    return spark.read.options(header="true", sep="\t").csv(path)


@query("""select '| ' || corpus || ' | ' || split || ' | ' || count(*) || ' | ' || printf('%.3f', sum(audio_size) / 16000 / 3600) || ' |' as line from mixture_rows group by corpus, split
    union all select '  ' || corpus || ': ' || printf('%.3f', sum(audio_size) / 16000 / 3600) from mixture_rows group by corpus""")
def cards(spark, d):
    """The rows of a dataset card and of an asset card, from the files."""
    rows, root = parquet(spark, d, "mixture_rows"), scratch_path(spark, "cards")
    sinks.text_document(sinks.dataset_card("mixture", [r.asDict() for r in mixture.counts_and_hours(rows, "corpus", "split").orderBy("corpus", "split").collect()]), f"{root}/README.md")
    sinks.text_document(sinks.asset_card("mixture", root, {r["corpus"]: r["hours"] for r in mixture.counts_and_hours(rows, "corpus").collect()}), f"{root}/card.yaml")
    lines = spark.read.text([f"{root}/README.md", f"{root}/card.yaml"]).select(F.col("value").alias("line"))
    return lines.filter(r"line rlike '^(  |\\| (?!corpus|---))'")


@query("select count(*) as rows, 0::bigint as too_large, 0::bigint as too_early from mixture_rows")
def length_batch_faults(spark, d):
    """Batches of several rows over the limit, and batches that ended though the next row still fitted."""
    most = 480_000
    rows = mixture.batches(parquet(spark, d, "mixture_rows"), ["corpus", "split"], ["record_no", "audio_size"], most)
    sums = rows.groupBy("corpus", "split", "bucket", "batch").agg(F.sum("audio_size").alias("size"), F.count("*").alias("n"), F.min_by("audio_size", "place").alias("first"))
    after = sums.select("corpus", "split", "bucket", (F.col("batch") - 1).alias("batch"), F.col("first").alias("next"))
    both = sums.join(after, ["corpus", "split", "bucket", "batch"], "left")
    return both.agg(F.sum("n").alias("rows"), F.count_if((F.col("size") > most) & (F.col("n") > 1)).alias("too_large"), F.count_if(F.col("size") + F.col("next") <= most).alias("too_early"))


@query("""select corpus, count(*) filter (audio_size between 64000 and 224000) as rows from (select distinct record_no, corpus from panel_predictions) p join (select record_no, max(audio_size) as audio_size from mixture_rows group by 1) m using (record_no)
    group by 1 having count(*) filter (audio_size between 64000 and 224000) < 40""")
def panel_shortages(spark, d):
    """Corpora too small for a panel of 40 rows each."""
    sizes = parquet(spark, d, "mixture_rows").groupBy("record_no").agg(F.max("audio_size").alias("audio_size"))
    return evaluate.short_corpora(parquet(spark, d, "panel_predictions").select("record_no", "corpus").distinct().join(sizes, "record_no"), 64_000, 224_000, 40)


@query("select review_id, reviewed_at from decision_manifest_reviewed m where not exists (select 1 from dataset_audit a where a.decode_ok and a.source = m.source and a.split = m.split and a.row_index = m.row_index)")
def missing_audio(spark, d):
    """Manifest rows without a recording that can be decoded, which a preparation stops at."""
    return review.missing_audio(parquet(spark, d, "decision_manifest_reviewed"), parquet(spark, d, "dataset_audit").filter("decode_ok")).select("review_id", "reviewed_at")


@query("""select review_id, reviewed_at, case when lower(trim(final_decision)) in ('trim', 'trim_edges') then trim_start_seconds end as trim_start, case when lower(trim(final_decision)) in ('trim', 'trim_edges') then trim_end_seconds end as trim_end,
    case when lower(trim(final_decision)) = 'segment' then segment_boundaries_seconds end as cuts from decision_manifest_reviewed""")
def decision_bounds(spark, d):
    """Bounds typed for a kind of decision that doesn't use them are cleared."""
    start, end, cuts = review.with_bounds_of_its_kind(F.col("final_decision"), F.col("trim_start_seconds"), F.col("trim_end_seconds"), F.col("segment_boundaries_seconds"), ("trim", "trim_edges"), ("segment",))
    return parquet(spark, d, "decision_manifest_reviewed").select("review_id", "reviewed_at", start.alias("trim_start"), end.alias("trim_end"), cuts.alias("cuts"))


# --- evaluation and telemetry


@query(f"""select corpus, sum(word_errors)::bigint as errors, sum(words)::bigint - sum(len(hh))::bigint as missing from {SCORED} group by 1""")
def wer_edit_sums(spark, d):
    """Substitutions, deletions and insertions make up the errors, and deletions less insertions the missing words."""
    totals = evaluate.edit_totals(parquet(spark, d, "panel_predictions"), "corpus")
    return totals.select("corpus", (F.col("substitutions") + F.col("deletions") + F.col("insertions")).alias("errors"), (F.col("deletions") - F.col("insertions")).alias("missing"))


@query("select event_type, round(sum(value) / sum(event_id), 6) as real_time_factor, round(sum(event_id) / sum(value), 6) as throughput from events group by 1")
def real_time(spark, d):
    rates = telemetry.real_time(parquet(spark, d, "events"), "value", "event_id", "event_type")
    return rates.withColumns({c: F.round(c, 6) for c in ("real_time_factor", "throughput")})


@query("select event_id, case when event_id % 3 <> 0 or value > 10 then event_id % 3 else 3 end as code from events")
def exit_codes(spark, d):
    return parquet(spark, d, "events").select("event_id", telemetry.exit_code(F.col("event_id") % 3, F.col("value") > 10).alias("code"))


@query("select record_no, loaded_at from dataset_audit where status = 'accept'")
def accepted_rows(spark, d):
    return parquet(spark, d, "dataset_audit").filter("status = 'accept'").select("record_no", "loaded_at")


@query("select character, row_number() over (order by character) - 1 as place from (select distinct unnest(string_split(text_raw, '')) as character from dataset_audit where text_raw is not null) where not regexp_full_match(character, '[\\s\\p{Z}\\x85\\x1c-\\x1f]?')")
def character_order(spark, d):
    """Characters by code point, as the inventory lists them."""
    return audit.positions(T.character_inventory(parquet(spark, d, "dataset_audit"), "text_raw").select("character", F.lit(0).alias("k")), ["k"], ["character"], "place").select("character", F.col("place").cast("bigint").alias("place"))


@query("select string_agg(source, '|' order by source) as sources from (select distinct source from dataset_audit where source is not null)")
def sorted_sources(spark, d):
    return parquet(spark, d, "dataset_audit").agg(F.array_join(F.array_sort(F.collect_set("source")), "|").alias("sources"))


@query("""select doc_id, replace(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#x27;') as escaped,
    case doc_id % 4 when 0 then 'audio/wav' when 1 then 'audio/flac' when 2 then 'application/json' else 'application/octet-stream' end as mime from documents""")
def page_texts(spark, d):
    name = F.concat(F.lit("a."), F.element_at(F.array(*map(F.lit, ("wav", "FLAC", "json", "pt"))), (F.col("doc_id") % 4 + 1).cast("int")))
    return parquet(spark, d, "documents").select("doc_id", T.html_escaped(F.col("text")).alias("escaped"), T.mime_of(name).alias("mime"))


# --- encoded audio: an embedding's 64 numbers as the samples of a recording

_CODED = "list_transform(embedding, lambda x: round(greatest(-1.0, least(1.0, x::double)) * 32767) / 32768)"
_MEASURED = f"""select vec_id, 64::bigint as num_samples, 16 as sample_rate, 4.0::double as duration_seconds, round(list_max(list_transform(w, lambda x: abs(x))), 9) as peak, round(sqrt(list_sum(list_transform(w, lambda x: x * x)) / 64), 9) as rms
    from (select vec_id, {_CODED} as w from embeddings)"""


def _embeddings(spark, d):
    """In as many parts as the session shuffles into: what is made of a row is far larger than the row."""
    return parquet(spark, d, "embeddings").repartition(partitions(spark), "vec_id")


def _measures(spark, d, codec: str):
    e = parquet(spark, d, "embeddings").select("vec_id", S.measured(S.encoded(F.col("embedding"), 16, codec)).alias("m"))
    return e.select("vec_id", "m.num_samples", "m.sample_rate", "m.duration_seconds", F.round("m.peak", 9).alias("peak"), F.round("m.rms", 9).alias("rms"))


@query(_MEASURED)
def wav_measures(spark, d):
    return _measures(spark, d, "wav")


@query(_MEASURED)
def flac_measures(spark, d):
    return _measures(spark, d, "flac")


@query(f"""select vec_id, 16800::bigint as trimmed, 38400::bigint as resampled, 'ValueError:8000 samples' as short, round(list_max(list_transform({_CODED}, lambda x: abs(round(x * 32767) / 32768))), 9) as peak from embeddings""")
def prepared_audio(spark, d):
    """Recordings of 19 200 samples: trimmed and encoded anew as FLAC, at half the rate resampled, and one cut too short."""
    long, none = F.flatten(F.array_repeat("embedding", 300)), F.lit(None).cast("double")
    e = _embeddings(spark, d).select("vec_id", S.encoded(long, 16_000, "wav").alias("a"), S.encoded(long, 8_000, "flac").alias("b"))
    p = e.select("vec_id", S.prepared(F.col("a"), F.lit(0.1), F.lit(1.15)).alias("p"), S.prepared(F.col("b"), none, none, "wav").alias("q"), S.prepared(F.col("a"), F.lit(0.0), F.lit(0.5)).alias("r"))
    back = S.measured(S.signed_to_binary_long(F.col("p.audio_bytes")))
    return p.select("vec_id", F.col("p.audio_size").alias("trimmed"), F.col("q.audio_size").alias("resampled"), F.col("r.error").alias("short"), F.round(back["peak"], 9).alias("peak"))


def _recordings(spark, d, repeats: int, rate: int):
    """Raw examples of a source whose recordings are the embeddings."""
    split = F.element_at(F.array(*map(F.lit, ("train", "validation", "test"))), (F.col("vec_id") % 3 + 1).cast("int"))
    audio = S.encoded(F.flatten(F.array_repeat("embedding", repeats)), rate, "flac")
    raw = _embeddings(spark, d).select(split.alias("split"), F.col("vec_id").alias("row_index"), F.format_string("Mot %d [rire] !", "label").alias("sentence"), F.struct(audio.alias("bytes"), F.lit("a.flac").alias("path")).alias("audio"))
    return raw, ingest.Source("alpha", "lab/alpha", "r1", "sentence")


@query("select split, 'review' as status, 'low_text_audio_ratio|text_duplicate_cross_split' as reasons, 'resample_to_16khz' as actions, 'mot' as spoken, count(*) as rows from (select ['train', 'validation', 'test'][vec_id % 3 + 1] as split from embeddings) group by 1")
def audit_run(spark, d):
    """A whole audit of recordings, read again from its CSV table."""
    folder = scratch_path(spark, "audit")
    pipelines.audit_run([_recordings(spark, d, 1, 16)], folder)
    back = readers.csv_strings(spark, f"{folder}/dataset_audit", needed=pipelines.FIELDS)
    return back.groupBy("split", "status", F.col("review_reasons").alias("reasons"), F.col("preprocessing_actions").alias("actions"), F.col("text_normalized").alias("spoken")).agg(F.count("*").alias("rows"))


@query("""select case split when 'validation' then 'dev' else split end as split, count(*) as examples, (count(*) * 19200)::bigint as samples, 0::bigint as failed from (select ['train', 'validation', 'test'][vec_id % 3 + 1] as split from embeddings) group by 1""")
def mixture_run(spark, d):
    """A whole preparation of all recordings."""
    examples = ingest.raw_examples(*_recordings(spark, d, 300, 16_000))
    counts, failed = pipelines.mixture_run(examples, examples.select("source", "split", "row_index", F.col("text_raw").alias("text")), scratch_path(spark, "mixture"), "und")
    return counts.select("split", "examples", "samples", F.lit(failed.count()).cast("bigint").alias("failed"))
