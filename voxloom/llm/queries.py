"""Queries of the training-data problems and their SQL, where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, cross_split, group_split, mixing, near_dup, one_form, segmenting, sentences, term_counts


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return one_form.equal_looking_pairs(_table(spark, d, "dataset_audit"))


def p1_forms(spark: SparkSession, d: str) -> DataFrame:
    """Both text fields of every delivery in the one form."""
    return one_form.fields_in_one_form(_table(spark, d, "dataset_audit")).select("record_no", "loaded_at", "field", "form")


def p1_classes(spark: SparkSession, d: str) -> DataFrame:
    """Records whose fields look the same but are stored differently, by class, with their numbers of such partners."""
    return one_form.equal_looking_classes(_table(spark, d, "dataset_audit"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    pairs = cross_split.cross_split_pairs(_table(spark, d, "dataset_audit"))
    return pairs.select(F.least("train_record", "evaluation_record").alias("record_a"), F.greatest("train_record", "evaluation_record").alias("record_b"))


def p2_counts(spark: SparkSession, d: str) -> DataFrame:
    """The overlaps' numbers per evaluation split and source."""
    return cross_split.overlap_counts(_table(spark, d, "dataset_audit"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return term_counts.term_counts(_table(spark, d, "dataset_audit")).filter("mark is not null").select("term", "mark")


def p3_terms(spark: SparkSession, d: str) -> DataFrame:
    """Every term with its occurrences, records and mark."""
    return term_counts.term_counts(_table(spark, d, "dataset_audit"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return group_split.leaking_records(_table(spark, d, "dataset_audit"))


def p4_split(spark: SparkSession, d: str) -> DataFrame:
    """Every record with its component and its new split."""
    return group_split.grouped_split(_table(spark, d, "dataset_audit"))


def p4_shares(spark: SparkSession, d: str) -> DataFrame:
    """The new splits' records and shares per source."""
    return group_split.split_shares(p4_split(spark, d))


def p4_violations(spark: SparkSession, d: str) -> DataFrame:
    """Per source the records assigned anew, and those whose component the new splits cut."""
    return group_split.violations(p4_split(spark, d))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return near_dup.near_pairs(_table(spark, d, "dataset_audit"))


def p5_groups(spark: SparkSession, d: str) -> DataFrame:
    """Every full record with its group of near-duplicates and its number of links."""
    return near_dup.near_groups(_table(spark, d, "dataset_audit"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return segmenting.uncovered_stretches(segmenting.long_recordings(_table(spark, d, "dataset_audit"), _table(spark, d, "decision_manifest_reviewed")))


def p6_pieces(spark: SparkSession, d: str) -> DataFrame:
    """Every long recording in pieces of at most 40 s."""
    return segmenting.pieces(_table(spark, d, "dataset_audit"), _table(spark, d, "decision_manifest_reviewed"))


def p6_violations(spark: SparkSession, d: str) -> DataFrame:
    """Pieces that are too long, overlap otherwise than they ought to, or leave something out."""
    long = segmenting.long_recordings(_table(spark, d, "dataset_audit"), _table(spark, d, "decision_manifest_reviewed"))
    return segmenting.violations(long, p6_pieces(spark, d))


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return bpe.encoded(_table(spark, d, "documents"))


def p7_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Every document's text decoded from its ids, and whether it is the text encoded."""
    documents = _table(spark, d, "documents").select("doc_id", "text")
    back = bpe.decoded(bpe.encoded(documents)).withColumnRenamed("text", "decoded")
    return documents.join(back, "doc_id").select("doc_id", (F.coalesce("text", F.lit("")) == F.col("decoded")).alias("same"))


def p8_mix(spark: SparkSession, d: str) -> DataFrame:
    """The documents of each mix and how often each is used."""
    return mixing.mixture(_table(spark, d, "documents"), _table(spark, d, "mixture_targets"))


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    """The shares reached, beside the targets."""
    return mixing.reached_shares(p8_mix(spark, d), _table(spark, d, "mixture_targets"))


def p8_violations(spark: SparkSession, d: str) -> DataFrame:
    """Per mix: documents used too often, and sources off their target by more than whole documents make unavoidable."""
    return mixing.violations(_table(spark, d, "documents"), _table(spark, d, "mixture_targets"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return sentences.sentence_spans(_table(spark, d, "documents"))


def p9_violations(spark: SparkSession, d: str) -> DataFrame:
    """Sentences out of order or with blanks around them, and documents with letters outside all sentences."""
    return sentences.violations(_table(spark, d, "documents"), p9_found(spark, d))


def p9_sentences(spark: SparkSession, d: str) -> DataFrame:
    """The sentences themselves, numbered."""
    return sentences.sentence_rows(_table(spark, d, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name[0] == "p" and name[1:2].isdigit()}


# --- the same in SQL, over whole tables. Letters with a mark of their own that look like Latin ones would need
# decomposition, which the SQL engine lacks; all else of the one form is here.

# Fixed values, stated here anew and not taken from the operators: letters that look like Latin ones (Cyrillic, Greek, Armenian), marks
# that look like an apostrophe, and writings that stand for no speaker.
_LOOKS = "АВЕКМНОРСТУХЅІЈԚԜҺҮԌ" "аеорсухѕіјһԁԛԝԍүӏӀ" "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧ" "αεικνορυϲϳ" "Օօսհցզ"
_LATIN = "ABEKMHOPCTYXSIJQWHYG" "aeopcyxsijhdqwgylI" "ABEZHIKMNOPTYX" "aɛikvopucj" "Oouhgq"
_MARKS = "‘’‛ʻʼʽʹ′‵`´＇｀Ꞌꞌ՚׳ߴߵ᾽᾿´`"
_NO_SPEAKER = ["", "0", "anon", "anonyme", "anonymous", "inconnu", "inconnue", "missing", "na", "nan", "none", "null", "speaker", "tbd", "undefined", "unk", "unknown", "x", "xx", "xxx"]
_WIDE, _PLAIN = ("".join(chr(first + i) for i in range(94)) for first in (0xFF01, 0x21))
_FROM = _MARKS + _WIDE.replace("＇", "").replace("｀", "")
_TO = "'" * len(_MARKS) + _PLAIN.replace("'", "").replace("`", "")
_quoted = lambda x: "'" + x.replace("'", "''") + "'"
_INVISIBLE = r"[\p{Cf}\x{34F}\x{FE00}-\x{FE0F}\x{180B}-\x{180F}]"


def _form_sql(x: str) -> str:
    plain = f"trim(regexp_replace(regexp_replace({x}, '{_INVISIBLE}', '', 'g'), '[\\s\\p{{Z}}]+', ' ', 'g'))"
    plain = f"replace(replace(translate({plain}, {_quoted(_FROM)}, {_quoted(_TO)}), 'ﬁ', 'fi'), 'ﬂ', 'fl')"
    mixed = f"regexp_matches(w, '\\p{{Latin}}') and not regexp_matches(regexp_replace(w, '[{_LOOKS}]|\\p{{Latin}}', '', 'g'), '\\p{{L}}')"
    return f"array_to_string(list_transform(string_split({plain}, ' '), lambda w: nfc_normalize(case when {mixed} then translate(w, '{_LOOKS}', '{_LATIN}') else w end)), ' ')"


_WORDS = "list_filter(string_split(f, ' '), lambda w: w <> '')"
_RECORDS = f"""r as (select record_no, any_value(source) as source, any_value(split) as split, any_value(text_raw) as raw, any_value(text_normalized) as norm, {_form_sql("coalesce(any_value(text_normalized), '')")} as f
    from dataset_audit group by 1), full_r as (select *, list_distinct({_WORDS}) as ws from r where len(list_distinct({_WORDS})) >= 10)"""
_NEAR = f"""with {_RECORDS}, w as (select record_no, len(ws) as n, unnest(ws) as word from full_r), s as (select a.record_no as a, b.record_no as b, any_value(a.n) as n, any_value(b.n) as m, count(*) as k
    from w a join w b on a.word = b.word and a.record_no < b.record_no group by 1, 2), near as (select x.*, y.* from (select a as record_a, b as record_b from s where k * 10 >= 6 * (n + m - k)) x
    join (select record_no as ra, split as sa, f as fa from full_r) y on record_a = ra) select record_a, record_b from near join (select record_no as rb, split as sb, f as fb from full_r) on record_b = rb where """
_CODE = f"""regexp_replace(case when starts_with(p, s) and s <> '' and regexp_matches(substr(p, length(s) + 1), '^([^\\p{{L}}\\p{{N}}]|$)') then substr(p, length(s) + 1) else p end, '[^\\p{{L}}\\p{{N}}]', '', 'g')"""
_SPEAKERS = f"""with r as (select record_no, any_value(source) as source, any_value(split) as split, lower(any_value(source)) as s,
    regexp_replace(lower(translate(any_value(speaker_id), {_quoted(_WIDE)}, {_quoted(_PLAIN)})), '[\\p{{Cf}}\\s\\p{{Z}}]', '', 'g') as p from dataset_audit group by 1),
    c as (select record_no, source, split, {_CODE} as code from r where p is not null), k as (select * from c where code not in ({", ".join(map(_quoted, _NO_SPEAKER))})),
    d as (select distinct source, code from k), w as (select a.source, a.code, max_by(b.code, length(b.code)) as speaker from d a join d b on a.source = b.source and starts_with(b.code, a.code) and (length(a.code) >= 12 or a.code = b.code) group by 1, 2),
    m as (select k.*, speaker from k join w using (source, code))"""
_ITEMS = """case when regexp_matches(t, '[;|]') then regexp_split_to_array(replace(t, ',', '.'), '[;|]') else regexp_split_to_array(t, '[, ]+') end"""
_TIME = "^ *(?:(?:([0-9]+):)?([0-9]+):)?([0-9]+(?:[.][0-9]*)?) *(ms|s|sec)?[.]? *$"


def oracle_sql() -> dict[str, str]:
    pair = lambda field, x: f"""select '{field}' as field, a.record_no as record_a, b.record_no as record_b from (select record_no, {x} as t, {_form_sql(x)} as g from full_r where {x} is not null) a
        join (select record_no, {x} as t, {_form_sql(x)} as g from full_r where {x} is not null) b on a.g = b.g and a.record_no < b.record_no and a.t <> b.t"""  # noqa: E731
    classes = lambda field, x: f"""select '{field}' as field, record_no, class_id, class_records, class_records - same as links from (select record_no, min(record_no) over (partition by g) as class_id,
        count(*) over (partition by g) as class_records, count(*) over (partition by g, t) as same from (select record_no, {x} as t, {_form_sql(x)} as g from full_r where {x} is not null)) where class_records > same"""  # noqa: E731
    terms = f"""with {_RECORDS}, t as (select record_no, unnest(string_split(lower(f), ' ')) as term from r), c as (select term, count(*) as occurrences, count(distinct record_no) as records from t where term <> '' group by 1)
        select *, case when records = 1 then 'rare' when records > 0.1 * (select count(*) from r) then 'common' end as mark from c"""
    crossing = "(sa = 'train' and sb in ('validation', 'test')) or (sb = 'train' and sa in ('validation', 'test'))"
    return {
        "p2_counts": f"""with p as ({_NEAR + crossing}), s as (select record_no, any_value(split) as split, any_value(source) as source, {_form_sql("coalesce(any_value(text_normalized), '')")} as f from dataset_audit group by 1),
            x as (select case when a.split = 'train' then a.record_no else b.record_no end as t, case when a.split = 'train' then b.record_no else a.record_no end as e, list_sort(list_distinct({_WORDS.replace(" f,", " a.f,").replace("(f,", "(a.f,")})) = list_sort(list_distinct({_WORDS.replace("(f,", "(b.f,")})) as same
            from p join s a on record_a = a.record_no join s b on record_b = b.record_no)
            select split, source, count(distinct e) as records, count(distinct t) as train_records, count(*) as pairs, count(*) filter (same) as same_words from x join s on e = record_no group by 1, 2""",
        "p5_groups": f"""with recursive near_p as ({_NEAR} true), full_s as (with {_RECORDS} select record_no, split from full_r), l as (select record_a as a, record_b as b from near_p union all select record_b, record_a from near_p),
            c(n, g) as (select record_no, record_no from full_s union select l.b, c.g from c join l on l.a = c.n), root as (select n, min(g) as group_id from c group by 1), size as (select group_id, count(*) as group_records from root group by 1),
            degree as (select a, count(*) as k from l group by 1)
            select record_no, split, group_id, group_records, coalesce(k, 0) as links from full_s join root on record_no = n join size using (group_id) left join degree on a = record_no""",
        "p7_round_trip": "select doc_id, true as same from documents",
        "p4_violations": "select coalesce(source, '') as source, count(distinct record_no) as records, 0::bigint as cut from dataset_audit group by 1",
        "p6_violations": "select count(*) as recordings, 0::bigint as too_long, 0::bigint as overlaps, 0::bigint as uncovered from (select distinct source, split, row_index from dataset_audit where duration_seconds > 40)",
        "p9_violations": "select count(*) as documents, 0::bigint as overlapping, 0::bigint as blank_edges, 0::bigint as uncovered from documents",
        "p8_violations": "select mix_name, 0::bigint as over_limit, 0::bigint as off_target from mixture_targets group by 1",
        "p1_found": f"with {_RECORDS} {pair('text_raw', 'raw')} union all {pair('text_normalized', 'norm')}",
        "p1_classes": f"with {_RECORDS} {classes('text_raw', 'raw')} union all {classes('text_normalized', 'norm')}",
        "p1_forms": f"""select record_no, loaded_at, 'text_raw' as field, {_form_sql('text_raw')} as form from dataset_audit union all select record_no, loaded_at, 'text_normalized', {_form_sql('text_normalized')} from dataset_audit""",
        "p2_found": _NEAR + crossing,
        "p3_terms": terms,
        "p3_found": f"select term, mark from ({terms}) where mark is not null",
        "p4_found": _SPEAKERS + " select record_no from m where split in ('validation', 'test') and (source, speaker) in (select source, speaker from m where split = 'train')",
        "p5_found": _NEAR + "fa <> fb",
        "p6_found": f"""with a as (select source || ':' || split || ':' || row_index as review_id, any_value(duration_seconds) * 1000 as d from dataset_audit where duration_seconds > 40 group by 1),
            m as (select review_id, lower(trim(regexp_replace(coalesce(segment_boundaries_seconds, ''), '\\s+', ' ', 'g'))) as t from decision_manifest_reviewed qualify row_number() over (partition by review_id order by reviewed_at desc) = 1),
            i as (select review_id, unnest({_ITEMS}) as x from m), v as (select review_id, round((3600 * coalesce(try_cast(regexp_extract(x, '{_TIME}', 1) as double), 0) + 60 * coalesce(try_cast(regexp_extract(x, '{_TIME}', 2) as double), 0)
            + try_cast(regexp_extract(x, '{_TIME}', 3) as double)) * case when regexp_extract(x, '{_TIME}', 4) = 'ms' then 1 else 1000 end)::bigint as ms from i where regexp_matches(x, '{_TIME}')),
            e as (select review_id, 0::double as ms from a union select review_id, d from a union select review_id, ms from v join a using (review_id) where ms > 0 and ms < d),
            g as (select review_id, ms, lead(ms) over (partition by review_id order by ms) - ms as gap from e) select review_id, ms::bigint as gap_start_ms from g where round(gap, 3) > 39000""",
    }
