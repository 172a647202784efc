import datetime as dt

import pytest
from pyspark.sql import functions as F

from voxloom.functions import text as T
from voxloom.operators import audit, mixture, review, telemetry
from voxloom.plans import audit_queries

AUDIT = "source string, split string, row_index long, example_id string, speaker_id string, text_normalized string, text_sha256 string, audio_sha256 string"
MEASURES = "text_normalized string, decode_ok boolean, duration_seconds double, peak double, rms_dbfs double, clipping_fraction double, leading_silence_seconds double, trailing_silence_seconds double, words_per_second double"


def row(source, split, i, text="t", h="h"):
    return source, split, i, f"e{i}", "s", text, h, h


def test_cross_split_depends_on_split_only(spark):
    for rows, want in (([row("a", "train", 0), row("b", "train", 1)], False), ([row("a", "train", 0), row("b", "test", 1)], True)):
        g = audit.nested_groups(spark.createDataFrame(rows, AUDIT), "text_sha256", "text_normalized").collect()
        assert len(g) == 1 and g[0]["count"] == 2 and g[0].cross_split is want and [m.row_index for m in g[0].members] == [0, 1]


def test_blank_keys_form_no_group(spark):
    df = spark.createDataFrame([row("a", "train", 0, h=""), row("a", "test", 1, h=""), row("a", "test", 2, "", "x"), row("a", "test", 3, "", "x"), row("a", "t", 4, None, None)], AUDIT)
    assert audit.duplicate_groups(df, "text_sha256", "text_normalized").count() == 0
    assert audit.duplicate_members(df, "audio_sha256").count() == 2
    assert audit.duplicate_groups(df.filter("false"), "text_sha256").count() == 0 == audit.nested_groups(df.filter("false"), "text_sha256").count()
    with pytest.raises(Exception, match="more than 1 members"):
        audit.nested_groups(df, "audio_sha256", most=1).collect()


def test_groups_over_the_limit_are_given_in_parts(spark):
    many = [row("a", ("train", "test")[i % 2], i * 37 % 50) for i in range(50)]
    df = spark.createDataFrame([*many, row("b", "train", 1, h="k"), row("b", "train", 0, h="k"), row("c", "test", 0, h="alone")], AUDIT)
    got = audit.group_parts(df, "audio_sha256", most=15).orderBy("sha256", "part").collect()
    assert [(r.sha256, r["count"], r.cross_split, r.part, len(r.members)) for r in got] == [*[("h", 50, True, p, n) for p, n in enumerate((15, 15, 15, 5))], ("k", 2, False, 0, 2)]
    assert [(m.split, m.row_index) for r in got[:4] for m in r.members] == sorted((r[1], r[2]) for r in many)
    whole = audit.nested_groups(df, "audio_sha256").orderBy("sha256").collect()
    assert [m for r in got[:4] for m in r.members] == whole[0].members and got[4].members == whole[1].members
    assert audit.group_parts(df.filter("false"), "audio_sha256").count() == 0


def test_report_of_a_group_over_the_limit(spark):
    rows = [row("a", "train", i) for i in range(120)]
    got = audit_queries._report(spark.createDataFrame(rows, AUDIT), most=50).collect()
    assert [(r.sha256, r["count"], r.cross_split) for r in got] == [("h", 120, False)]
    assert got[0].members == ",".join(sorted(f"a:train:{i}" for i in range(120)))


def test_positions_of_a_hot_key(spark):
    df = spark.createDataFrame([("hot" if i % 3 else None if i % 2 else "k", i * 7919 % 1000) for i in range(1000)], "k string, i long")
    got = audit.positions(df, ["k"], ["i"]).toPandas()
    for _, g in got.groupby("k", dropna=False):
        assert g.sort_values("i").position.tolist() == list(range(len(g)))
    assert len(got) == 1000 and audit.positions(df.filter("false"), ["k"], ["i"]).count() == 0


def flags(spark, **values):
    base = {"text_normalized": "a", "decode_ok": True, "duration_seconds": 5.0, "peak": 0.5, "rms_dbfs": -20.0, "clipping_fraction": 0.0, "leading_silence_seconds": 0.0, "trailing_silence_seconds": 0.0, "words_per_second": 1.0}
    df = spark.createDataFrame([tuple((base | values).values())], MEASURES)
    r = df.select(audit.quality_flags().alias("f"), audit.severity(audit.quality_flags()).alias("s")).first()
    return r.f, r.s


@pytest.mark.parametrize(
    ("column", "at", "beyond", "flag", "severity"),
    [
        ("duration_seconds", 1.0, 0.999, "too_short", "reject"), ("duration_seconds", 35.0, 35.001, "too_long_requires_alignment", "review"), ("rms_dbfs", -45.0, -45.1, "very_low_rms", "review"),
        ("clipping_fraction", 0.001, 0.0011, "clipping", "review"), ("leading_silence_seconds", 1.5, 1.51, "long_leading_silence", "review"), ("trailing_silence_seconds", 2.0, 2.01, "long_trailing_silence", "review"),
        ("words_per_second", 0.4, 0.39, "low_text_audio_ratio", "review"), ("words_per_second", 3.5, 3.51, "high_text_audio_ratio", "review"), ("peak", 1.1e-6, 1e-6, "silent_audio", "reject"),
    ],
)
def test_limits(spark, column, at, beyond, flag, severity):
    assert flags(spark, **{column: at}) == ([], "accept")
    assert flags(spark, **{column: beyond}) == ([flag], severity)


def test_undecodable_and_blank_rows(spark):
    assert flags(spark, decode_ok=False, duration_seconds=None, peak=None) == (["decode_error"], "reject")
    assert flags(spark, text_normalized=None, words_per_second=0.0) == (["empty_normalized_text", "low_text_audio_ratio"], "reject")
    assert flags(spark, rms_dbfs=None, peak=None) == ([], "accept")


def test_first_match(spark):
    df = spark.createDataFrame([(1,), (5,), (None,)], "x int")
    c = audit.first_match([(F.col("x") > 3, F.lit("big")), (F.col("x") > 0, F.lit("small"))], F.lit("none"))
    assert [r.y for r in df.select(c.alias("y")).collect()] == ["small", "big", "none"]


def test_latest_row_decides(spark):
    day = lambda n: dt.datetime(2025, 1, n)
    df = spark.createDataFrame([("a", day(1), "keep"), ("a", day(2), None), ("b", None, "x"), ("b", None, "y"), ("b", None, "y")], "review_id string, reviewed_at timestamp, final_decision string")
    assert {r.review_id: r.final_decision for r in review.deciding_rows(df).collect()} == {"a": None, "b": "y"}


@pytest.mark.parametrize(("start", "end", "valid"), [("4", "39", True), ("", "39", False), ("nan", "39", False), ("4", "nan", False), ("0", "45.0005", True), ("0", "46", False), ("5", "5", False), ("-1", "3", False), (None, None, False)])
def test_trims(spark, start, end, valid):
    df = spark.createDataFrame([(start, end)], "s string, e string")
    assert df.select(review.trim_is_valid(T.parsed(F.col("s")), T.parsed(F.col("e")), F.lit(45.0)).alias("v")).first().v is valid


@pytest.mark.parametrize(("cuts", "valid"), [([1.0, 2.0], True), ([2.0, 1.0], False), ([1.0, 1.0], False), ([0.0], False), ([10.0], False), ([], False), ([None, 1.0], False), (None, False)])
def test_cut_lists(spark, cuts, valid):
    df = spark.createDataFrame([(cuts,)], "c array<double>")
    assert df.select(review.cut_list_is_valid(F.col("c"), F.lit(10.0)).alias("v")).first().v is valid


def test_key_sets(spark):
    a, b = (spark.createDataFrame([(x,) for x in v], "k string") for v in (["1", "2", "2"], ["2", "3"]))
    assert sorted((r.k, r.side) for r in review.key_difference(a, b, "k").collect()) == [("1", "left"), ("3", "right")]
    with pytest.raises(ValueError, match="missing"):
        review.require_columns(a, ["k", "z"])


def test_splits(spark):
    df = spark.createDataFrame([("train",), ("validation",), ("test",)], "s string")
    assert [r.o for r in df.select(mixture.output_split(F.col("s")).alias("o")).collect()] == ["train", "dev", "test"]
    with pytest.raises(Exception, match="unknown split"):
        spark.createDataFrame([("other",)], "s string").select(mixture.output_split(F.col("s"))).collect()


def test_batches_hold_the_limit(spark):
    df = spark.createDataFrame([("c", i, 30 + i % 50) for i in range(400)] + [("c", 900, 500), ("c", 901, None)], "corpus string, record_no long, audio_size long")
    got = mixture.batches(df, ["corpus"], ["record_no"], 200, 100).toPandas()
    assert len(got) == 402
    assert len(mixture.batches(df.union(df.withColumn("record_no", F.col("record_no") + 1000)), ["corpus"], ["record_no"], 200, 100).toPandas().query("record_no < 400").merge(got, on=["corpus", "record_no", "bucket", "batch", "place"])) == 400
    turned = mixture.batches(df, ["corpus"], ["record_no"], 200, 100, shuffle_window=10).toPandas().sort_values(["bucket", "place"])
    first = turned[turned.bucket == 0].record_no.tolist()
    assert first != sorted(first) and all(sorted(first[i : i + 10]) == list(range(i, i + 10)) for i in range(0, 100, 10))
    sums = got.groupby(["bucket", "batch"]).audio_size.agg(["sum", "count"])
    assert ((sums["sum"] <= 200) | (sums["count"] == 1)).all()


def test_weights(spark):
    df = spark.createDataFrame([("a", "train", 900), ("b", "train", 100), ("b", "dev", 10**6)], "corpus string, split string, audio_size long")
    got = {r.corpus: r.weight for r in mixture.sampling_weights(df).collect()}
    assert abs(got["a"] - 0.75) < 1e-9 and abs(got["b"] - 0.25) < 1e-9
    assert {round(r.weight, 9) for r in mixture.sampling_weights(df, 0.0).collect()} == {0.5}


def test_device_maxima(spark):
    rows = [("t1", "0", "100", "20"), ("t2", "0", "900", "x"), ("t2", "1", "800", "70"), ("t3", "monitor_error", "message", None), ("t4", "2", "-5", None)]
    df = spark.createDataFrame(rows, "ts string, gpu_index string, memory string, use string")
    got = {r.device: (r.memory, r.use) for r in telemetry.device_maxima(df, "gpu_index", memory="memory", use="use").collect()}
    assert got == {0: (900.0, 20.0), 1: (800.0, 70.0), 2: (0.0, 0.0)}


def test_checkpoints(spark):
    files = []
    for step, ranks in ((20, 2), (40, 1)):
        for r in range(ranks):
            files += [f"/c/step_{step}/trainer/rank_{r:02d}.pt", f"/c/step_{step}/model/pp_00/tp_00/sdp_{r:02d}.pt", f"/c/step_{step}/optimizer/pp_00/tp_00/sdp_{r:02d}.pt", f"/c/step_{step}/data_reader/dp_{r:02d}.pt"]
    files += ["/c/step_20/model.yaml", "/c/step_60.tmp/trainer/rank_00.pt", "/c/step_x/trainer/rank_00.pt"]
    states = telemetry.checkpoint_states(telemetry.checkpoint_files(spark.createDataFrame([(f, 10) for f in files], "path string, length long")), 2)
    got = {r.step: (r.complete, r.bytes) for r in states.collect()}
    assert got == {20: (True, 90), 40: (False, 40)} and telemetry.resume_step(states).first().step == 20


def test_log(spark):
    log = spark.createDataFrame([("step: 50 wer:\n 38.25 step: 100 wer: 35.5 Overflow detected at step 1",), (None,)], "value string")
    got = telemetry.log_metrics(log, "value", r"step: (\d+).*?wer:\s*([\d.]+)")
    assert sorted(tuple(r) for r in got.collect()) == [(50, 38.25), (100, 35.5)]
    assert log.select(telemetry.overflow_count(F.col("value")).alias("n")).first().n == 1


def test_exit_codes(spark):
    df = spark.createDataFrame([(0, True), (0, False), (7, False)], "c int, ok boolean")
    assert [r.e for r in df.select(telemetry.exit_code(F.col("c"), F.col("ok")).alias("e")).collect()] == [0, 3, 7]
