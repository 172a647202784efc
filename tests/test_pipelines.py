import json

import pytest
from test_signal import SINE, wav

from voxloom import __main__ as cli
from voxloom.operators import ingest
from voxloom.plans import pipelines
from voxloom.sources import readers

RAW = "sentence string, client_id string, path string, split string, row_index long, audio struct<bytes: binary, path: string>"


def raw(spark, rows):
    return spark.createDataFrame([(t, s, p, split, i, (a, p)) for i, (t, s, p, split, a) in enumerate(rows)], RAW)


@pytest.fixture
def sources(spark):
    tone = wav(SINE * 2)
    a = raw(spark, [("Nʼdrɛ ɔ kɔ.", "s1", "a.wav", "train", tone), ("Deux mots [rire] 12 ici", None, None, "validation", wav([0.0] * 32_000)), ("Nʼdrɛ ɔ kɔ !", " ", "c", "test", b"broken"), (None, "s2", "d", "test", tone)])
    return [(a, ingest.Source("alpha", "lab/alpha", "r1", "sentence", "client_id", "path"))]


def test_audit_run(spark, sources, tmp_path):
    rows = {r.row_index: r for r in pipelines.audit_run(sources, f"{tmp_path}").collect()}
    assert set(pipelines.FIELDS) <= set(rows[0].asDict())
    assert (rows[0].text_normalized, rows[0].sample_rate, rows[0].channels, rows[0].text_words, rows[0].words_per_second) == ("n'drɛ ɔ kɔ", 16_000, 1, 3, 1.5)
    assert rows[0].preprocessing_actions == [] and rows[0].review_reasons == ["audio_duplicate_cross_split", "text_duplicate_cross_split"] and rows[0].status == "review"
    assert rows[1].text_normalized == "deux mots ici" and (rows[1].example_id, rows[1].speaker_id) == ("row-1", "alpha:unknown") and rows[1].status == "reject" and "silent_audio" in rows[1].review_reasons
    assert not rows[2].decode_ok and rows[2].status == "reject" and rows[2].review_reasons[0].startswith("decode_error:") and rows[2].duration_seconds is None
    assert rows[3].text_raw == "" and rows[3].review_reasons[:2] == ["empty_normalized_text", "low_text_audio_ratio"] and not rows[3].text_duplicate_cross_split
    back = readers.csv_strings(spark, f"{tmp_path}/dataset_audit", needed=["status"])
    assert back.count() == 4 and json.load(open(f"{tmp_path}/summary.json"))["totals"]["examples"] == 4
    with pytest.raises(ValueError, match="no split"):
        ingest.raw_examples(sources[0][0].filter("split <> 'test'"), sources[0][1])
    assert ingest.raw_examples(*sources[0], most_per_split=2).count() == 2


def test_mixture_run(spark, sources, tmp_path):
    examples = ingest.raw_examples(*sources[0])
    chosen = spark.createDataFrame([("alpha", "train", 0, "t"), ("alpha", "test", 2, "u"), ("alpha", "test", 9, "v")], "source string, split string, row_index long, text string")
    counts, failed = pipelines.mixture_run(examples, chosen, f"{tmp_path}/m", "und")
    assert [(r.corpus, r.split, r.examples, r.samples) for r in counts.collect()] == [("alpha", "train", 1, 32_000)]
    assert sorted(r.row_index for r in failed.collect()) == [2, 9]


def test_evaluation_run(spark):
    data = [(1, "x", ["a", "b"], ["a"]), (2, "y", ["a"], ["a"])]
    out = pipelines.evaluation_run(spark.createDataFrame(data, "record_no long, corpus string, reference array<string>, hypothesis array<string>"))
    assert out["overall"]["wer"] == 1 / 3 and out["macro"]["macro_wer"] == 0.25


def test_command_line(spark, tmp_path, capsys):
    cli.main(["list"])
    assert "audit_totals" in capsys.readouterr().out.split()
    cli.main(["run", "audit_totals", "/root/testdata/sf0.001", f"{tmp_path}/o", "--format", "json"])
    assert spark.read.json(f"{tmp_path}/o").count() == 1
