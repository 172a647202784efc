import json

import pytest

from voxloom.session import materialize, shared_dir
from voxloom.sources import readers, sinks
from voxloom.streaming import telemetry as streams


def test_csv_keeps_every_text(spark, tmp_path):
    rows = [('a "b"\n, c', None, "x|y"), ("", "\\", " z "), (None, "é", "")]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    sinks.csv_table(df, f"{tmp_path}/t", ["c", "a", "b"])
    back = readers.csv_strings(spark, f"{tmp_path}/t")
    assert sorted(tuple(r[k] for k in "abc") for r in back.collect()) == sorted(tuple(x or "" for x in r) for r in rows)
    with pytest.raises(ValueError):
        sinks.csv_table(df.filter("false"), f"{tmp_path}/u", ["a"], allow_empty=False)
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        sinks.csv_table(df, f"{tmp_path}/t", ["a"])


def test_csv_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "t.csv").write_text("x,y,z\n1,2,3\n")
    read = lambda *a: [tuple(r) for r in readers.csv_strings(spark, f"{tmp_path}/t.csv", *a).collect()]
    assert read(["y"]) == [("2",)] and read(["z", "x"]) == [("3", "1")] and read(None, ["y"]) == [("1", "2", "3")]
    for columns, needed in ((["y", "w"], None), (["y"], ["w"]), (None, ["w"])):
        with pytest.raises(ValueError, match="missing: w"):
            readers.csv_strings(spark, f"{tmp_path}/t.csv", columns, needed)


def test_json_document(spark, tmp_path):
    path = f"{tmp_path}/g.json"
    sinks.json_document({"normalized_text": [{"members": [{"source": "é"}]}]}, path)
    assert json.load(open(path, encoding="utf-8"))["normalized_text"][0]["members"][0]["source"] == "é"
    assert readers.json_document(spark, path).count() == 1
    with pytest.raises(FileExistsError):
        sinks.json_document({}, path)


def test_mixture_layout(spark, tmp_path):
    df = spark.createDataFrame([(f"t{i}", [i % 100, -1], 20_000 + i, "c" if i % 3 else "d", "train" if i % 2 else "dev", "l") for i in range(500)], "text string, audio_bytes array<tinyint>, audio_size long, corpus string, split string, language string")
    sinks.mixture(df, f"{tmp_path}/m", rows_per_file=20, rows_per_task=60)
    back = readers.mixture(spark, f"{tmp_path}/m")
    assert back.count() == 500 and dict(back.dtypes)["audio_bytes"] == "array<tinyint>"
    plan = back.filter("split = 'dev' and audio_size <= 20100").select("audio_size")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(split" in plan and "LessThanOrEqual(audio_size,20100)" in plan
    assert max(r["count"] for r in spark.read.parquet(f"{tmp_path}/m").selectExpr("input_file_name() as f").groupBy("f").count().collect()) <= 20


def test_row_groups(spark, tmp_path):
    import pyarrow.parquet as pq

    written = sinks.mixture_row_groups(spark.range(250).repartition(1), f"{tmp_path}/r").collect()
    meta = pq.ParquetFile(written[0].path).metadata
    assert [meta.row_group(i).num_rows for i in range(meta.num_row_groups)] == [100, 100, 50]


def test_files(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.pt").write_bytes(b"123")
    (tmp_path / "y.log").write_text("one\ntwo")
    assert sorted((r.path.rsplit("/", 1)[1], r.length) for r in readers.file_inventory(spark, str(tmp_path)).collect()) == [("x.pt", 3), ("y.log", 7)]
    assert readers.whole_texts(spark, f"{tmp_path}/y.log").first().value == "one\ntwo"


def test_cards():
    assert "a: 1.000" in sinks.asset_card("n", "r", {"a": 1.0}) and "| a | dev | 2 | 0.500 |" in sinks.dataset_card("n", [{"corpus": "a", "split": "dev", "examples": 2, "hours": 0.5}])


def test_stream_of_samples(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("timestamp,gpu_index,memory_used_mib,memory_total_mib,utilization_percent,temperature_celsius,power_watts\nt1,0,100,1,20,5,3\nt2,0,900,1,80,6,6\nt2,1,800,1,70,6,6\nt3,monitor_error,failed\n")
    got = streams.drained(streams.running_maxima(streams.samples(spark, f"{tmp_path}/in")), "device_maxima", f"{tmp_path}/cp")
    assert sorted(tuple(r) for r in got.collect()) == [(0, 900.0, 80.0), (1, 800.0, 70.0)]


def test_stream_of_log_lines(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.log").write_text("step 5 wer 40.5\nnothing\nstep 10 wer 30\n")
    got = streams.drained(streams.log_metrics(spark, f"{tmp_path}/in", r"step (\d+) wer ([\d.]+)"), "log_metrics", f"{tmp_path}/cp", "append")
    assert sorted(tuple(r) for r in got.collect()) == [(5, 40.5), (10, 30.0)]


def test_materialize_writes_to_the_shared_folder(spark):
    df = materialize(spark.range(3), "three")
    assert df.count() == 3 and df.inputFiles()[0].startswith(shared_dir(spark).replace("file://", "file:///").replace("////", "///")[:20])


def test_panel_document(spark, tmp_path):
    sinks.json_document({"examples": [{"audio_sha256": "b"}, {"audio_sha256": "a"}]}, f"{tmp_path}/p.json")
    got = readers.panel_examples(readers.json_document(spark, f"{tmp_path}/p.json")).collect()
    assert [(r.place, r.audio_sha256) for r in got] == [(0, "b"), (1, "a")]


def test_candidates_and_configuration(tmp_path):
    for name in ("x/one", "y/a", "y/b"):
        (tmp_path / name).mkdir(parents=True)
    (tmp_path / "x/one/f.csv").touch()
    (tmp_path / "y/a/f.csv").touch()
    assert readers.only_candidate([f"{tmp_path}/none", f"{tmp_path}/x", f"{tmp_path}/y"], ["f.csv"]) == f"{tmp_path}/x/one"
    (tmp_path / "y/b/f.csv").touch()
    with pytest.raises(ValueError, match="several"):
        readers.only_candidate([f"{tmp_path}/y"], ["f.csv"])
    with pytest.raises(FileNotFoundError):
        readers.only_candidate([f"{tmp_path}/x"], ["g.csv"])
    config = {"regime": {"steps": 20, "other": 1}, "seed": 3}
    assert readers.overridden(config, {"regime.steps": 50}, {"seed": 3})["regime"] == {"steps": 50, "other": 1} and config["regime"]["steps"] == 20
    with pytest.raises(KeyError):
        readers.overridden(config, {"regime.step": 50})
    with pytest.raises(ValueError):
        readers.overridden(config, {}, {"seed": 4})
    assert readers.require_range("seconds", 40, 0, 40) == 40
    with pytest.raises(ValueError):
        readers.require_range("seconds", 0, 0, 40)
