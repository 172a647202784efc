from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from voxloom.functions import distance as D
from voxloom.operators import evaluate

SCHEMA = "record_no long, corpus string, split string, reference array<string>, hypothesis array<string>"


def brute(r, h):
    row = list(range(len(h) + 1))
    for i, a in enumerate(r, 1):
        new = [i]
        for j, b in enumerate(h, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return row[-1]


word = st.sampled_from(["a", "b", "É", "", "mot", "𝄞"])


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(pairs=st.lists(st.tuples(st.lists(word, max_size=7), st.lists(word, max_size=7)), min_size=1, max_size=30))
def test_token_distance(spark, pairs):
    df = spark.createDataFrame(pairs, "r array<string>, h array<string>")
    got = df.select("r", "h", D.token_distance(F.col("r"), F.col("h")).alias("d"), D.edit_kinds(F.col("r"), F.col("h")).alias("k")).collect()
    assert all(x.d == brute(x.r, x.h) == sum(x.k) for x in got)


def test_nulls_and_long_lists(spark):
    long = [f"w{i}" for i in range(3000)]
    df = spark.createDataFrame([(None, ["a"]), (["a", None], None), (long, long[1:])], "r array<string>, h array<string>")
    assert [x.d for x in df.select(D.token_distance(F.col("r"), F.col("h")).alias("d")).collect()] == [1, 2, 1]


def test_pairs_over_the_limit_of_distinct_tokens(spark):
    many = [f"w{i}" for i in range(D.MOST_DISTINCT + 5)]
    other = ["new", *many[1:9_000], *many[9_001:15_000], "more", *many[15_000:-1], None]  # replaced, left out, put in, replaced
    df = spark.createDataFrame([(1, many, other), (2, ["a"], ["b", "a"]), (3, None, many), (4, many, many)], "i int, r array<string>, h array<string>")
    assert [x.d for x in df.select("i", D.token_distance(F.col("r"), F.col("h")).alias("d")).orderBy("i").collect()] == [4, 1, len(many), 0]


@settings(deadline=None)
@given(st.lists(word, max_size=9), st.lists(word, max_size=9))
def test_steps(r, h):
    assert D._steps(r, h) == brute(r, h)


def rows(spark):
    data = [(1, "x", "dev", ["a", "b", "c"], ["a", "x", "c"]), (2, "x", "dev", [], ["a", "b"]), (3, "y", "test", ["a", "b"], None), (3, "y", "test", ["a", "b"], ["a", "b"])]
    return evaluate.scored(spark.createDataFrame(data, SCHEMA))


def test_error_rates(spark):
    assert [r.word_errors for r in rows(spark).orderBy("record_no", "word_errors").collect()] == [1, 2, 0, 2]
    got = {r.corpus: r for r in evaluate.micro(rows(spark), "corpus").collect()}
    assert got["x"].wer == 1.0 and got["y"].wer == 0.5 and got["y"].exact == 0.5 and got["y"].empty == 0.5
    assert evaluate.macro(rows(spark), "corpus").first().worst == "x"
    assert evaluate.micro(rows(spark).filter("false"), "corpus").count() == 0


def test_bootstrap_holds_the_rate(spark):
    data = [(i, "x", "dev", ["a", "b"], ["a", "b" if i % 4 else "c"]) for i in range(200)]
    r = evaluate.bootstrap(evaluate.scored(spark.createDataFrame(data, SCHEMA)), "corpus", "record_no").first()
    assert r.low < 0.125 < r.high and r.high - r.low < 0.12


def test_panel(spark):
    df = spark.createDataFrame([(i, "c", f"{i:02d}", 64_000 if i else 1) for i in range(5)], "record_no long, corpus string, audio_sha256 string, audio_size long")
    assert [(r.record_no, r.label) for r in evaluate.panel(df, 64_000, 224_000).orderBy("label").collect()] == [(1, "dev_01"), (2, "dev_02")]


def test_paired_difference(spark):
    make = lambda k: evaluate.scored(spark.createDataFrame([(i, "x", "dev", ["a", "b"], ["a", "b" if i % k else "c"]) for i in range(300)], SCHEMA))
    r = evaluate.paired_difference(make(2), make(3), "record_no").first()
    assert abs(r.difference - (0.25 - 100 / 600)) < 1e-9 and r.low < r.difference < r.high
    same = evaluate.paired_difference(make(2), make(2), "record_no").first()
    assert (same.difference, same.low, same.high) == (0.0, 0.0, 0.0)
