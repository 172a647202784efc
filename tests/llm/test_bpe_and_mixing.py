import base64
import random

import numpy as np
import pytest
from data import documents

from voxloom.llm import bpe, mixing

pytest.importorskip("tiktoken")


@pytest.fixture(scope="module")
def reference():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(bpe.VOCABULARY, "rb"))}
    return tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    rnd = random.Random(1)
    pool = ["a", "b", " ", "  ", "\n", "\t", "é", "ɛ̀", "中", "ก", "🎧", "'s", "1", " ", "the ", "ing", ".", "!", "​", "ا"]
    return ["".join(rnd.choices(pool, k=rnd.randrange(1, 60))) for _ in range(800)] + ["x" * 5000, " " * 3000, "中" * 4000, "ab" * 20_000, "<|endoftext|>", "\ud83d".encode("utf-16", "surrogatepass").decode("utf-16", "replace")]


def test_ids_and_round_trip(reference):
    tokenizer = bpe.load()
    for t in texts():
        ids = tokenizer.encode(t)
        assert ids == reference.encode_ordinary(t) and tokenizer.decode(ids) == t


def test_whole_table(spark, reference):
    rows = [(i, t, "s") for i, t in enumerate(texts()[-60:])] + [(900, None, None), (901, "", "s"), (902, " ", "s"), (902, " ", "s")]
    got = {r.doc_id: r.ids for r in bpe.encoded(documents(spark, rows)).collect()}
    assert got[900] == [] == got[901] and all(got[i] == reference.encode_ordinary(t or "") for i, t, _ in rows)
    back = {r.doc_id: r.text for r in bpe.decoded(bpe.encoded(documents(spark, rows))).collect()}
    assert all(back[i] == (t or "") for i, t, _ in rows)
    assert bpe.encoded(documents(spark, rows).filter("false")).count() == 0


def test_forgetting_pieces_changes_nothing(monkeypatch, reference):
    monkeypatch.setattr(bpe, "PIECES_HELD", 3)
    tokenizer = bpe.ByteBPE(open(bpe.VOCABULARY, "rb").read())
    assert all(tokenizer.encode(t) == reference.encode_ordinary(t) for t in texts()[:60])


TARGETS = "mix_name string, source string, target_share double, max_repeats int, rate string"


def corpus(spark, n=2400):
    rnd = random.Random(2)
    words = {"big": "one two three four", "mid": "alpha beta gamma delta", "low": "rot blau gelb weiss"}
    rows = []
    for i in range(n):
        source = "big" if i % 10 < 7 else "mid" if i % 10 < 9 else "low"
        rows.append((i, " ".join(rnd.choices(words[source].split(), k=rnd.randrange(3, 60))), None if i % 40 == 0 else source))
    return rows + [(n, None, "big"), (n + 1, "", "mid"), (n + 2, "x y", "untargeted"), (n + 3, "x " * 50, " ")]


def test_shares_are_reached_within_limits(spark):
    t = spark.createDataFrame([("m", "big", 0.5, 1, "x"), ("m", "mid", 0.3, 2, "x"), ("m", "low", 0.2, 3, "x"), ("k", "low", 1.0, 2, "x"), ("k", "big", 0.0, 1, "x"), ("k", "gone", 0.0, 5, "x"), ("k", "low", 1.0, 2, "x"), (None, "low", 1.0, 1, "x")], TARGETS)
    used = mixing.mixture(documents(spark, corpus(spark)), t).cache()
    limits = {("m", "big"): 1, ("m", "mid"): 2, ("m", "low"): 3, ("k", "low"): 2}
    rows = used.collect()
    assert {(r.mix_name, r.source) for r in rows} == set(limits) and all(1 <= r.repeats <= limits[r.mix_name, r.source] for r in rows) and len({(r.mix_name, r.doc_id) for r in rows}) == len(rows)
    shares = {(r.mix_name, r.source): r for r in mixing.reached_shares(used, t.filter("mix_name is not null")).collect()}
    for source, want in (("big", 0.5), ("mid", 0.3), ("low", 0.2)):
        assert abs(shares["m", source].share - want) < 0.01
    assert shares["k", "low"].share == 1.0 and shares["k", "gone"].tokens == 0 and shares["k", "big"].documents == 0
    # the binding source is used up: every document of it as often as allowed
    low = [r for r in rows if r.mix_name == "k" and r.labelled]
    assert all(r.repeats == 2 for r in low)


def test_unlabelled_documents_go_to_their_likely_source(spark):
    rows = corpus(spark)
    members, names, model = mixing.memberships(documents(spark, rows))
    soft = {r.doc_id: r.posterior for r in members.filter("stated = -1").collect()}
    truth = {i: "big" if i % 10 < 7 else "mid" if i % 10 < 9 else "low" for i in range(2400)}
    right = [names[int(np.argmax(soft[i]))] == truth[i] for i in soft if i in truth]
    assert len(right) == 60 and np.mean(right) > 0.95 and all(abs(sum(p) - 1) < 1e-9 for p in soft.values()) and 2403 in soft


def test_the_classifier_counts_whole_texts(spark):
    same, own = "one two three four " * 700, {"a": "alpha beta " * 700, "b": "rot blau " * 700}  # texts differ past 2 000 tokens only
    rows = [(i, same + own["ab"[i % 2]], "ab"[i % 2]) for i in range(60)] + [(60, same + own["a"], None), (61, same + own["b"], None)]
    members, names, model = mixing.memberships(documents(spark, rows))
    soft = {r.doc_id: r.posterior for r in members.filter("stated = -1").collect()}
    assert names == ["a", "b"] and model.scale > 0 and soft[60][0] > 0.95 and soft[61][1] > 0.95


def test_missing_documents_and_targets(spark):
    t = spark.createDataFrame([("m", "big", 0.5, 1, "x"), ("m", "gone", 0.5, 2, "x")], TARGETS)
    docs = documents(spark, corpus(spark)[:50])
    assert {r.source for r in mixing.mixture(docs, t).collect()} == {"big"}
    assert mixing.mixture(docs.filter("false"), t).count() == 0 and mixing.mixture(docs, t.filter("false")).count() == 0
    assert mixing.mixture(docs.filter("source is null"), t).count() == 0


def test_wrong_labels_are_seen_through(spark):
    """A tenth of the stated sources are wrong; the shares hold for the true ones."""
    rows = [(i, x, s) for i, x, s in corpus(spark) if s in ("big", "mid", "low") and x]
    truth = {i: s for i, _, s in rows}
    wrong = {"big": "mid", "mid": "low", "low": "big"}
    planted = documents(spark, [(i, x, wrong[s] if i % 11 == 5 else s) for i, x, s in rows])
    members, names, model = mixing.memberships(planted)
    likely = {r.doc_id: names[r.likely] for r in members.collect()}
    assert model.scale > 0 and all(0.85 < x < 0.95 for x in np.diag(model.stating))
    assert np.mean([likely[i] == truth[i] for i in truth]) > 0.99 and all(abs(sum(r.posterior) - 1) < 1e-9 for r in members.collect())
    t = spark.createDataFrame([("m", "big", 0.5, 1, "x"), ("m", "mid", 0.3, 1, "x"), ("m", "low", 0.2, 1, "x")], TARGETS)
    used = mixing.mixture(planted, t).collect()
    total = sum(r.tokens * r.repeats for r in used)
    for source, want in (("big", 0.5), ("mid", 0.3), ("low", 0.2)):
        assert abs(sum(r.tokens * r.repeats for r in used if truth[r.doc_id] == source) / total - want) < 0.01
    assert [tuple(r) for r in mixing.violations(planted, t).collect()] == [("m", 0, 0)]


def test_rates_meet_soft_targets():
    sums = np.array([[80.0, 20.0], [30.0, 70.0], [0.0, 50.0]])  # expected tokens by cell and source
    rates, wanted = mixing.fit_rates(sums.sum(1), sums, np.array([0, 1, 1]), np.array([[1.0, 1.0, 1.0]]), np.array([[0.5, 0.5]]))
    assert np.allclose(rates @ sums, wanted, atol=1e-3) and (rates >= 0).all() and (rates <= 1).all() and wanted[0, 0] == wanted[0, 1] == 100


def test_filling_passes_over_documents_too_large(spark):
    sizes = [3000, 2900, *[7] * 40, *[60] * 5, 1]
    rows = [(i, "one " * n, "big") for i, n in enumerate(sizes)] + [(100 + i, "alpha " * 50, "mid") for i in range(10)]
    t = spark.createDataFrame([("m", "big", 0.5, 1, "x"), ("m", "mid", 0.5, 1, "x")], TARGETS)
    docs = documents(spark, rows)
    assert [tuple(r) for r in mixing.violations(docs, t).collect()] == [("m", 0, 0)]
    got = {r.source: r for r in mixing.reached_shares(mixing.mixture(docs, t), t).collect()}
    assert abs(got["big"].share - 0.5) < 0.005 and got["mid"].documents == 10


def test_scans_do_not_grow_with_rounds(spark, monkeypatch):
    passes = []
    real = mixing.materialize
    monkeypatch.setattr(mixing, "materialize", lambda df, name: (passes.append(name), real(df, name))[1])
    t = spark.createDataFrame([("m", "big", 0.5, 1, "x"), ("m", "mid", 0.5, 2, "x")], TARGETS)
    for rounds in (1, 2000):
        monkeypatch.setattr(mixing, "ROUNDS", rounds)
        mixing.mixture(documents(spark, corpus(spark, 300)), t).count()
    assert passes[: len(passes) // 2] == passes[len(passes) // 2 :]
