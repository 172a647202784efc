import random
from fractions import Fraction

import numpy as np
import pytest
from data import audit, near

from voxloom.llm import cross_split, near_dup
from voxloom.llm.fm_index import FMIndex, spans


def collection(seed, n=160):
    """Families of texts with edits, insertions and changed order, beside unrelated ones."""
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(400)] + ["é", "éx", "ɛ̀", "о"]
    common = [f"c{i}" for i in range(6)]
    rows, bases = [], []
    for i in range(n):
        if not bases or rnd.random() < 0.4:
            bases.append(rnd.sample(words, rnd.randrange(8, 30)) + rnd.sample(common, 3))
        t = list(rnd.choice(bases))
        for _ in range(rnd.randrange(0, max(2, len(t) // 3))):
            t[rnd.randrange(len(t))] = rnd.choice(words)
        if rnd.random() < 0.3:
            rnd.shuffle(t)
        if rnd.random() < 0.3:
            t.insert(rnd.randrange(len(t)), rnd.choice(words))
        rows.append((i, rnd.choice(["train", "train", "validation", "test"]), " ".join(t)))
    rows += [(n, "train", None), (n + 1, "test", ""), (n + 2, "train", "short text"), (n + 3, None, rows[0][2]), (n + 4, "train", rows[0][2]), (n + 5, "test", rows[0][2] + "​")]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, seed, monkeypatch):
    rows = collection(seed)
    df = audit(spark, [*rows, *[(*r, None, "studio", None, 5.0, 9) for r in rows[:20]]])
    every = list(near(rows))
    crossing = {(a, b) for a, b, x, y in every if {x[0], y[0]} & {"train"} and {x[0], y[0]} & {"validation", "test"}}
    got = cross_split.cross_split_pairs(df).collect()
    assert sorted((min(r.train_record, r.evaluation_record), max(r.train_record, r.evaluation_record)) for r in got) == sorted(crossing) and len(crossing) > 20
    texts = {(a, b) for a, b, x, y in every if x[2] != y[2]}
    found = [tuple(r) for r in near_dup.near_pairs(df).collect()]
    assert len(found) == len(set(found)) and not set(found) - texts and len(texts - set(found)) <= 0.02 * len(texts)


@pytest.mark.parametrize("t", [Fraction(3, 5), Fraction(1, 2), Fraction(4, 5), Fraction(3, 10), Fraction(1)])
def test_thresholds_and_shards(spark, t):
    rows = collection(5, 120)
    df = audit(spark, rows)
    from voxloom.llm.word_sets import classes_and_members, set_rows

    classes, members = classes_and_members(set_rows(df, 10, texts=True))
    number = {r.cid: r.record_no for r in members.groupBy("cid").agg({"record_no": "min"}).withColumnRenamed("min(record_no)", "record_no").collect()}
    sets = {r.cid: (r.train, r.evaluation, set(r.seq)) for r in classes.collect()}
    want = {(a, b) for a, x in sets.items() for b, y in sets.items() if x[0] and y[1] and len(x[2] & y[2]) * t.denominator >= t.numerator * len(x[2] | y[2])}
    got = cross_split.class_pairs(classes, t, shard_words=120).collect()
    assert {(r.a, r.b) for r in got} == want and len(got) == len(want) and number
    for r in got:
        assert r.shared == len(sets[r.a][2] & sets[r.b][2])


def runs(a, b):
    """All maximal runs of two or more words that two texts share, tried out."""
    out = []
    for i in range(len(a)):
        for j in range(len(b)):
            n = 0
            while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
                n += 1
            if n >= 2 and not (i and j and a[i - 1] == b[j - 1]):
                out.append((i, j, n))
    return sorted(out)


def test_spans_are_those_of_the_texts(spark):
    from voxloom.llm.word_sets import classes_and_members, set_rows

    rows = collection(7, 120) + [(900, "train", " ".join(["a", "b", "a", "b"] + [f"r{i}" for i in range(12)] + ["a", "b"])), (901, "test", " ".join(["a", "b", "x"] + [f"r{i}" for i in range(12)] + ["b", "a", "b"]))]
    classes, _ = classes_and_members(set_rows(audit(spark, rows), 10, texts=True))
    texts = {r.cid: r.words for r in classes.collect()}
    got = cross_split.class_pairs(classes).collect()
    assert len(got) > 20 and any(len(r.spans) > 1 for r in got)
    for r in got:
        a, b = texts[r.a], texts[r.b]
        every = runs(a, b)
        assert r.matches == len(every) and r.longest == max((n for *_, n in every), default=0)
        spans_, last = [], None
        for i, j, n in every:
            if last and 0 <= i - (last[0] + last[2]) <= cross_split.GAP and 0 <= j - (last[1] + last[2]) <= cross_split.GAP:
                spans_[-1] = (spans_[-1][0], i + n, spans_[-1][2], j + n, spans_[-1][4] + n)
            else:
                spans_.append((i, i + n, j, j + n, n))
            last = (i, j, n)
        assert [tuple(x) for x in r.spans] == spans_


def test_many_shards_read_training_once(spark):
    from voxloom.llm.word_sets import classes_and_members, set_rows

    rows = collection(11, 200)
    classes, _ = classes_and_members(set_rows(audit(spark, rows), 10, texts=True))
    one, many = cross_split.class_pairs(classes), cross_split.class_pairs(classes, shard_words=40)
    assert cross_split.build_index(classes.filter("evaluation"), 40)[1] >= 20
    plan = many._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and plan.count("FileScan") == 1 and "Union" not in plan
    key = lambda df: sorted(tuple(map(str, r)) for r in df.collect())
    assert key(one) == key(many)


def test_a_stored_index_is_smaller_than_its_text():
    rnd = np.random.default_rng(1)
    vocabulary = [f"word{i:04d}" for i in range(3000)]
    lengths = rnd.integers(10, 40, 4000)
    flat = np.minimum(rnd.zipf(1.3, lengths.sum()) - 1, 2999)
    index = FMIndex(np.arange(4000), flat * 7919, lengths)
    text = sum(len(vocabulary[w]) + 1 for w in flat)
    assert len(index.dump()) < 0.6 * text
    back = FMIndex.load(index.dump()).unpack()
    assert (back.vocabulary[back.symbols - 1] == flat * 7919).all()
    offsets = np.concatenate(([0], np.cumsum(lengths)))
    suffix = [tuple(back.symbols[offsets[d] + a : offsets[d + 1]]) for d, a in zip(back.doc[-2000:], back.at[-2000:], strict=True)]
    assert all(x <= y or y == x[: len(y)] for x, y in zip(suffix, suffix[1:], strict=False))


def test_a_very_long_text_is_unpacked_from_its_samples():
    flat = np.arange(200_000) % 977 * 31 + np.arange(200_000) // 50_000
    index = FMIndex.load(FMIndex(np.arange(2), np.append(flat, 5), np.array([200_000, 1])).dump()).unpack()
    assert (index.vocabulary[index.symbols - 1] == np.append(flat, 5)).all()


def test_counts_and_emptiness(spark):
    text = " ".join(f"w{i}" for i in range(12))
    df = audit(spark, [(1, "train", text), (2, "train", text), (3, "test", text), (4, "validation", text + " more")])
    got = {r.split: r for r in cross_split.overlap_counts(df).collect()}
    assert (got["test"].records, got["test"].train_records, got["test"].pairs, got["test"].same_words) == (1, 2, 2, 2) and got["validation"].same_words == 0
    for empty in (df.filter("false"), df.filter("split = 'train'"), df.filter("split = 'test'")):
        assert cross_split.cross_split_pairs(empty).count() == 0
    assert near_dup.near_pairs(df.filter("false")).count() == 0 and near_dup.near_groups(df.filter("false")).count() == 0


def test_groups(spark):
    base = [f"w{i}" for i in range(20)]
    texts = [base, base[2:] + ["x"], base[4:] + ["x", "y", "z"], base[::-1], [f"v{i}" for i in range(15)], base]
    got = {r.record_no: r for r in near_dup.near_groups(audit(spark, [(i + 1, "train", " ".join(t)) for i, t in enumerate(texts)])).collect()}
    assert {k: (r.group_id, r.group_records) for k, r in got.items()} == {1: (1, 5), 2: (1, 5), 3: (1, 5), 4: (1, 5), 5: (5, 1), 6: (1, 5)}
    assert got[5].links == 0 and got[1].links == 4 and got[2].links == 4


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (501, 500), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in near_dup.components(links).collect()}
    assert got == {**{i: 0 for i in range(201)}, 500: 500, 501: 500}


def test_index_counts_every_substring():
    rnd = np.random.default_rng(1)
    docs = [np.sort(rnd.choice(40, rnd.integers(1, 15), replace=False)).astype(np.int64) for _ in range(60)]
    index = FMIndex.load(FMIndex(np.arange(60) * 3, np.concatenate(docs), np.array([len(d) for d in docs])).dump()).unpack()
    for d in docs[:20]:
        for i in range(len(d)):
            s = index.symbol_of(d[: i + 1])
            first = np.zeros(i + 2, bool)
            first[0] = True
            for depth in (1, 2):
                low, high, length = index.matches(s, first, depth)
                if i + 1 >= depth:
                    pattern = d[i + 1 - depth : i + 1]
                    holders = sorted(k for k, e in enumerate(docs) if any((e[j : j + depth] == pattern).all() for j in range(len(e) - depth + 1)))
                    assert sorted(index.doc[low[i] : high[i]].tolist()) == holders
            assert length[i] == i + 1
    assert index.symbol_of(np.array([99])).tolist() == [0]
    assert spans(np.array([3, 10]), np.array([2, 0])).tolist() == [3, 4] and len(FMIndex(np.zeros(0), np.zeros(0, np.int64), np.zeros(0, int)).unpack().doc) == 0


@pytest.mark.parametrize("j", [0.3, 0.6, 0.9])
def test_sketches_estimate_similarity(j):
    rnd = np.random.default_rng(2)
    n = 60
    shared = round(2 * n * j / (1 + j))
    sets = []
    for _ in range(200):
        keys = rnd.integers(-(2**62), 2**62, 2 * n - shared)
        sets += [keys[:n], keys[n - shared :]]
    r = near_dup.sketches(np.concatenate(sets), np.array([len(s) for s in sets]), 0, 144)
    got = near_dup.similarity_estimate(r[::2], r[1::2], np.full(200, float(n)), np.full(200, float(n)))
    assert abs(got.mean() - shared / (2 * n - shared)) < 0.01
    assert (np.maximum(r[0], r[1]) == near_dup.sketches(np.union1d(sets[0], sets[1]), np.array([2 * n - shared]), 0, 144)[0]).all()


def test_slices_hold_the_limit():
    import pyarrow as pa

    lengths = [3, 0, 5, 12, 1, 1, 4, 0]
    batch = pa.RecordBatch.from_arrays([pa.array([list(range(n)) for n in lengths], pa.list_(pa.int64()))], ["seq"])
    parts = list(cross_split.sliced([batch.slice(1), batch.slice(0, 0)], most=6))
    assert [x for p in parts for x in p.column("seq").to_pylist()] == batch.column("seq").to_pylist()[1:]
    sizes = [[len(x) for x in p.column("seq").to_pylist()] for p in parts]
    assert all(sum(s) <= 6 or len(s) == 1 for s in sizes)


def test_sketches_of_sets_larger_than_a_piece(monkeypatch):
    flat, lengths = np.arange(1000, dtype=np.int64) % 300, np.array([400, 0, 600])
    whole = near_dup.sketches(flat, lengths, 0, 20)
    monkeypatch.setattr(near_dup, "_AT_ONCE", 37)
    assert (near_dup.sketches(flat, lengths, 0, 20) == whole).all() and not whole[1].any()
