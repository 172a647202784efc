"""Mixing sources to target shares of tokens (problem 8), by soft membership.

Every document has a posterior over the sources: its stated source is evidence, as strong as stated sources
have proved right on held-out documents, and its text is evidence by a classifier fitted on a labelled sample. Documents of alike
membership (stated source, likeliest source, grade of confidence) form a cell and share a rate, the
expected number of uses. One pass sums tokens times posterior per cell; on these sums, which are all that the totals
depend on, projected-gradient least squares fits the rates, so the tables aren't read again however many rounds
it takes. Rates become whole numbers of uses by a threshold on a hash, and what a threshold leaves open is filled
with documents that still fit.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, replace
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import bpe

LABELLED_SAMPLE = 4000  # labelled documents the classifier is fitted on
FEATURES = 1 << 14
SCALES = (0.0, 0.02, 0.05, 0.1, 0.2, 0.5, 1.0, 2.0, 4.0)
CLEANINGS = 3  # times the labels of the sample are weighed anew, at most
TOLERANCE = 0.01  # of the held-out labels' negative log-likelihood per document
GRADES = 16  # of confidence in the likeliest source
ROUNDS = 2000
BINS = 4096
FEW = 8  # documents of mean size that filling up may have to make up for
FILLERS = 32  # documents of each size class offered at a time to fill up a source


@dataclass
class Classifier:
    """Multinomial naive Bayes over hashed token ids, with stated sources that may be wrong.

    Tokens of a text aren't independent, so their summed evidence is divided by the root of the length and
    scaled by the factor that gives held-out labels the greatest likelihood: 0, the prior alone, where texts don't tell
    sources apart. ``stating`` holds the probability that a document of a source (row) states each source (column);
    without it stated sources are right.
    """

    sources: list[str]
    prior: np.ndarray
    weights: np.ndarray
    scale: float = 1.0
    stating: np.ndarray | None = None

    @classmethod
    def counted(cls, sources: list[str], labelled: np.ndarray, counts: np.ndarray) -> Classifier:
        """From the documents of each source and the counts of each source's hashed ids."""
        prior, counts = labelled + 1.0, counts + 0.1
        return cls(sources, np.log(prior / prior.sum()), np.log(counts / counts.sum(1, keepdims=True)))

    def likeliest(self, evidence: np.ndarray, truth: np.ndarray) -> tuple[float, float]:
        """The scale that gives the labels of held-out documents the greatest likelihood, after its negative logarithm per document."""

        def loss(scale: float) -> float:
            z = self.prior + scale * evidence
            z = np.exp(z - z.max(1, keepdims=True))
            z /= z.sum(1, keepdims=True)
            right = z[np.arange(len(truth)), truth] if self.stating is None else (z * self.stating.T[truth]).sum(1)
            return -float(np.log(np.maximum(right, 1e-300)).mean())

        return min((loss(s), s) for s in SCALES)

    def evidence(self, ids: list[int]) -> np.ndarray:
        if not ids:
            return np.zeros(len(self.sources))
        at = np.asarray(ids, np.int64) % FEATURES
        summed = self.weights[:, at].sum(1) if len(at) < FEATURES else self.weights @ np.bincount(at, minlength=FEATURES)
        return summed / np.sqrt(len(at))

    def posterior(self, ids: list[int], stated: int = -1) -> np.ndarray:
        """The probability of each source, given the text and the number of the stated source (-1: none)."""
        k = len(self.sources)
        if not k:
            return np.zeros(0)
        if stated >= 0 and self.stating is None:
            return (np.arange(k) == stated).astype(float)
        x = self.prior + self.scale * self.evidence(ids) if self.scale else self.prior
        x = np.exp(x - x.max())
        if stated >= 0:
            x = x * self.stating[:, stated]
        return x / x.sum()


def cell_of(stated: np.ndarray, likely: np.ndarray, confidence: np.ndarray, k: int) -> np.ndarray:
    """Documents of one cell have one rate; there are at most (k + 1) k GRADES cells, whatever the documents."""
    return ((stated + 1) * k + likely) * GRADES + np.minimum((confidence * GRADES).astype(np.int64), GRADES - 1)


def _counted(rows: DataFrame, names: list[str], model: Classifier | None) -> tuple[np.ndarray, np.ndarray]:
    """Counts of hashed ids by part (fitted on, held out) and source, and documents by part, source and stated source, added up where the documents are; with a model, each
    document counts for every source by its posterior."""
    k = len(names)
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        counts = np.zeros((2, k, FEATURES + k))  # the last numbers are those of documents by stated source
        for batch in batches:
            for n, held, ids in zip(batch.column("n").to_pylist(), batch.column("held").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                seen = np.append(np.bincount(np.asarray(ids, np.int64) % FEATURES, minlength=FEATURES), np.arange(k) == n)
                if shared.value is None:
                    counts[int(held), n] += seen
                else:
                    counts[int(held)] += shared.value.posterior(ids, n)[:, None] * seen
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts.ravel()[at])], ["at", "c"])

    got = rows.select("n", "held", "ids").mapInArrow(run, "at long, c double").groupBy("at").agg(F.sum("c").alias("c")).toArrow()
    out = np.zeros((2, k, FEATURES + k))
    out.ravel()[got["at"].to_numpy()] = got["c"].to_numpy()
    return out[:, :, :FEATURES], out[:, :, FEATURES:]


def _fitted(labelled: DataFrame, names: list[str]) -> Classifier:
    """The classifier of the labelled sample, from whole texts: FEATURES numbers a source, and the evidence of the held-out
    fifth, reach the driver.

    Wrong labels blur the counts without making labels less likely. So where texts tell sources apart, the counts are made again with each
    document shared out by its posterior, and again, and kept if held-out labels stay as likely (TOLERANCE)."""
    spark, k = labelled.sparkSession, len(names)
    rows = labelled.select(F.col("stated").alias("n"), (F.pmod(F.xxhash64(F.lit(4), "doc_id"), F.lit(5)) == 4).alias("held"), "ids")
    best = guess = None
    for _ in range(CLEANINGS + 1):
        counts, documents = _counted(rows, names, guess)
        whole = Classifier.counted(names, documents.sum((0, 2)), counts.sum(0))
        if not documents.sum((1, 2)).all():
            return replace(whole, scale=0.0)  # nothing is held out, or nothing else there
        part = Classifier.counted(names, documents[0].sum(1), counts[0])
        if guess is not None:
            share = lambda d: (d + 1e-3) / (d + 1e-3).sum(1, keepdims=True)
            part.stating, whole.stating = share(documents[0]), share(documents.sum(0))
        shared = spark.sparkContext.broadcast(part)

        def weigh(batches, shared=shared):
            for batch in batches:
                evidence = [shared.value.evidence(x).tolist() for x in batch.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column("n"), pa.array(evidence, pa.list_(pa.float64()))], ["n", "evidence"])

        held = rows.filter("held").select("n", "ids").mapInArrow(weigh, "n int, evidence array<double>").collect()
        loss, whole.scale = part.likeliest(np.array([r["evidence"] for r in held]), np.array([r["n"] for r in held]))
        if best is not None and loss > best[0] + TOLERANCE:
            break
        best = (loss if best is None else min(loss, best[0])), whole
        if not whole.scale or k == 1:
            break
        doubt = np.full((k, k), 0.1 / (k - 1)) + np.eye(k) * (0.9 - 0.1 / (k - 1))
        guess = replace(part, scale=1.0, stating=doubt if part.stating is None else part.stating)
    return best[1]


def memberships(documents: DataFrame, path: str = bpe.VOCABULARY, sample: int = LABELLED_SAMPLE) -> tuple[DataFrame, list[str], Classifier]:
    """``(doc_id, tokens, stated, likely, cell, posterior)`` of every document, the sources' names in the order of their numbers, and
    the classifier.

    stated is the number of the document's source, -1 for a null or blank one; likely that of the greatest posterior. Texts
    are encoded once, but for the sample's.
    """
    spark = documents.sparkSession
    source = F.trim(F.col("source"))
    rows = documents.select("doc_id", "text", F.when(source != "", source).alias("source"))
    counts = rows.groupBy("source").agg(F.count("*").alias("n")).collect()  # a row per source
    names = sorted(r["source"] for r in counts if r["source"] is not None)
    number = F.coalesce(F.array_position(F.array(*map(F.lit, names)) if names else F.array().cast("array<string>"), F.col("source")) - 1, F.lit(-1)).cast("int")
    rows = rows.select("doc_id", "text", number.alias("stated"))
    share = min(1.0, sample / max(sum(r["n"] for r in counts if r["source"] is not None), 1))
    taken = F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(1_000_000)) < int(share * 1_000_000)
    file = spark.sparkContext.broadcast(Path(path).read_bytes())
    kind = dict(documents.dtypes)["doc_id"]

    def encode(batches):
        model = bpe._loaded(file.value)
        for batch in batches:
            ids = pa.array([model.encode(t) for t in batch.column("text").to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("stated"), ids], ["doc_id", "stated", "ids"])

    model = Classifier([], np.zeros(0), np.zeros((0, FEATURES)))
    if names:
        model = _fitted(materialize(rows.filter((F.col("stated") >= 0) & taken).mapInArrow(encode, f"doc_id {kind}, stated int, ids array<int>"), "labelled"), names)
    shared = spark.sparkContext.broadcast(model)

    def weigh(batches):
        tokens, classifier = bpe._loaded(file.value), shared.value
        k = len(classifier.sources)
        for batch in batches:
            ids = [tokens.encode(t) for t in batch.column("text").to_pylist()]
            stated = batch.column("stated").to_numpy()
            p = np.array([classifier.posterior(x, s) for x, s in zip(ids, stated.tolist(), strict=True)]).reshape(len(ids), k)
            likely = p.argmax(1) if k and len(ids) else np.full(len(ids), -1)
            cell = cell_of(stated, likely, p.max(1), k) if k and len(ids) else likely
            columns = [batch.column("doc_id"), pa.array(list(map(len, ids)), pa.int64()), batch.column("stated"), pa.array(likely, pa.int32()), pa.array(cell, pa.int32()), pa.array(list(p), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "tokens", "stated", "likely", "cell", "posterior"])

    made = rows.mapInArrow(weigh, f"doc_id {kind}, tokens long, stated int, likely int, cell int, posterior array<double>")
    return materialize(made, "memberships"), names, model


def cell_sums(rows: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of the cells that hold tokens, their tokens, and their expected tokens of each source: one pass,
    added up per task, and a number per cell and source reaches the driver."""

    def run(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            cells, n = batch.column("cell").to_numpy(), batch.column("tokens").to_numpy().astype(float)
            p = batch.column("posterior").flatten().to_numpy().reshape(-1, k) * n[:, None]
            for c in np.unique(cells):
                at = cells == c
                total[int(c)] = total.get(int(c), 0.0) + np.append(p[at].sum(0), n[at].sum())
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([v.tolist() for v in total.values()], pa.list_(pa.float64()))], ["cell", "v"])

    parts = rows.filter("tokens > 0").select("cell", "tokens", "posterior").mapInArrow(run, "cell int, v array<double>")
    got = parts.select("cell", F.posexplode("v").alias("i", "v")).groupBy("cell", "i").agg(F.sum("v").alias("v")).collect()
    cells = sorted({r["cell"] for r in got})
    out = np.zeros((len(cells), k + 1))
    for r in got:
        out[cells.index(r["cell"]), r["i"]] = r["v"]
    return np.array(cells, int), out[:, k], out[:, :k]


def fit_rates(tokens: np.ndarray, sums: np.ndarray, likely: np.ndarray, caps: np.ndarray, targets: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Rates (mixes by cells) and the wanted tokens (mixes by sources).

    The wanted total of a mix is the largest at which every source with documents can hold its share:
    the smallest of uses allowed x tokens / share, of expected tokens and of those of the documents counted for
    the source. The gradient of the squared residuals is scaled by each source's tokens; rates are
    projected to what ``caps`` (mixes by cells) allows.
    """
    m, k = targets.shape
    own = np.zeros((m, k))
    for s in range(k):
        own[:, s] = np.minimum((caps * tokens)[:, likely == s].sum(1), caps @ sums[:, s])
    shares = np.where(own > 0, targets, 0)
    shares = np.divide(shares, shares.sum(1, keepdims=True), out=np.zeros_like(shares), where=shares.sum(1, keepdims=True) > 0)
    limits = np.where(shares > 0, own / np.where(shares > 0, shares, 1), np.inf).min(1, initial=np.inf)
    wanted = shares * np.where(np.isfinite(limits), limits, 0)[:, None]
    there = sums.sum(0)
    mean = np.divide(sums, tokens[:, None], out=np.zeros_like(sums), where=tokens[:, None] > 0)
    rates, last = caps / 2, None
    for _ in range(rounds):
        residual = rates @ sums - wanted
        if last is not None and np.abs(residual - last).max(initial=0) <= 1e-9 * max(wanted.max(initial=0), 1):
            break
        last = residual
        rates = np.clip(rates - np.divide(residual, there, out=np.zeros_like(residual), where=there > 0) @ mean.T, 0, caps)
    return rates, wanted


def _of_key(values: dict):
    """The value of a row's mix and source, 0 where there is none."""
    width = max((s for _, s in values), default=0) + 1
    flat = [values.get((m, s), 0) for m in range(max((m for m, _ in values), default=0) + 1) for s in range(width)]
    inside = F.col("likely") < width
    return F.coalesce(F.when(inside, F.get(F.array(*map(F.lit, flat)), F.col("mix") * width + F.col("likely"))), F.lit(0))


def _thresholds(rows: DataFrame, left: dict) -> tuple[dict, dict]:
    """Per mix and source the value of v below which all rows' tokens fit into what is left, which is reduced by them, and
    the rows' mean tokens. Two histograms of at most BINS numbers each."""
    bins = rows.groupBy("mix", "likely", F.floor(F.col("v") / BINS).cast("int").alias("bin")).agg(F.sum("tokens").alias("t"), F.count("*").alias("n")).collect()
    edge, inside, sums = {}, {}, {}
    for r in sorted(bins, key=lambda r: r["bin"]):
        key = r["mix"], r["likely"]
        t, n = sums.get(key, (0, 0))
        sums[key] = t + r["t"], n + r["n"]
        if key in inside:
            continue
        if r["t"] > left[key]:
            inside[key] = edge[key] = r["bin"] * BINS
        else:
            left[key], edge[key] = left[key] - r["t"], (r["bin"] + 1) * BINS
    mean = {key: t / n for key, (t, n) in sums.items()}
    if not inside:
        return edge, mean
    done = set()
    fine = rows.filter((_of_key({k: 1 for k in inside}) == 1) & (F.floor(F.col("v") / BINS) * BINS == _of_key(inside)))
    for r in sorted(fine.groupBy("mix", "likely", "v").agg(F.sum("tokens").alias("t")).collect(), key=lambda r: r["v"]):
        key = r["mix"], r["likely"]
        if key not in done and r["t"] <= left[key]:
            left[key], edge[key] = left[key] - r["t"], r["v"] + 1
        else:
            done.add(key)
    return edge, mean


def _filled(rated: DataFrame, left: dict) -> list[tuple]:
    """``(mix, doc_id, more)`` of documents used more often so that each source comes as near to its target as whole
    documents allow: the largest that fits first, and at last the smallest where that comes nearer than none.

    Of each source and size class (powers of two) at most FILLERS documents are offered at a time, by hash, and the smallest;
    the rest is offered again only while a whole class has been used up."""
    kind = dict(rated.dtypes)["doc_id"]
    spare = materialize(rated.filter(F.col("repeats") < F.col("most")).select("mix", "likely", "doc_id", "tokens", "u", (F.col("most") - F.col("repeats")).alias("times")), "spare")
    size, x = F.floor(F.log2(F.col("tokens").cast("double"))).cast("int").alias("size"), lambda *order: F.min(F.struct(*order, "tokens", "doc_id", "times"))
    chosen, spent = Counter(), []
    while any(n > 0 for n in left.values()):
        free = spare.join(F.broadcast(spare.sparkSession.createDataFrame(spent, f"mix int, doc_id {kind}")), ["mix", "doc_id"], "left_anti") if spent else spare
        offers = free.groupBy("mix", "likely", size, F.pmod("u", F.lit(FILLERS)).alias("slot")).agg(x("u").alias("x"), x().alias("y"), F.count("*").alias("n")).collect()
        by: dict = {}
        for r in offers:
            held = by.setdefault((r["mix"], r["likely"]), {})
            for o in (r["x"], r["y"]):
                held[o["doc_id"]] = o["tokens"], o["times"] - chosen[r["mix"], o["doc_id"]]
        count, offered, more = sum(r["n"] for r in offers), sum(map(len, by.values())), False
        for key, held in by.items():
            room = left.get(key, 0)
            for doc, (t, times) in sorted(held.items(), key=lambda o: (-o[1][0], o[0])):
                n = min(times, int(room // t))
                if n > 0:
                    chosen[key[0], doc] += n
                    room, more = room - n * t, True
                if n == times:
                    spent.append((key[0], doc))
                    del held[doc]
            if room > 0 and held:
                t, doc = min((t, d) for d, (t, _) in held.items())
                if t > room > t / 2:
                    chosen[key[0], doc] += 1
                    room = 0
            left[key] = room
        if not more or count <= offered:
            break
    return [(*key, n) for key, n in chosen.items()]


def rated_documents(documents: DataFrame, targets: DataFrame, path: str = bpe.VOCABULARY) -> tuple[DataFrame, list[str], list[str], np.ndarray]:
    """``(doc_id, tokens, stated, mix, likely, rate, most, u, repeats)`` of every document that a mix may use, used or
    not; the names of mixes and sources by number, and the wanted tokens."""
    spark = documents.sparkSession
    given = targets.filter("mix_name is not null and source is not null").groupBy("mix_name", "source").agg(F.max("target_share").alias("share"), F.max("max_repeats").alias("most")).collect()
    rows, names, _ = memberships(documents, path)
    mixes, k = sorted({r["mix_name"] for r in given}), len(names)
    share, limits = np.zeros((len(mixes), k)), np.zeros((len(mixes), k))
    for r in given:
        if r["source"] in names and (r["share"] or 0) > 0:
            at = mixes.index(r["mix_name"]), names.index(r["source"])
            share[at], limits[at] = r["share"], r["most"] or 0
    cells, tokens, sums = cell_sums(rows, k) if k else (np.zeros(0, int), np.zeros(0), np.zeros((0, 0)))
    stated, likely = cells // GRADES // max(k, 1) - 1, cells // GRADES % max(k, 1)
    caps = np.minimum(limits[:, likely], np.where(stated >= 0, limits[:, stated], np.inf)) if len(cells) else np.zeros((len(mixes), 0))
    rates, wanted = fit_rates(tokens, sums, likely, caps, share)
    table = [(int(c), j, float(rates[j, i]), int(caps[j, i])) for i, c in enumerate(cells) for j in range(len(mixes)) if caps[j, i] > 0]
    table = spark.createDataFrame(table, "cell int, mix int, rate double, most int")  # a row per cell and mix
    rated = rows.filter("tokens > 0").select("doc_id", "tokens", "stated", "likely", "cell").join(F.broadcast(table), "cell")
    whole = F.floor(F.col("rate") + 1e-9).cast("int")
    u = F.pmod(F.xxhash64(F.lit(11), "mix", "doc_id"), F.lit(BINS * BINS)).cast("int")
    rated = rated.withColumns({"whole": whole, "part": F.col("rate") - whole, "u": u})
    # documents whose rate has a larger rest come earlier: at 1 the threshold takes each with the probability of its rest
    v = (F.col("u") + 0.5) / (BINS * BINS) / F.col("part")
    rated = materialize(rated.withColumn("v", F.when(F.col("part") > 1e-9, F.floor(v / (1 + v) * (BINS * BINS)).cast("int"))).drop("cell", "part"), "rated")
    base = rated.groupBy("mix", "likely").agg(F.sum(F.col("tokens") * F.col("whole")).alias("t")).collect()
    left = {(m, s): float(wanted[m, s]) for m in range(len(mixes)) for s in range(k)}
    for r in base:
        left[r["mix"], r["likely"]] -= r["t"]
    taken, rest = F.lit(False), sum(left.values())
    while left:  # again without documents too large for what is left, unless a few documents make that up
        fits = ~taken & F.col("v").isNotNull() & (F.col("tokens") <= _of_key(left))
        edge, mean = _thresholds(rated.filter(fits), left)
        taken = taken | (fits & (F.col("v") < _of_key(edge)))
        before, rest = rest, sum(max(0.0, x) for x in left.values())
        if rest > before / 2 or all(left[key] <= FEW * mean[key] for key in mean):
            break
    rated = rated.withColumn("repeats", F.col("whole") + F.coalesce(taken, F.lit(False)).cast("int")).drop("whole", "v")
    if more := _filled(rated, left):
        extra = spark.createDataFrame(more, f"mix int, doc_id {dict(rated.dtypes)['doc_id']}, more int")
        rated = rated.join(F.broadcast(extra), ["mix", "doc_id"], "left").withColumn("repeats", F.col("repeats") + F.coalesce("more", F.lit(0))).drop("more")
    return rated, mixes, names, wanted


def _named(values: list[str], i):
    return F.element_at(F.array(*map(F.lit, values)), F.col(i) + 1) if values else F.lit(None).cast("string")


def mixture(documents: DataFrame, targets: DataFrame, path: str = bpe.VOCABULARY) -> DataFrame:
    """``(mix_name, doc_id, source, labelled, tokens, rate, repeats)``: the documents used, at least once each.

    A document counts for its likeliest source, which is the stated one unless held-out documents show that stated sources
    are wrong and its text says so; labelled is whether a source is stated. No document is used more than the ``max_repeats`` of the source it
    counts for, nor than that of the source it states. Sources without targets, or with a share of 0, and null texts (no tokens) don't take part;
    a target without documents is left out and the other shares scaled up. Repeated target rows count once.
    """
    rated, mixes, names, _ = rated_documents(documents, targets, path)
    return rated.filter("repeats > 0").select(_named(mixes, "mix").alias("mix_name"), "doc_id", _named(names, "likely").alias("source"), (F.col("stated") >= 0).alias("labelled"), "tokens", "rate", "repeats")


def violations(documents: DataFrame, targets: DataFrame, path: str = bpe.VOCABULARY) -> DataFrame:
    """``(mix_name, over_limit, off_target)``: documents used more often than the targets allow, and sources whose tokens differ from the wanted ones by
    more than half the smallest document that could be used once more, if there is one. Both ought to be 0."""
    rated, mixes, names, wanted = rated_documents(documents, targets, path)
    spark = rated.sparkSession
    asked = targets.filter("mix_name is not null and source is not null").groupBy("mix_name", "source").agg(F.max("max_repeats").alias("allowed"))
    goal = spark.createDataFrame([(m, s, float(wanted[i, j])) for i, m in enumerate(mixes) for j, s in enumerate(names)], "mix_name string, source string, wanted double")
    sums = rated.select(_named(mixes, "mix").alias("mix_name"), _named(names, "likely").alias("source"), "tokens", "repeats", "most").groupBy("mix_name", "source", "repeats").agg(
        F.sum(F.col("tokens") * F.col("repeats")).alias("t"), F.count("*").alias("n"), F.min(F.when(F.col("repeats") < F.col("most"), F.col("tokens"))).alias("spare"))
    per = sums.join(asked, ["mix_name", "source"], "left").groupBy("mix_name", "source").agg(F.sum("t").alias("t"), F.min("spare").alias("spare"), F.sum(F.when(F.col("repeats") > F.coalesce("allowed", F.lit(0)), F.col("n")).otherwise(0)).alias("over"))
    both = asked.join(per, ["mix_name", "source"], "left").join(goal, ["mix_name", "source"], "left")
    gap = F.abs(F.coalesce("t", F.lit(0)) - F.coalesce("wanted", F.lit(0.0)))
    off = F.coalesce(F.col("spare").isNotNull() & (gap > F.greatest(F.lit(1.0), F.col("spare") / 2)), F.lit(False))
    return both.groupBy("mix_name").agg(F.sum(F.coalesce("over", F.lit(0))).cast("long").alias("over_limit"), F.count_if(off).alias("off_target"))


def reached_shares(used: DataFrame, targets: DataFrame) -> DataFrame:
    """``(mix_name, source, target_share, max_repeats, documents, tokens, share, most_repeats)`` of every target."""
    sums = used.groupBy("mix_name", "source").agg(F.count("*").alias("documents"), F.sum(F.col("tokens") * F.col("repeats")).alias("tokens"), F.max("repeats").alias("most_repeats"))
    totals = sums.groupBy("mix_name").agg(F.sum("tokens").alias("total"))
    wanted = targets.groupBy("mix_name", "source").agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    both = wanted.join(sums, ["mix_name", "source"], "left").join(totals, "mix_name", "left")
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("documents", "tokens", "most_repeats")}
    return both.withColumns(zero).select("mix_name", "source", "target_share", "max_repeats", "documents", "tokens", F.coalesce(F.col("tokens") / F.col("total"), F.lit(0.0)).alias("share"), "most_repeats")
