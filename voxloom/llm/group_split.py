"""Splits that keep related records together (problem 4).

Speakers' ids are brought to one writing and cut ids resolved; each speaker of a source, and each
record without a speaker, is a component. Components start from a hashed assignment and are moved and
exchanged whole by annealing, several chains side by side, to bring the splits' sizes and label
mixes to their shares; the best state met is kept.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

SPLITS = ("train", "validation", "test")
SHARES = (0.70, 0.15, 0.15)
CUT_LEAST = 12  # the fewest characters of a code that can be a cut one
BUCKET_COMPONENTS = 20_000  # components annealed in one task
LARGE_SHARE = 0.001  # a component with more of all records than this is placed first; there are at most 1000
CHAINS = 16

# Writings that stand for no speaker.
PLACEHOLDERS = ["", "unknown", "unk", "na", "none", "null", "nan", "anonymous", "anon", "anonyme", "inconnu", "inconnue", "speaker", "undefined", "missing", "tbd", "x", "xx", "xxx", "0"]

_WIDE = "".join(chr(c) for c in range(0xFF01, 0xFF5F))
_PLAIN = "".join(chr(c) for c in range(0x21, 0x7F))


def speaker_code(speaker_id: Column, source: Column) -> Column:
    """The code of a speaker id, whatever its capitals, blanks, invisible or wide characters,
    separators and source prefix; null for a null, blank or placeholder id."""
    plain = F.lower(F.translate(speaker_id, _WIDE, _PLAIN))
    plain = F.regexp_replace(plain, r"(?U)[\p{Cf}\s\x{FE00}-\x{FE0F}\x{3000}]", "")
    mine = F.lower(F.regexp_replace(F.coalesce(source, F.lit("")), r"(?U)\s", ""))
    after = F.substr(plain, F.length(mine) + 1)
    prefixed = F.startswith(plain, mine) & (mine != "") & ((after == "") | after.rlike(r"^[^\p{L}\p{N}]"))
    code = F.regexp_replace(F.when(prefixed, after).otherwise(plain), r"[^\p{L}\p{N}]", "")
    return F.when(~code.isin(PLACEHOLDERS), code)


def speakers(records: DataFrame) -> DataFrame:
    """``(source, code, speaker)`` for each code of ``(source, code)``: a code of at least 12 characters
    that another of its source starts with is a cut one and stands for that speaker (the longest
    continuation; of several, the least in order)."""
    codes = records.filter("code is not null").groupBy("source", "code").agg(F.count("*").alias("n"))
    group = Window.partitionBy("source", F.substring("code", 1, CUT_LEAST)).orderBy("code")
    following = F.lead("code").over(group)
    cut = (F.length("code") >= CUT_LEAST) & F.coalesce(F.startswith(following, F.col("code")), F.lit(False))
    whole = codes.withColumn("whole", F.when(~cut, F.col("code")))
    rest = group.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    return whole.select("source", "code", F.first("whole", ignorenulls=True).over(rest).alias("speaker"))


def records_with_speakers(audit: DataFrame, *more: str) -> DataFrame:
    """One row per record, its latest delivery: ``(record_no, source, split, code, speaker, ...)``; a null
    speaker for records without one. A null source is a source of its own."""
    keep = ["source", "split", "speaker_id", *more]
    latest = audit.groupBy("record_no").agg(F.max(F.struct("loaded_at", *keep)).alias("x")).select("record_no", *[f"x.{c}" for c in keep])
    latest = latest.withColumn("code", speaker_code(F.col("speaker_id"), F.col("source"))).withColumn("source", F.coalesce("source", F.lit("")))
    latest = materialize(latest, "speaker-records")
    return latest.join(speakers(latest), ["source", "code"], "left")


def records_with_components(audit: DataFrame) -> DataFrame:
    """As :func:`records_with_speakers`, with the ``component`` that has to stay together: a speaker of a source, or one record without a speaker."""
    speaker, record = F.concat_ws(":", F.lit("s"), "source", "speaker"), F.concat_ws(":", F.lit("r"), F.col("record_no").cast("string"))
    return records_with_speakers(audit).withColumn("component", F.when(F.col("speaker").isNotNull(), speaker).otherwise(record))


def crossing(rows: DataFrame) -> DataFrame:
    """Rows of validation and test whose component has rows in train."""
    trained = rows.filter("split = 'train'").select("component").distinct()
    return rows.filter("split in ('validation', 'test')").join(trained, "component", "left_semi")


def leaking_records(audit: DataFrame) -> DataFrame:
    """``record_no`` of validation and test records whose speaker also has a training record: the components that the present splits cut."""
    return crossing(records_with_components(audit).filter("speaker is not null")).select("record_no")


def anneal(sizes: np.ndarray, labels: np.ndarray, start: np.ndarray, targets: np.ndarray, seed: int, steps: int | None = None) -> np.ndarray:
    """Split numbers of components after annealing CHAINS chains at once from ``start``.

    sizes: records of each component; labels: its label's number; targets: wanted records by label and
    split. The energy is the squared deviation of the splits' sizes and, half weighted, of each
    label's, relative to all records. A chain moves a component or exchanges two, in 300 + 10 n steps for n
    components unless ``steps`` says otherwise, so that each is proposed ten times or more on average.
    """
    n, k = len(sizes), targets.shape[1]
    if not n:
        return start
    random, chain = np.random.default_rng(seed), np.arange(CHAINS)
    state = np.tile(start.astype(np.int8), (CHAINS, 1))
    held = np.zeros((CHAINS, *targets.shape))
    np.add.at(held, (chain[:, None], labels[None, :], state), sizes[None, :])
    total = max(float(targets.sum()), 1.0)
    off, part = (held - targets) / total, sizes / total
    sums = off.sum(1)
    now = (sums**2).sum(-1) + 0.5 * (off**2).sum((-1, -2))
    best, best_energy = state.copy(), now.copy()
    steps = steps or 300 + 10 * n
    heat = now.max() * 0.1 + 1e-12
    for step in range(steps):
        temperature = heat * (1 - step / steps) ** 3 + 1e-300
        i, j = random.integers(0, n, CHAINS), random.integers(0, n, CHAINS)
        swap = random.random(CHAINS) < 0.5
        a = state[chain, i]
        b = np.where(swap, state[chain, j], (a + random.integers(1, k, CHAINS)) % k)
        x, y, p, q = part[i], np.where(swap, part[j], 0.0), labels[i], labels[j]
        m = x - y
        # what the squares change by, if x goes from a to b and y from b to a
        change = 2 * m * (sums[chain, b] - sums[chain, a] + m)
        change += x * (off[chain, p, b] - off[chain, p, a] + x) + y * (off[chain, q, a] - off[chain, q, b] + y) - np.where(p == q, 2 * x * y, 0.0)
        take = np.flatnonzero((a != b) & ((change <= 0) | (random.random(CHAINS) < np.exp(np.minimum(0, -change / temperature)))))
        if not len(take):
            continue
        a, b, p, q, x, y, m = a[take], b[take], p[take], q[take], x[take], y[take], m[take]
        sums[take, a] -= m
        sums[take, b] += m
        off[take, p, a] -= x
        off[take, p, b] += x
        off[take, q, b] -= y
        off[take, q, a] += y
        now[take] += change[take]
        state[take, i[take]] = b
        both = swap[take]
        state[take[both], j[take[both]]] = a[both]
        better = take[now[take] < best_energy[take] - 1e-18]
        best[better], best_energy[better] = state[better], now[better]
    return best[int(best_energy.argmin())]


def _hashed(h: np.ndarray, shares: np.ndarray) -> np.ndarray:
    u = (h.astype(np.uint64) >> np.uint64(11)).astype(float) * 2.0**-53
    return np.minimum(np.searchsorted(np.cumsum(shares), u, "right"), len(shares) - 1)


def _annealer(targets: np.ndarray, label_names: list[str], buckets: int):
    """Assign the components of one bucket; each bucket aims at its share of the targets, given
    by the records it holds of each label."""
    number = {x: i for i, x in enumerate(label_names)}

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["h", "component"])
        sizes, labels = group["records"].to_numpy(float), group["label"].map(number).to_numpy()
        held = np.bincount(labels, sizes, len(label_names))
        wanted = np.maximum(targets, 0)
        sums = wanted.sum(1, keepdims=True)
        shares = np.divide(wanted, sums, out=np.full_like(wanted, 1 / wanted.shape[1]), where=sums > 0)
        overall = wanted.sum(0) / max(wanted.sum(), 1e-9)
        start = _hashed(group["h"].to_numpy(np.int64), overall)
        group["new_split"] = anneal(sizes, labels, start, held[:, None] * shares, int(group["bucket"].iloc[0]) + 1)
        return group[["component", "new_split"]]

    return run


def grouped_split(audit: DataFrame, shares: tuple[float, ...] = SHARES, names: tuple[str, ...] = SPLITS) -> DataFrame:
    """``(record_no, source, component, old_split, split)``: records assigned anew, components whole.

    A component is a speaker of a source, or one record without a speaker. The label held even is the
    source. Components of more than 0.1 % of all records, at most 1000, are annealed first
    in one task; the targets left are shared out to buckets of about BUCKET_COMPONENTS components
    annealed apart. A component larger than a split's share makes that split too large by it: groups
    stay whole. The result depends on the data only.
    """
    rows = records_with_components(audit)
    counted = rows.groupBy("component").agg(F.count("*").alias("records"), F.first("source").alias("label")).withColumn("h", F.xxhash64("component"))
    parts = materialize(counted, "components")
    by_label = {r["label"]: (r["records"], r["components"]) for r in parts.groupBy("label").agg(F.sum("records").alias("records"), F.count("*").alias("components")).collect()}
    labels = sorted(by_label)
    total = sum(r for r, _ in by_label.values())
    targets = np.array([[by_label[x][0] * s for s in shares] for x in labels]).reshape(len(labels), len(shares))
    kinds = "component string, new_split int"
    large = parts.filter(F.col("records") > LARGE_SHARE * total).withColumn("bucket", F.lit(0))
    placed = materialize(large.groupBy("bucket").applyInPandas(_annealer(targets, labels, 1), kinds), "large-components")
    taken = parts.join(placed, "component").groupBy("label", "new_split").agg(F.sum("records").alias("n")).collect()  # a number per label and split
    for r in taken:
        targets[labels.index(r["label"]), r["new_split"]] -= r["n"]
    buckets = max(1, -(-sum(c for _, c in by_label.values()) // BUCKET_COMPONENTS))
    small = parts.filter(F.col("records") <= LARGE_SHARE * total).withColumn("bucket", F.pmod(F.xxhash64(F.lit(7), "component"), F.lit(buckets)).cast("int"))
    rest = small.groupBy("bucket").applyInPandas(_annealer(targets, labels, buckets), kinds)
    name = F.element_at(F.array(*map(F.lit, names)), F.col("new_split") + 1)
    return rows.withColumnRenamed("split", "old_split").join(placed.union(rest), "component").select("record_no", "source", "component", "old_split", name.alias("split"))


def violations(assigned: DataFrame) -> DataFrame:
    """``(source, records, cut)`` of an assignment: its records, and those in validation or test whose component is in train, too."""
    found = crossing(assigned).select("record_no").withColumn("cut", F.lit(1))
    return assigned.join(found, "record_no", "left").groupBy("source").agg(F.count("*").alias("records"), F.coalesce(F.sum("cut"), F.lit(0)).cast("long").alias("cut"))


def split_shares(assigned: DataFrame) -> DataFrame:
    """Records and their share per split and source of an assignment."""
    counts = assigned.groupBy("source", "split").agg(F.count("*").alias("records"))
    return counts.withColumn("share", F.col("records") / F.sum("records").over(Window.partitionBy("source")))
