"""Near-duplicate records with small edits (problem 5), by SetSketch registers.

A register is the minimum over a set's words of an exponentially distributed hash, on a scale spaced
exponentially with base B and cut off at its ends; sketches merge by the register-wise maximum and
two sets agree in a register with a probability close to their Jaccard similarity. Bands of ROWS
registers find candidates; 64 further registers, a bit of each, thin them before they travel;
what is left is estimated jointly by likelihood, then verified on the word sets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, partitions
from .cross_split import _flat, sliced
from .word_sets import classes_and_members, set_rows

BANDS, ROWS = 36, 4  # at similarity 0.6 a pair shares a band with probability 0.993, at 0.7 with 0.99996
BIT_REGISTERS = 64
BASE, SCALE, TOP = 1.001, 20.0, 65535
SLACK = 4.0  # standard deviations below the threshold up to which an estimate or a bit count passes
_AT_ONCE = 100_000


def _mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_registers(keys: np.ndarray, first: int, count: int) -> np.ndarray:
    """Registers ``first`` up to ``first + count`` of each single word."""
    seeds = np.arange(first + 1, first + count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    u = (_mixed(keys.view(np.uint64)[:, None] + seeds[None, :]) >> np.uint64(11)).astype(np.float64)
    value = -np.log((u + 0.5) * 2.0**-53) / SCALE
    return np.clip(np.floor(1 - np.log(value) / np.log(BASE)), 0, TOP).astype(np.uint16)


def sketches(flat: np.ndarray, lengths: np.ndarray, first: int, count: int) -> np.ndarray:
    """Registers of each set: those of its words merged. Memory is bounded whatever the sets' sizes."""
    out = np.zeros((len(lengths), count), np.uint16)
    words, inverse = np.unique(flat, return_inverse=True)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    for w in range(0, len(words), _AT_ONCE):
        table = word_registers(words[w : w + _AT_ONCE], first, count)
        for at in range(0, len(flat), _AT_ONCE):
            part, who = inverse[at : at + _AT_ONCE] - w, owner[at : at + _AT_ONCE]
            if len(words) > _AT_ONCE:
                here = (part >= 0) & (part < len(table))
                part, who = part[here], who[here]
            if len(part):
                head = np.flatnonzero(np.concatenate(([True], who[1:] != who[:-1])))
                who = who[head]
                out[who] = np.maximum(out[who], np.maximum.reduceat(table[part], head, axis=0))
    return out


def _bits(flat: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    last = sketches(flat, lengths, BANDS * ROWS, BIT_REGISTERS) & np.uint16(1)
    return np.packbits(last.astype(np.uint8), axis=1, bitorder="little").view(np.int64)[:, 0]


def _bands(batches):
    for batch in sliced(batches):
        flat, lengths = _flat(batch.column("seq"))
        registers = sketches(flat, lengths, 0, BANDS * ROWS).reshape(len(lengths), BANDS, ROWS).astype(np.uint64)
        packed = sum(registers[:, :, k] << np.uint64(16 * k) for k in range(ROWS))
        seeds = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        keys = (_mixed(packed + seeds) >> np.uint64(8)).astype(np.int64)  # 56 bits
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(lengths) + 1) * BANDS, pa.int32()), pa.array(keys.ravel()))
        columns = [batch.column("cid"), batch.column("n"), pa.array(_bits(flat, lengths)), lists]
        yield pa.RecordBatch.from_arrays(columns, ["cid", "n", "bits", "bands"])


def similarity_estimate(x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity from two sketches and the sets' sizes: how many registers
    are greater, less and equal, each with its probability given the similarity."""
    greater, less = (x > y).sum(1), (x < y).sum(1)
    equal = x.shape[1] - greater - less
    u, v = n / (n + m), m / (n + m)
    top = np.minimum(n, m) / np.maximum(n, m)
    p = lambda z: -np.log1p(-np.clip(z, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    def likelihood(j):
        a, b = p(u - v * j), p(v - u * j)
        e = 1e-12
        return greater * np.log(a + e) + less * np.log(b + e) + equal * np.log(np.maximum(1 - a - b, 0) + e)

    low, high, ratio = np.zeros(len(n)), top.copy(), (5**0.5 - 1) / 2
    for _ in range(40):  # golden section: the likelihood has one peak
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        left = likelihood(a) > likelihood(b)
        low, high = np.where(left, low, a), np.where(left, b, high)
    return (low + high) / 2


def _estimated(least: float):
    def run(batches):
        for batch in sliced(batches, "seq_a"):
            (fa, na), (fb, nb) = _flat(batch.column("seq_a")), _flat(batch.column("seq_b"))
            if not len(na):
                continue
            x, y = sketches(fa, na, 0, BANDS * ROWS), sketches(fb, nb, 0, BANDS * ROWS)
            j = similarity_estimate(x, y, na.astype(float), nb.astype(float))
            kept = batch.filter(pa.array(j >= least))
            yield kept.append_column("estimate", pa.array(j[j >= least]))

    return run


def class_links(classes: DataFrame, similarity: float = 0.6) -> DataFrame:
    """``(a, b, shared, n_a, n_b, estimate)``: pairs of classes with at least this Jaccard similarity, a < b.

    A band's rows meet in a join on its key, which adaptive execution splits where a key is
    hot; sets of equal words are one class, so a bucket grows with different sets only. Most that meet in a band of four registers are
    similar, and what isn't is dropped inside the join by size and bits, before it travels.
    """
    spark = classes.sparkSession
    banded = classes.select("cid", "n", "seq").mapInArrow(_bands, "cid long, n int, bits long, bands array<long>")
    rows = banded.select("cid", "n", "bits", F.explode("bands").alias("band"))
    a = rows.select("band", F.col("cid").alias("a"), F.col("n").alias("n_a"), F.col("bits").alias("bits_a"))
    b = rows.select("band", F.col("cid").alias("b"), F.col("n").alias("n_b"), F.col("bits").alias("bits_b"))
    agree = (1 + similarity) / 2
    least_bits = int(BIT_REGISTERS * agree - SLACK * (BIT_REGISTERS * agree * (1 - agree)) ** 0.5)
    close = (F.bit_count(F.col("bits_a").bitwiseXOR(F.col("bits_b"))) <= BIT_REGISTERS - least_bits) & (F.least("n_a", "n_b") >= similarity * F.greatest("n_a", "n_b"))
    candidates = a.join(b, "band").filter((F.col("a") < F.col("b")) & close).select("a", "b")
    once = candidates.repartition(partitions(spark), "a").dropDuplicates(["a", "b"])
    sets = classes.select("cid", "seq")
    both = once.join(sets.withColumnsRenamed({"cid": "a", "seq": "seq_a"}), "a").join(sets.withColumnsRenamed({"cid": "b", "seq": "seq_b"}), "b")
    least = similarity - SLACK * (similarity * (1 - similarity) / (BANDS * ROWS)) ** 0.5
    kept = both.select("a", "b", "seq_a", "seq_b").mapInArrow(_estimated(least), "a long, b long, seq_a array<long>, seq_b array<long>, estimate double")
    shared = F.size(F.array_intersect("seq_a", "seq_b"))
    sized = kept.select("a", "b", shared.alias("shared"), F.size("seq_a").alias("n_a"), F.size("seq_b").alias("n_b"), "estimate")
    return sized.filter(F.col("shared") >= F.lit(similarity) * (F.col("n_a") + F.col("n_b") - F.col("shared")) - 1e-9)


def near_pairs(audit: DataFrame, similarity: float = 0.6, least_words: int = 10) -> DataFrame:
    """``(record_a, record_b)``: full records at least this similar whose texts differ in the one form.

    Every such pair comes out, copies of a text expanded at the end only. Pairs equal in the one form
    are left out; null, empty and short texts have no partners; redelivered rows count once. Empty
    input gives an empty result. A link at similarity j is missed with probability
    ``(1 - j^4)^36``: 0.7 % at 0.6, under 0.01 % from 0.7.
    """
    classes, members = classes_and_members(set_rows(audit, least_words))
    links = class_links(classes, similarity).select("a", "b")
    reordered = members.groupBy("cid").agg(F.min(F.struct("f1", "f2")).alias("lo"), F.max(F.struct("f1", "f2")).alias("hi")).filter("lo <> hi")
    links = links.union(reordered.select(F.col("cid").alias("a"), F.col("cid").alias("b")))
    left = members.select(F.col("cid").alias("a"), F.col("record_no").alias("x"), F.struct("f1", "f2").alias("fx"))
    right = members.select(F.col("cid").alias("b"), F.col("record_no").alias("y"), F.struct("f1", "f2").alias("fy"))
    # within one class a pair would come out twice; between two classes the texts always differ
    pairs = links.join(left, "a").join(right, "b").filter("(a <> b or x < y) and fx <> fy")
    return pairs.select(F.least("x", "y").alias("record_a"), F.greatest("x", "y").alias("record_b"))


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` of every node of the links ``(a, b)``: the least node of its component.

    Alternating large-star and small-star steps: a logarithmic number of rounds, each
    written to the shared folder; nothing but the number of changed links reaches the driver.
    """
    edges = materialize(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(down.select("u", F.col("m").alias("v")))
        new = materialize(small.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
        changed = new.exceptAll(edges).limit(1).count() + edges.exceptAll(new).limit(1).count()
        edges = new
        if not changed:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def near_groups(audit: DataFrame, similarity: float = 0.6, least_words: int = 10) -> DataFrame:
    """``(record_no, split, group_id, group_records, links)``: one row per full record.

    Records belong together over any chain of links; a record alone is its own group, with no links.
    links counts the other records it is similar to, exact copies among them. group_id is the least
    record_no of the group.
    """
    classes, members = classes_and_members(set_rows(audit, least_words))
    links = materialize(class_links(classes, similarity).select("a", "b"), "class-links")
    sizes = members.groupBy("cid").agg(F.count("*").alias("copies"), F.min("record_no").alias("least"))
    both = links.union(links.select("b", "a"))
    degree = both.join(sizes, both["b"] == sizes["cid"]).groupBy("a").agg(F.sum("copies").alias("near")).withColumnRenamed("a", "cid")
    rooted = sizes.join(components(links).withColumnRenamed("node", "cid"), "cid", "left").join(degree, "cid", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "cid"))
    groups = rooted.groupBy("root").agg(F.min("least").alias("group_id"), F.sum("copies").alias("group_records"))
    out = rooted.join(groups, "root").select("cid", "group_id", "group_records", (F.coalesce("near", F.lit(0)) + F.col("copies") - 1).alias("links"))
    return members.select("record_no", "split", "cid").join(out, "cid").drop("cid")
