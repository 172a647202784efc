"""Same or near-same records across splits (problem 2).

Evaluation records go into compressed full-text indexes of bounded size (shards), written to the shared folder: one over
their words as they stand in the text, and one over their different words in a common order. Training records
stream once through backward search against every shard. What counts is how many words two records share,
in whatever order, so the pairs are found in the common order, where nothing can be lost (below), and checked exactly. Of the
pairs' texts backward search finds all runs of words that they share, which are merged to maximal matches, and these, over small
gaps, to spans: where in both records the overlap stands.

Why no link is lost: let A and B share s of u = |A| + |B| - s words, s >= t u. In the common order
the u - s words of only one of them cut the shared ones into at most u - s + 1 runs, so at least
s - (u - s) - 1 neighbouring words of A are neighbours in B as well. Of A's |A| - 1 neighbour pairs
at most (1 - t) |A| max(2, 1/t) are broken, so all but one of the unbroken ones may be left
unlocated: the most frequent are. Where that leaves none (few words, low t), single words are
located, and of these the ceil(t |A|) - 1 most frequent left out. In the order of the text there is no such bound: two records
of the same words in another order need not share a single pair of neighbours.
"""

from __future__ import annotations

from collections import OrderedDict
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, materialized_path
from .fm_index import FMIndex, spans
from .word_sets import classes_and_members, set_rows

SHARD_WORDS = 1_500_000  # words of evaluation records per shard, as expected; a shard is stored in some 10 MB and unpacked to some 50
SHARDS_HELD = 3  # unpacked shards a worker keeps
HELD_WORDS = 5_000_000  # words of training records a task holds while it goes through the shards
GAP = 3  # words between matches of one span
LOCATED_AT_ONCE = 2_000_000
WORDS_AT_ONCE = 1_000_000
_held: OrderedDict = OrderedDict()
_PAIRS = "a long, b long, shared int, size_a int, size_b int, matches int, longest int, spans array<struct<start_a: int, end_a: int, start_b: int, end_b: int, words: int>>"


def _flat(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = column.offsets.to_numpy()
    return column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]], np.diff(offsets)


def sliced(batches, column: str = "seq", most: int = WORDS_AT_ONCE):
    """The batches cut so that each piece holds at most ``most`` words, but for longer single rows."""
    for batch in batches:
        ends = np.cumsum(np.diff(batch.column(column).offsets.to_numpy()))
        begin = 0
        while begin < batch.num_rows:
            room = (ends[begin - 1] if begin else 0) + most
            end = max(int(np.searchsorted(ends, room, "right")), begin + 1)
            yield batch.slice(begin, end - begin)
            begin = end


def _build(key, table):
    ids = table["cid"].to_numpy()
    blobs = [pa.array([FMIndex(ids, *_flat(table[c])).dump()], pa.binary()) for c in ("words", "seq")]
    return pa.table([pa.array([key[0].as_py()], pa.int32()), *blobs], ["part", "texts", "sets"])


def build_index(evaluation: DataFrame, shard_words: int = SHARD_WORDS) -> tuple[str, int]:
    """Write the shards over ``(cid, words, seq)``; returns their folder and number."""
    shards = max(1, -(-(evaluation.agg(F.sum(F.size("words"))).first()[0] or 0) // shard_words))
    parts = evaluation.select("cid", "words", "seq", F.pmod(F.xxhash64("cid"), F.lit(shards)).cast("int").alias("part"))
    built = parts.groupBy("part").applyInArrow(_build, "part int, texts binary, sets binary")
    return materialized_path(built, "fm-index"), shards


def _shard(folder: str, part: int) -> tuple[FMIndex, FMIndex] | None:
    """The texts and sets of a shard from the shared folder; the last few stay with the worker for its next task."""
    import pyarrow.dataset as ds
    import pyarrow.fs as fs

    if (folder, part) in _held:
        return _held[folder, part]
    where, path = fs.FileSystem.from_uri(folder)
    found = ds.dataset(path, filesystem=where, format="parquet").to_table(columns=["texts", "sets"], filter=ds.field("part") == part)
    while len(_held) >= SHARDS_HELD:
        _held.popitem(last=False)
    _held[folder, part] = tuple(FMIndex.load(found[c][0].as_py()).unpack() for c in ("texts", "sets")) if found.num_rows else None
    return _held[folder, part]


def _candidates(index: FMIndex, flat: np.ndarray, lengths: np.ndarray, t: Fraction):
    """Pairs of record number and document that share enough neighbours or words of the common order: ``(record, doc)``."""
    symbols = index.symbol_of(flat)
    starts = np.concatenate(([0], np.cumsum(lengths)))
    record = np.repeat(np.arange(len(lengths)), lengths)
    first = np.zeros(len(flat) + 1, bool)
    first[starts[:-1]] = True
    p, q = t.numerator, t.denominator
    broken = (q - p) * lengths * max(2 * p, q) // (p * q)
    unbroken = lengths - 1 - broken
    pairs_do = unbroken >= 1
    for depth in (2, 1):
        chosen = pairs_do if depth == 2 else ~pairs_do
        if not chosen.any():
            continue
        low, high, _ = index.matches(symbols, first, depth, depth)
        count = np.where(chosen[record], high - low, 0)
        spare = unbroken - 1 if depth == 2 else -(-lengths * p // q) - 1
        # each record's most frequent matches come first here; as many as may be spared are left unlocated
        order = np.lexsort((-count, record))
        place = np.arange(len(order)) - starts[record[order]]
        keep = order[(place >= spare[record[order]]) & (count[order] > 0)]
        keep.sort()
        room = np.cumsum(count[keep])
        cut = np.searchsorted(room, np.arange(LOCATED_AT_ONCE, room[-1] + LOCATED_AT_ONCE, LOCATED_AT_ONCE)) if len(keep) else []
        # pieces end between records, so that a pair's matches stay together
        ends = sorted({int(np.searchsorted(record[keep], record[keep[min(c, len(keep) - 1)]], "right")) for c in cut} | {len(keep)})
        begin = 0
        for end in ends:
            part, begin = keep[begin:end], end
            rows = spans(low[part], count[part])
            r = np.repeat(record[part], count[part])
            at = np.repeat(part, count[part])
            doc = index.doc[rows]
            size = index.lengths[doc]
            fits = (size * p <= lengths[r] * q) & (lengths[r] * p <= size * q)
            key = np.sort(r[fits] * np.int64(len(index.ids)) + doc[fits])
            where = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.empty(0, np.int64)
            hits = np.diff(np.append(where, len(key)))
            r, doc = key[where] // len(index.ids), key[where] % len(index.ids)
            both = lengths[r] + index.lengths[doc]
            least_shared = -(-both * p // (p + q))
            need = 3 * least_shared - both - 1 - spare[r] if depth == 2 else least_shared - spare[r]
            good = hits >= np.maximum(need, 1)
            yield r[good], doc[good]


def _similar(index: FMIndex, flat: np.ndarray, lengths: np.ndarray, t: Fraction):
    """All pairs of record number and document of at least the similarity t: ``(record, doc, shared)``."""
    symbols = index.symbol_of(flat)
    width = np.int64(len(index.vocabulary) + 1)
    own = np.repeat(np.arange(len(lengths)), lengths) * width + symbols
    own = own[symbols > 0]  # ascending: records follow each other, and their symbols ascend
    out = [np.empty((3, 0), np.int64)]
    for r, doc in _candidates(index, flat, lengths, t):
        n = index.lengths[doc].astype(np.int64)
        theirs = np.repeat(r, n) * width + index.symbols[spans(index.offsets[doc], n)]
        at = np.minimum(np.searchsorted(own, theirs), max(len(own) - 1, 0))
        hit = np.concatenate(([0], np.cumsum(own[at] == theirs))) if len(own) else np.zeros(len(theirs) + 1, int)
        ends = np.cumsum(n)
        shared = hit[ends] - hit[ends - n]
        good = shared * t.denominator >= t.numerator * (lengths[r] + n - shared)
        out.append(np.stack((r[good], doc[good], shared[good])))
    return np.concatenate(out, 1)


def maximal_matches(index: FMIndex, flat: np.ndarray, lengths: np.ndarray, r: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """``(pair, start in the record, start in the document, words)`` of every run of two or more words, as long as it can be, that the texts of
    each pair of record and document share, by pair and place. Pairs must be different and ascend.

    Backward search finds the rows of every two neighbouring words; located and kept if they are in one of the pairs, those that
    follow each other on a diagonal make up a match."""
    used, record = np.unique(r, return_inverse=True)
    starts = np.concatenate(([0], np.cumsum(lengths)))[:-1]
    n = lengths[used]
    symbols = index.symbol_of(flat[spans(starts[used], n)])
    owner, begin = np.repeat(np.arange(len(used)), n), np.concatenate(([0], np.cumsum(n)))
    first = np.zeros(len(symbols) + 1, bool)
    first[begin[:-1]] = True
    low, high, _ = index.matches(symbols, first, 2, 2)
    count = high - low
    want = record * np.int64(len(index.ids)) + doc
    found = [np.empty((3, 0), np.int64)]
    places, room = np.flatnonzero(count), np.cumsum(count[count > 0])
    cuts = np.unique(np.append(np.searchsorted(room, np.arange(0, room[-1], LOCATED_AT_ONCE), "right"), len(places))) if len(places) else []
    for a, b in zip(cuts, cuts[1:], strict=False):
        part = places[a:b]
        rows, at = spans(low[part], count[part]), np.repeat(part, count[part])
        key = owner[at] * np.int64(len(index.ids)) + index.doc[rows]
        pair = np.minimum(np.searchsorted(want, key), len(want) - 1)
        hit = want[pair] == key
        found.append(np.stack((pair[hit], at[hit] - 1 - begin[owner[at[hit]]], index.at[rows[hit]])))
    pair, a, b = np.concatenate(found, 1)
    order = np.lexsort((a, b - a, pair))
    pair, a, b = pair[order], a[order], b[order]
    new = np.ones(len(pair), bool)
    new[1:] = (pair[1:] != pair[:-1]) | (a[1:] != a[:-1] + 1) | (b[1:] != b[:-1] + 1)
    head = np.flatnonzero(new)
    out = np.stack((pair[head], a[head], b[head], np.diff(np.append(head, len(pair))) + 1))
    return out[:, np.lexsort((out[2], out[1], out[0]))]


def merged_spans(matches: np.ndarray, gap: int = GAP) -> np.ndarray:
    """``(pair, start_a, end_a, start_b, end_b, words)``: matches that follow each other in both texts within ``gap`` words joined to
    one span; words counts those that match."""
    pair, a, b, n = matches
    joins = np.zeros(len(pair), bool)
    joins[1:] = (pair[1:] == pair[:-1]) & (a[1:] >= (a + n)[:-1]) & (a[1:] <= (a + n)[:-1] + gap) & (b[1:] >= (b + n)[:-1]) & (b[1:] <= (b + n)[:-1] + gap)
    head = np.flatnonzero(~joins)
    last = np.append(head[1:], len(pair)) - 1 if len(head) else head
    words = np.add.reduceat(n, head) if len(head) else n
    return np.stack((pair[head], a[head], (a + n)[last], b[head], (b + n)[last], words))


def _search(folder: str, shards: int, t: Fraction):
    def found(ids, words, seq):
        for part in range(shards):
            if (held := _shard(folder, part)) is None:
                continue
            texts, sets = held
            for begin, end in _pieces(seq[1], WORDS_AT_ONCE):
                flat, lengths = _part(seq, begin, end)
                r, doc, shared = _similar(sets, flat, lengths, t)
                if not len(r):
                    continue
                order = np.lexsort((doc, r))
                r, doc, shared = r[order], doc[order], shared[order]
                matches = maximal_matches(texts, *_part(words, begin, end), r, doc)
                number, longest = np.bincount(matches[0], minlength=len(r)), np.zeros(len(r), np.int64)
                np.maximum.at(longest, matches[0], matches[3])
                joined = merged_spans(matches)
                offsets = np.concatenate(([0], np.cumsum(np.bincount(joined[0], minlength=len(r))))).astype(np.int32)
                fields = pa.StructArray.from_arrays([pa.array(x.astype(np.int32)) for x in joined[1:]], ["start_a", "end_a", "start_b", "end_b", "words"])
                columns = [ids[begin:end][r], sets.ids[doc], *(x.astype(np.int32) for x in (shared, lengths[r], sets.lengths[doc], number, longest))]
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.ListArray.from_arrays(pa.array(offsets), fields)], ["a", "b", "shared", "size_a", "size_b", "matches", "longest", "spans"])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            held.append((batch.column("cid").to_numpy(), _flat(batch.column("words")), _flat(batch.column("seq"))))
            size += len(held[-1][1][0])
            if size >= HELD_WORDS:
                yield from found(*_together(held))
                held, size = [], 0
        if held:
            yield from found(*_together(held))

    return run


def _together(held):
    columns = [tuple(np.concatenate([h[k][i] for h in held]) for i in (0, 1)) for k in (1, 2)]
    return np.concatenate([h[0] for h in held]), *columns


def _part(rows, begin: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    flat, lengths = rows
    a = int(lengths[:begin].sum())
    return flat[a : a + int(lengths[begin:end].sum())], lengths[begin:end].astype(np.int64)


def _pieces(lengths: np.ndarray, most: int):
    """Ranges of rows of at most ``most`` words together, but for longer single rows."""
    ends, begin = np.cumsum(lengths, dtype=np.int64), 0
    while begin < len(ends):
        end = max(int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + most, "right")), begin + 1)
        yield begin, end
        begin = end


def class_pairs(classes: DataFrame, t: Fraction = Fraction(3, 5), shard_words: int = SHARD_WORDS) -> DataFrame:
    """Pairs of a training class a and an evaluation class b with Jaccard similarity of at least t, with the spans (in words from 0, ends
    excluded) that the classes' texts share. Training is read once, however many shards there are."""
    folder, shards = build_index(classes.filter("evaluation"), shard_words)
    return classes.filter("train").select("cid", "words", "seq").mapInArrow(_search(folder, shards, t), _PAIRS)


def cross_split_pairs(audit: DataFrame, t: Fraction = Fraction(3, 5), least_words: int = 10) -> DataFrame:
    """``(train_record, evaluation_record, split, source, shared, size_a, size_b, matches, longest, spans)``.

    All pairs of a full training record and a full validation or test record whose word sets reach
    the similarity t; copies are found once, as a class, and expanded at the end. split and source
    are the evaluation record's; spans are those of a text of each record's words. Null, empty and short texts, and rows of other splits, have
    no partners; redelivered rows count once.
    """
    classes, members = classes_and_members(set_rows(audit, least_words, texts=True))
    left = members.filter("split = 'train'").select(F.col("cid").alias("a"), F.col("record_no").alias("train_record"))
    right = members.filter("split in ('validation', 'test')").select(F.col("cid").alias("b"), F.col("record_no").alias("evaluation_record"), "split", "source")
    return class_pairs(classes, t).join(left, "a").join(right, "b").drop("a", "b")


def overlap_counts(audit: DataFrame, t: Fraction = Fraction(3, 5), least_words: int = 10) -> DataFrame:
    """Per evaluation split and source: records met in training, the training records they meet, pairs, and pairs of
    equal word sets. Counted from links between classes and the classes' sizes: however many copies a
    text has, its pairs are multiplied, not made."""
    classes, members = classes_and_members(set_rows(audit, least_words, texts=True))
    left = members.filter("split = 'train'").groupBy(F.col("cid").alias("a")).agg(F.count("*").alias("n"))
    right = members.filter("split in ('validation', 'test')").groupBy(F.col("cid").alias("b"), "split", "source").agg(F.count("*").alias("m"))
    same = (F.col("shared") == F.col("size_a")) & (F.col("shared") == F.col("size_b"))
    links = materialize(class_pairs(classes, t).join(left, "a").join(right, "b").select("a", "b", "split", "source", "n", "m", same.alias("same")), "class-overlaps")
    none, pairs = F.lit(0).cast("long"), F.col("n") * F.col("m")
    parts = [
        links.select("split", "source", none.alias("records"), none.alias("train_records"), pairs.alias("pairs"), F.when(F.col("same"), pairs).otherwise(0).alias("same_words")),
        links.select("split", "source", "b", "m").distinct().select("split", "source", F.col("m").alias("records"), none.alias("train_records"), none.alias("pairs"), none.alias("same_words")),
        links.select("split", "source", "a", "n").distinct().select("split", "source", none.alias("records"), F.col("n").alias("train_records"), none.alias("pairs"), none.alias("same_words")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("split", "source").agg(*[F.sum(c).alias(c) for c in ("records", "train_records", "pairs", "same_words")])
