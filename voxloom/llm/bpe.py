"""Encoding the corpus with a public byte-level BPE tokenizer (problem 7).

A text is cut by the tokenizer's pattern; each distinct piece is a doubly linked list of symbols, and
a priority queue of the merges possible between neighbours gives the lowest rank first. Entries
made stale by an earlier merge are skipped. Decoding concatenates the vocabulary's byte strings.
"""

from __future__ import annotations

import base64
from functools import lru_cache
from heapq import heapify, heappop, heappush
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PIECES_HELD = 200_000  # encoded pieces a worker remembers; it forgets all when full

# Fixed value: the published pattern of this tokenizer's pieces.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class ByteBPE:
    def __init__(self, file: bytes):
        lines = (line.split() for line in file.splitlines() if line)
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.pieces = regex.compile(PATTERN).findall
        self.known: dict[str, list[int]] = {}

    def merged(self, data: bytes) -> list[int]:
        """Ids of one piece. Time grows as n log n with its length."""
        ranks = self.ranks
        whole = ranks.get(data)
        if whole is not None:
            return [whole]
        n = len(data)
        parts: list[bytes | None] = [data[i : i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = []
        for i in range(n - 1):
            rank = ranks.get(data[i : i + 2])
            if rank is not None:
                queue.append((rank, i, 2))
        heapify(queue)
        while queue:
            _, i, size = heappop(queue)
            left = parts[i]
            if left is None:
                continue
            j = after[i]
            if j == n or len(left) + len(parts[j]) != size:  # one of the two has merged since
                continue
            pair = left + parts[j]
            parts[i], parts[j] = pair, None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                rank = ranks.get(pair + parts[k])
                if rank is not None:
                    heappush(queue, (rank, i, size + len(parts[k])))
            h = before[i]
            if h >= 0:
                rank = ranks.get(parts[h] + pair)
                if rank is not None:
                    heappush(queue, (rank, h, size + len(parts[h])))
        return [ranks[p] for p in parts if p is not None]

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text; none for null and empty texts."""
        if not text:
            return []
        known, out = self.known, []
        for piece in self.pieces(text):
            ids = known.get(piece)
            if ids is None:
                ids = self.merged(piece.encode("utf-8", "surrogatepass"))
                if len(known) >= PIECES_HELD:
                    known.clear()
                if len(piece) <= 64:
                    known[piece] = ids
            out += ids
        return out

    def decode(self, ids: list[int]) -> str:
        return b"".join(self.tokens[i] for i in ids).decode("utf-8", "replace")


@lru_cache(2)
def _loaded(file: bytes) -> ByteBPE:
    return ByteBPE(file)


def load(path: str = VOCABULARY) -> ByteBPE:
    return _loaded(Path(path).read_bytes())


def _column(batch: pa.RecordBatch, name: str) -> list[str | None]:
    return batch.column(name).to_pylist()


def encoded(documents: DataFrame, key: str = "doc_id", text: str = "text", path: str = VOCABULARY) -> DataFrame:
    """``(key, ids)`` of every document, without special tokens; a null or empty text gives an empty list.

    Text is never cut or skipped, whatever its length; strings of special tokens in a text are
    ordinary text. The vocabulary file (under 1 MB, fixed) is read on the driver and broadcast, so
    executors need no copy. No shuffle.
    """
    spark = documents.sparkSession
    file = spark.sparkContext.broadcast(Path(path).read_bytes())

    def run(batches):
        encode = _loaded(file.value).encode
        for batch in batches:
            lists = [encode(t) for t in _column(batch, text)]
            offsets = np.concatenate(([0], np.cumsum([len(x) for x in lists], dtype=np.int64))).astype(np.int32)
            flat = pa.array(np.fromiter((i for x in lists for i in x), np.int32, int(offsets[-1])))
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.ListArray.from_arrays(pa.array(offsets), flat)], [key, "ids"])

    kind = dict(documents.dtypes)[key]
    return documents.select(key, text).mapInArrow(run, f"`{key}` {kind}, ids array<int>")


def decoded(ids: DataFrame, key: str = "doc_id", path: str = VOCABULARY) -> DataFrame:
    """``(key, text)``: the vocabulary's strings joined; the inverse of :func:`encoded` but for nulls."""
    spark = ids.sparkSession
    file = spark.sparkContext.broadcast(Path(path).read_bytes())

    def run(batches):
        decode = _loaded(file.value).decode
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(map(decode, _column(batch, "ids")), pa.string())], [key, "text"])

    kind = dict(ids.dtypes)[key]
    return ids.select(key, "ids").mapInArrow(run, f"`{key}` {kind}, text string")
