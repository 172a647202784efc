"""A compressed full-text index over sequences of symbols (FM-index), vectorised with numpy.

The Burrows-Wheeler transform is held in a wavelet matrix: one bit per symbol and level, with
counts per 64 bits, so a backward step costs one rank per level for a whole batch of patterns. Besides it the index holds the
vocabulary, the documents' lengths and the rows of every SAMPLED-th place (a sampled suffix array); from these
:meth:`FMIndex.unpack` walks back to every other place, a few steps for all samples at once.
"""

from __future__ import annotations

import pickle

import numpy as np


SAMPLED = 32


def spans(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All integers of the ranges ``[start, start + count)``, one range after the other."""
    total = int(counts.sum())
    if not total:
        return np.empty(0, np.int64)
    return np.arange(total) + np.repeat(starts - (np.cumsum(counts) - counts), counts)


class FMIndex:
    """Index of documents, each an array of 64-bit keys."""

    def __init__(self, ids: np.ndarray, flat: np.ndarray, lengths: np.ndarray):
        self.ids, self.lengths = ids.astype(np.int64), lengths.astype(np.int32)
        self.vocabulary, inverse = np.unique(flat, return_inverse=True)
        docs, n = len(ids), len(flat) + len(ids)
        text, place = np.zeros(n, np.int64), np.arange(len(flat)) + np.repeat(np.arange(docs), lengths)
        text[place] = inverse + 1
        order = self._suffixes(text, np.flatnonzero(text == 0), int(lengths.max(initial=0)))
        row = np.empty(n, np.int32)
        row[order] = np.arange(n)
        self.sampled = row[self._samples()[2]]
        self._wavelet(text[order - 1].astype(np.int64))
        self.before = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=len(self.vocabulary) + 1))))

    def _samples(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Document, place in it and place in the whole of the samples: the end of each document, and every SAMPLED-th place before."""
        lengths = self.lengths.astype(np.int64)
        counts = lengths // SAMPLED + 1
        doc = np.repeat(np.arange(len(lengths)), counts)
        at = lengths[doc] - SAMPLED * spans(np.zeros(len(counts), np.int64), counts)
        begin = np.concatenate(([0], np.cumsum(lengths + 1)))[:-1].astype(np.int64)
        return doc, at, begin[doc] + at

    def unpack(self) -> FMIndex:
        """Make ``doc`` and ``at`` of every row, and the documents' ``symbols``, in memory; done once where an index is loaded."""
        lengths = self.lengths.astype(np.int64)
        n = int(lengths.sum()) + len(lengths)
        self.offsets = np.concatenate(([0], np.cumsum(lengths)))
        self.symbols, self.doc, self.at = np.zeros(int(lengths.sum()), np.int32), np.zeros(n, np.int32), np.zeros(n, np.int32)
        before = self._transform(n)
        back = np.empty(n, np.int32)  # the row of the suffix that begins with the symbol before
        back[np.argsort(before, kind="stable")] = np.arange(n)
        doc, at, _ = self._samples()
        row = self.sampled.astype(np.int64)
        for _ in range(SAMPLED):
            self.doc[row], self.at[row] = doc, at
            go = at > 0
            doc, at, row = doc[go], at[go] - 1, row[go]
            self.symbols[self.offsets[doc] + at] = before[row]
            row = back[row]
        return self

    def _transform(self, n: int) -> np.ndarray:
        """The Burrows-Wheeler transform out of the wavelet matrix: from its last order, that of the symbols, up through the levels."""
        codes = np.argsort(self.begin, kind="stable").astype(np.int32)
        values = np.repeat(codes, np.diff(self.before)[codes])
        for bits, zeros in zip(reversed(self.bits), reversed(self.zeros), strict=True):
            bit = np.unpackbits(bits.view(np.uint8), count=n, bitorder="little").astype(bool)
            above = np.empty_like(values)
            above[~bit], above[bit] = values[:zeros], values[zeros:]
            values = above
        return values

    @staticmethod
    def _suffixes(text: np.ndarray, ends: np.ndarray, longest: int) -> np.ndarray:
        """Suffix array by prefix doubling. Each document's end counts as a symbol of its own, smaller
        than all words, so no comparison runs past it."""
        rank = text + len(ends)
        rank[ends] = np.arange(len(ends))
        step = 1
        while True:
            after = np.zeros_like(rank)
            after[:-step] = rank[step:] + 1
            key = rank * (int(rank.max(initial=0)) + 2 + int(after.max(initial=0))) + after
            order = np.argsort(key, kind="stable")
            new = np.empty_like(rank)
            new[order] = np.cumsum(np.concatenate(([0], key[order][1:] != key[order][:-1])))
            rank = new
            if step > longest or not len(rank) or rank[order[-1]] == len(rank) - 1:
                return order
            step *= 2

    def _wavelet(self, values: np.ndarray) -> None:
        self.levels = max(1, int(len(self.vocabulary)).bit_length())
        self.bits, self.ones, self.zeros = [], [], []
        begin = np.zeros(len(self.vocabulary) + 1, np.int64)
        code = np.arange(len(self.vocabulary) + 1)
        for level in range(self.levels - 1, -1, -1):
            bit = (values >> level) & 1
            packed = np.packbits(bit.astype(np.uint8), bitorder="little")
            words = np.zeros(len(values) // 64 + 2, np.uint64)
            words.view(np.uint8)[: len(packed)] = packed
            self.bits.append(words)
            self.ones.append(np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64)))[:-1].astype(np.int32))
            self.zeros.append(int(len(values) - bit.sum()))
            begin = self._down(len(self.bits) - 1, (code >> level) & 1, begin)
            values = np.concatenate((values[bit == 0], values[bit == 1]))
        self.begin = begin

    def _down(self, depth: int, bit: np.ndarray, i: np.ndarray) -> np.ndarray:
        word = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        ones = self.ones[depth][word] + np.bitwise_count(self.bits[depth][word] & mask)
        return np.where(bit == 1, self.zeros[depth] + ones, i - ones)

    def occurrences(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol stands among the first i of the transform."""
        for depth in range(self.levels):
            i = self._down(depth, (symbol >> (self.levels - 1 - depth)) & 1, i)
        return i - self.begin[symbol]

    def symbol_of(self, keys: np.ndarray) -> np.ndarray:
        """Symbols of keys, 0 for those that no document holds."""
        if not len(self.vocabulary):
            return np.zeros(len(keys), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, keys), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == keys, at + 1, 0)

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One backward step: the rows of each pattern with a symbol put before it."""
        base = self.before[symbol]
        return base + self.occurrences(symbol, low), base + self.occurrences(symbol, high)

    def matches(self, symbols: np.ndarray, first: np.ndarray, depth: int, most: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Backward search from every place of a stream of symbols.

        first marks the places where a record begins. Returns, per place, the rows of the ``depth``
        symbols ending there (an empty range where they don't occur) and the length of the longest
        match ending there, or ``most`` if that is reached.
        """
        low, high = self.before[symbols], self.before[symbols + 1]
        low = np.where(symbols == 0, 0, low)
        high = np.where(symbols == 0, 0, high)
        length = (high > low).astype(np.int32)
        out = (low.copy(), high.copy()) if depth == 1 else (np.zeros_like(low), np.zeros_like(high))
        at = np.flatnonzero(length)
        low, high, done = low[at], high[at], 1
        while len(at) and done != most:
            go = ~first[at - done + 1]
            at, low, high = at[go], low[go], high[go]
            s = symbols[at - done]
            go = s > 0
            at, low, high, s = at[go], low[go], high[go], s[go]
            low, high = self.extend(s, low, high)
            go = high > low
            at, low, high, done = at[go], low[go], high[go], done + 1
            length[at] = done
            if done == depth:
                out[0][at], out[1][at] = low, high
        return *out, length

    def dump(self) -> bytes:
        """What has to be stored; nothing of :meth:`unpack`."""
        return pickle.dumps({k: v for k, v in self.__dict__.items() if k not in ("symbols", "doc", "at", "offsets")}, 5)

    @classmethod
    def load(cls, blob: bytes) -> FMIndex:
        out = cls.__new__(cls)
        out.__dict__.update(pickle.loads(blob))
        return out
