"""A succinct FM-index over sequences of words, with vectorised backward search.

The Burrows-Wheeler transform is held in a wavelet matrix (a wavelet tree laid
out by levels): one bit vector for each bit of the alphabet, packed in 64-bit
words with running counts.  Suffixes are ordered by their first ``window`` + 1
symbols, which is exact for patterns of up to that many.  The suffix array is
needed to build the index only; what stays of it is one bit for each row, set
where a class of suffixes with the same first ``window`` symbols begins, and
one number for each class.
"""

from __future__ import annotations

import numpy as np


class BitVector:
    """Packed bits with rank."""

    def __init__(self, bits: np.ndarray) -> None:
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.ranks = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64))).astype(np.int32)

    def rank1(self, i: np.ndarray) -> np.ndarray:
        """Ones before place i."""
        w = i >> 6
        below = self.words[w] & ((np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1))
        return self.ranks[w] + np.bitwise_count(below)

    def select1(self, k: np.ndarray) -> np.ndarray:
        """The place of the k-th one, from 0."""
        w = np.searchsorted(self.ranks, k, side="right") - 1
        left = k - self.ranks[w]
        word, place = self.words[w], w << 6
        for half in (32, 16, 8, 4, 2, 1):
            low = np.bitwise_count(word & np.uint64((1 << half) - 1))
            up = left >= low
            left = left - np.where(up, low, 0)
            word = np.where(up, word >> np.uint64(half), word)
            place = place + np.where(up, half, 0)
        return place


class WaveletMatrix:
    """Rank of any symbol in any prefix, in one step for each bit of the alphabet."""

    def __init__(self, symbols: np.ndarray, bits: int) -> None:
        self.levels: list[tuple[int, BitVector, int]] = []
        for shift in range(bits - 1, -1, -1):
            bit = ((symbols >> shift) & 1).astype(np.uint8)
            zeros = symbols[bit == 0]
            self.levels.append((shift, BitVector(bit), len(zeros)))
            symbols = np.concatenate((zeros, symbols[bit == 1]))

    def rank_pair(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each query: where the symbol's run starts after the last level, and how far low and high lie in it."""
        start = np.zeros(len(symbol), np.int64)
        for shift, vector, zeros in self.levels:
            one = ((symbol >> shift) & 1).astype(bool)
            places = np.concatenate((start, low, high))
            ones = vector.rank1(places)
            moved = np.where(np.tile(one, 3), zeros + ones, places - ones)
            start, low, high = np.split(moved, 3)
        return start, low - start, high - start


class FMIndex:
    """Index of concatenated sequences; symbol 0 separates them and no pattern holds it.

    ``window`` symbols is the length of pattern that :meth:`matching` reports.
    ``owner`` has a number for each place of the text; the index keeps the
    least one of each class.
    """

    def __init__(self, text: np.ndarray, window: int, owner: np.ndarray) -> None:
        self.n, self.window = len(text), window
        sigma = int(text.max()) + 1 if len(text) else 1
        order = self._sorted_suffixes(text)
        self.counts = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=sigma)))).astype(np.int32)
        self.bwt = WaveletMatrix(text[order - 1].astype(np.int32), max(1, (sigma - 1).bit_length()))
        begins = np.append(self._prefix_change(text, order), True)  # the end closes the last class
        self.least = np.minimum.reduceat(owner[order], np.flatnonzero(begins[:-1]))
        self.classes = BitVector(begins)

    def _sorted_suffixes(self, text: np.ndarray) -> np.ndarray:
        """Places of the text in the order of their first ``window`` + 1 symbols, by doubling."""
        rank, depth = text.astype(np.int64), 1
        while depth <= self.window:
            step = min(depth, self.window + 1 - depth)
            follow = np.zeros_like(rank)
            follow[: self.n - step] = rank[step:] + 1 if step < self.n else 0
            key = rank * (int(rank.max()) + 2) + follow
            order = np.argsort(key, kind="stable")
            ranked = key[order]
            rank[order] = np.concatenate(([0], np.cumsum(ranked[1:] != ranked[:-1])))
            depth += step
        return order

    def class_of(self, row: np.ndarray) -> np.ndarray:
        """The class of each row."""
        return self.classes.rank1(row + 1) - 1

    def _prefix_change(self, text: np.ndarray, order: np.ndarray) -> np.ndarray:
        """Whether a row's first ``window`` symbols differ from the row's before (runs over the end differ)."""
        change = np.zeros(self.n, bool)
        change[:1] = True
        a, b = order[:-1], order[1:]
        same = np.maximum(a, b) + self.window <= self.n
        left = np.flatnonzero(same)
        for k in range(self.window):
            left = left[text[a[left] + k] == text[b[left] + k]]
        same[:] = False
        same[left] = True
        change[1:] = ~same
        return change

    def step(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Extend patterns with the interval [low, high) by one symbol to the left."""
        _, a, b = self.bwt.rank_pair(symbol, low, high)
        return self.counts[symbol] + a, self.counts[symbol] + b

    def matching(self, sequences: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, ...]:
        """Stream sequences of the text through the index from right to left.

        The matching statistic is kept at ``window`` symbols: after each step
        to the left the interval is widened to all suffixes that share the
        first ``window`` symbols.  Returns for every place with a full window:
        sequence number, offset in it, its interval of suffixes and their class.
        """
        live = np.flatnonzero(lengths >= self.window)
        out = []
        low, high = np.zeros(len(starts), np.int64), np.full(len(starts), self.n, np.int64)
        longest = int(lengths.max()) if len(lengths) else 0
        for back in range(1, longest + 1):
            live = live[lengths[live] >= back]
            at = starts[live] + lengths[live] - back
            low[live], high[live] = self.step(sequences[at], low[live], high[live])
            if back >= self.window:
                kind = self.class_of(low[live])
                low[live], high[live] = self.classes.select1(kind), self.classes.select1(kind + 1)
                out.append((live, lengths[live] - back, low[live], high[live], kind))
        if not out:
            return (np.zeros(0, np.int64),) * 5
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))
