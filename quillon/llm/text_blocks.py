"""Vectorised views of UTF-8 text columns inside Arrow batches.

All text operators here treat a batch of documents as one byte buffer and find
words, lines and hashes with numpy, so that no Python object is made for each
word.  White space is ``[\\x20\\x09-\\x0D]`` throughout.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are looked at together; one longer text is a block of its own.
BLOCK_BYTES = 1 << 18
#: Bytes whose prefix sums are held at once while ranges are hashed, however long a text is.
HASH_BYTES = 1 << 18

_BASE = 0x9E3779B97F4A7C15 | 1
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

def _power_table(base: int) -> np.ndarray:
    """base**i modulo 2**64 for i up to HASH_BYTES."""
    table = np.full(HASH_BYTES + 1, base, np.uint64)
    table[0] = 1
    return np.multiply.accumulate(table)


_UP, _DOWN = _power_table(_BASE), _power_table(pow(_BASE, -1, 1 << 64))


def mix64(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser for 64-bit hashes."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


@dataclass
class Block:
    """Some documents of a batch: ``data[off[i]:off[i+1]]`` is the text of document ``first + i``."""

    first: int
    data: np.ndarray
    off: np.ndarray

    @property
    def docs(self) -> int:
        return len(self.off) - 1

    def text(self, i: int) -> bytes:
        return self.data[self.off[i] : self.off[i + 1]].tobytes()

    def lowered(self) -> np.ndarray:
        return _LOWER[self.data]

    def per_doc(self, flags: np.ndarray) -> np.ndarray:
        """How many of the flagged bytes each document has."""
        total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return total[self.off[1:]] - total[self.off[:-1]]

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and document of every word."""
        inside = ~_SPACE[self.data]
        before = np.empty_like(inside)
        before[1:] = inside[:-1]
        edges = self.off[:-1][self.off[:-1] < len(inside)]
        before[edges] = False
        starts = np.flatnonzero(inside & ~before)
        after = np.empty_like(inside)
        after[:-1] = inside[1:]
        edges = self.off[1:][self.off[1:] > 0]
        after[edges - 1] = False
        ends = np.flatnonzero(inside & ~after) + 1
        return starts, ends, np.searchsorted(self.off, starts, side="right") - 1

    def joined(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The words of ``data`` (this block's bytes or their lower case), each followed by one blank, with new starts, ends and documents."""
        starts, ends, docs = self.words()
        new_ends = np.cumsum(ends - starts + 1)
        gap = np.zeros(int(new_ends[-1]) if len(new_ends) else 0, bool)
        gap[new_ends - 1] = True
        out = np.full(len(gap), 32, np.uint8)
        out[~gap] = data[~_SPACE[self.data]]  # every byte that is no white space belongs to one word
        return out, new_ends - (ends - starts) - 1, new_ends - 1, docs

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and document of every \\n-separated line; an empty text is one empty line."""
        breaks = self.data == 10
        at = np.flatnonzero(breaks)
        starts = np.sort(np.concatenate((self.off[:-1], at + 1)))
        ends = np.sort(np.concatenate((at, self.off[1:])))
        return starts, ends, np.repeat(np.arange(self.docs), self.per_doc(breaks) + 1)

    def hashes(self, starts: np.ndarray, ends: np.ndarray, data: np.ndarray | None = None) -> np.ndarray:
        """A 64-bit hash of each byte range, alike wherever the range stands; starts and ends ascend.

        Sums of base**i * byte are carried from chunk to chunk, so memory beyond
        the ranges themselves does not grow with the text.
        """
        data = self.data if data is None else data
        at_start, at_end, back = (np.zeros(len(starts), np.uint64) for _ in range(3))
        carry, whole = 0, (1 << 64) - 1
        for c in range(0, len(data), HASH_BYTES):
            part = data[c : c + HASH_BYTES]
            past = c + len(part)
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum((part.astype(np.uint64) + np.uint64(1)) * _UP[: len(part)], out=sums[1:])
            up, down = pow(_BASE, c, 1 << 64), pow(_BASE, -c, 1 << 64)
            a, b = np.searchsorted(starts, [c, past + (past == len(data))])
            at_start[a:b] = np.uint64(carry) + np.uint64(up) * sums[starts[a:b] - c]
            back[a:b] = np.uint64(down) * _DOWN[starts[a:b] - c]
            a, b = np.searchsorted(ends, [c, past], side="right")
            at_end[a:b] = np.uint64(carry) + np.uint64(up) * sums[ends[a:b] - c]
            carry = (carry + up * int(sums[-1])) & whole
        return mix64((at_end - at_start) * back + (ends - starts).astype(np.uint64))


def blocks(column: pa.Array | pa.ChunkedArray, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Cut a string column (null: empty text) into blocks of about ``limit`` bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    n = len(column)
    if not n:
        return
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, side="right")) - 1)
        yield Block(i, raw[off[i] : off[j]], off[i : j + 1] - off[i])
        i = j


def windows(hashes: np.ndarray, docs: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of all runs of ``n`` consecutive words within one document."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = np.zeros(count, np.uint64)
    for k in range(n):
        h *= np.uint64(_BASE)
        h += hashes[k : k + count]
    at = np.flatnonzero(docs[:count] == docs[n - 1 :])
    return at, mix64(h[at])


def covered(at: np.ndarray, n: int, words: int) -> np.ndarray:
    """Which of ``words`` positions lie in a window of ``n`` that starts at one of ``at``."""
    step = np.bincount(at, minlength=words + 1) - np.bincount(np.minimum(at + n, words), minlength=words + 1)
    return np.cumsum(step[:-1]) > 0
