"""Byte-level BPE encoding and decoding with padded numpy matrices.

A text is cut by the tokenizer's pattern; distinct pieces are encoded in
matrices of pieces of about equal length.  In every round each row merges its
leftmost pair of minimum rank: ranks of pairs come from an open-addressing
hash table, and the row is compacted by one column.  Finished rows leave.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from quillon.llm import frames

_NONE = np.int32(2**31 - 1)
#: Pieces a worker remembers before it starts anew; a bound on memory, not on the result.
CACHE_PIECES = 400_000
#: Cells of one matrix at most; one longer piece is a matrix of its own.
MATRIX_CELLS = 1 << 20
#: Tokens that are decoded together.
DECODED_TOKENS = 1 << 16
#: Longer pieces take the single-row form, which merges all places of a pair at once where that is safe.
LONG_PIECE = 256


class ByteBPE:
    """Ranks of a ``.tiktoken`` file, used as the tiktoken library uses them, without special tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.pattern = regex.compile(pattern)
        vocab = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            vocab[rank] = token
        self.sizes = np.array([len(token) for token in vocab], np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(vocab), np.uint8)
        self.ranks = ranks
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = rank
        self._fill(np.array(list(pairs), np.uint64), np.array(list(pairs.values()), np.int32))
        self.cache: dict[str, bytes] = {}

    @classmethod
    def from_file(cls, path: str, pattern: str) -> ByteBPE:
        with open(path, "rb") as lines:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}, pattern)

    def _fill(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Open addressing with linear probing, filled one probe distance at a time."""
        self.bits = max(4, int(len(keys) * 4 - 1).bit_length())
        size = 1 << self.bits
        self.keys, self.values = np.full(size, np.uint64(2**64 - 1)), np.full(size, _NONE, np.int32)
        slot, left = self._slot(keys), np.arange(len(keys))
        self.probes = 0
        while len(left):
            self.probes += 1
            free = left[self.values[slot[left]] == _NONE]
            _, first = np.unique(slot[free], return_index=True)
            put = free[first]
            self.keys[slot[put]], self.values[slot[put]] = keys[put], values[put]
            left = np.setdiff1d(left, put, assume_unique=True)
            slot[left] = (slot[left] + 1) & (size - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank that each pair of ids merges to, or _NONE; ids below zero are padding."""
        out = np.full(a.shape, _NONE, np.int32)
        real = (a >= 0) & (b >= 0)
        key = a[real].astype(np.uint64) << np.uint64(32) | b[real].astype(np.uint64)
        got, slot, left = np.full(len(key), _NONE, np.int32), self._slot(key), np.arange(len(key))
        for _ in range(self.probes):
            here = self.keys[slot[left]]
            hit = here == key[left]
            got[left[hit]] = self.values[slot[left[hit]]]
            left = left[~hit & (self.values[slot[left]] != _NONE)]
            if not len(left):
                break
            slot[left] = (slot[left] + 1) & (len(self.keys) - 1)
        out[real] = got
        return out

    def _matrix(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Encode pieces of about equal length."""
        n, width = len(pieces), max(map(len, pieces))
        ids = np.full((n, width), -1, np.int32)
        lengths = np.array([len(p) for p in pieces])
        ids[np.arange(width) < lengths[:, None]] = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        out: list[np.ndarray] = [None] * n
        rows = np.arange(n)
        ranks = self.pair_ranks(ids[:, :-1], ids[:, 1:])
        while len(rows):
            at = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(rows), np.int64)
            best = ranks[np.arange(len(rows)), at] if ranks.shape[1] else np.full(len(rows), _NONE)
            for k in np.flatnonzero(best == _NONE):
                out[rows[k]] = ids[k][ids[k] >= 0]
            live = best != _NONE
            rows, ids, ranks, at, best = rows[live], ids[live], ranks[live], at[live], best[live]
            if not len(rows):
                break
            every, cols = np.arange(len(rows)), np.arange(ids.shape[1] - 1)
            ids[every, at] = best
            ids = np.take_along_axis(ids, cols + (cols > at[:, None]), axis=1)
            cols = cols[:-1]
            ranks = np.take_along_axis(ranks, cols + (cols >= at[:, None]), axis=1)
            for place in (at - 1, at):
                ok = (place >= 0) & (place < ranks.shape[1])
                e, p = every[ok], place[ok]
                ranks[e, p] = self.pair_ranks(ids[e, p], ids[e, p + 1])
        return out

    def _long(self, piece: bytes) -> np.ndarray:
        """One long piece.  All places of the minimum pair merge in one round if no pair so made ranks lower; else only the leftmost."""
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)]
        ranks = self.pair_ranks(ids[:-1], ids[1:])
        while len(ranks) and (best := ranks.min()) != _NONE:
            at = np.flatnonzero(ranks == best)
            if len(at) > 1:
                run = np.concatenate(([0], np.cumsum(np.diff(at) > 1)))  # in runs of touching places, every other one
                start = at[np.searchsorted(run, run)]
                at = at[(at - start) % 2 == 0]
            for places in (at, at[:1]):
                new = ids.copy()
                new[places] = best
                keep = np.ones(len(ids), bool)
                keep[places + 1] = False
                new = new[keep]
                where = places - np.arange(len(places))
                around = np.unique(np.concatenate((where - 1, where)))
                around = around[(around >= 0) & (around < len(new) - 1)]
                fresh = self.pair_ranks(new[around], new[around + 1])
                if len(places) == 1 or not len(fresh) or fresh.min() > best:
                    break
            ranks = ranks[keep[1:]] if len(places) else ranks
            ranks = ranks[: len(new) - 1]
            ids = new
            ranks[around] = fresh
        return ids

    def encode_pieces(self, pieces: Iterable[bytes]) -> list[np.ndarray]:
        """Ids of each piece: whole tokens at once, the rest in length buckets."""
        pieces = list(pieces)
        out: list[np.ndarray] = [None] * len(pieces)
        rest = []
        for i, piece in enumerate(pieces):
            rank = self.ranks.get(piece)
            if rank is not None:
                out[i] = np.array([rank], np.int32)
            elif not piece:
                out[i] = np.zeros(0, np.int32)
            elif len(piece) > LONG_PIECE:
                out[i] = self._long(piece)
            else:
                rest.append(i)
        rest.sort(key=lambda i: len(pieces[i]))
        i = 0
        while i < len(rest):
            bound = max(8, len(pieces[rest[i]]) * 5 // 4)
            j = i
            while j < len(rest) and len(pieces[rest[j]]) <= bound and (j - i + 1) * bound <= MATRIX_CELLS:
                j += 1
            j = max(j, i + 1)
            for k, ids in zip(rest[i:j], self._matrix([pieces[r] for r in rest[i:j]]), strict=True):
                out[k] = ids
            i = j
        return out

    def encode_texts(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        split = [self.pattern.findall(t) for t in texts]
        if len(self.cache) > CACHE_PIECES:
            self.cache.clear()
        cache = self.cache
        missing = [p for p in set().union(*split) if p not in cache]
        for piece, ids in zip(missing, self.encode_pieces(p.encode() for p in missing), strict=True):
            cache[piece] = ids.astype("<u4").tobytes()
        return [b"".join(map(cache.__getitem__, pieces)) for pieces in split]

    def decode(self, ids: bytes) -> bytes:
        """The bytes of all tokens, copied out of one flat table, some tokens at a time."""
        every, out = np.frombuffer(ids, "<u4"), []
        for k in range(0, len(every), DECODED_TOKENS):
            at = every[k : k + DECODED_TOKENS]
            sizes = self.sizes[at]
            place = np.repeat(self.begins[at] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
            out.append(self.bytes[place].tobytes())
        return b"".join(out)


_loaded: dict[tuple[str, str], ByteBPE] = {}


def tokenizer(path: str, pattern: str) -> ByteBPE:
    """One tokenizer for each worker process."""
    if (path, pattern) not in _loaded:
        _loaded[path, pattern] = ByteBPE.from_file(path, pattern)
    return _loaded[path, pattern]


#: Characters encoded together, so that pieces of a very large batch are not all held at once.
CHUNK_CHARS = 2 << 20


def encode(docs: DataFrame, path: str, pattern: str, carry: bool = False) -> DataFrame:
    """Encode each whole text and decode it again.

    Returns doc_id (all columns with ``carry``), n_tokens, token_ids (binary:
    little-endian unsigned 32-bit), ids_sha256 and decoded_sha256.  Null text
    counts as empty: no tokens and the digests of nothing.  Rows are taken one
    by one, so repeated rows and null ids come back as they are; input columns
    with the names of outputs are replaced.
    """
    fields = [("n_tokens", T.LongType()), ("token_ids", T.BinaryType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType())]

    def run(batch: pa.RecordBatch) -> dict:
        bpe = tokenizer(path, pattern)
        texts = [t or "" for t in batch.column(batch.schema.get_field_index("text")).to_pylist()]
        ids: list[bytes] = []
        i = 0
        while i < len(texts):
            j, chars = i, 0
            while j < len(texts) and (j == i or chars + len(texts[j]) <= CHUNK_CHARS):
                chars += len(texts[j])
                j += 1
            ids += bpe.encode_texts(texts[i:j])
            i = j
        return {
            "n_tokens": [len(x) // 4 for x in ids],
            "token_ids": pa.array(ids, pa.binary()),
            "ids_sha256": [hashlib.sha256(x).hexdigest() for x in ids],
            "decoded_sha256": [hashlib.sha256(bpe.decode(x)).hexdigest() for x in ids],
        }

    source = docs if carry else docs.select("doc_id", "text")
    return frames.map_batches(source, fields, run, keep=docs.columns if carry else ["doc_id"])
