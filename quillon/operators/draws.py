"""Draws of block resamples, counted in bulk: hashes by numpy, packed by chunks of places.

A row a draw would have to be moved and sorted for each replicate.  Here the
draws of a replicate that start in one chunk of places are one row of about a
byte a draw, and each chunk of values sums all blocks that start in it.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa

_SHIFTS = [s for four in ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)) for s in four * 4]
_SINES = [int(abs(math.sin(i + 1)) * 2**32) for i in range(64)]
_WORDS = [*range(16), *[(5 * i + 1) % 16 for i in range(16, 32)], *[(3 * i + 5) % 16 for i in range(32, 48)], *[7 * i % 16 for i in range(48, 64)]]
_AT_ONCE, _FEW = 8192, 512
#: Bytes of rows that are handed on at once.
_BYTES = 4 << 20


def _md5_block(state: list[np.ndarray], words: list) -> list[np.ndarray]:
    """MD5's compression of 16 words (arrays, or whole numbers that all texts share) into the four state arrays."""
    a, b, c, d = (x.copy() for x in state)
    f, t = np.empty_like(a), np.empty_like(a)
    for i in range(64):
        if i < 16:
            np.bitwise_xor(c, d, out=f)
            np.bitwise_and(f, b, out=f)
            np.bitwise_xor(f, d, out=f)
        elif i < 32:
            np.bitwise_xor(b, c, out=f)
            np.bitwise_and(f, d, out=f)
            np.bitwise_xor(f, c, out=f)
        elif i < 48:
            np.bitwise_xor(b, c, out=f)
            np.bitwise_xor(f, d, out=f)
        else:
            np.invert(d, out=f)
            np.bitwise_or(f, b, out=f)
            np.bitwise_xor(f, c, out=f)
        a += f
        word = words[_WORDS[i]]
        if isinstance(word, int):
            a += np.uint32((word + _SINES[i]) & 0xFFFFFFFF)
        else:
            a += word
            a += np.uint32(_SINES[i])
        np.left_shift(a, np.uint32(_SHIFTS[i]), out=t)
        np.right_shift(a, np.uint32(32 - _SHIFTS[i]), out=a)
        a |= t
        a += b
        a, b, c, d = d, a, b, c
    return [x + y for x, y in zip(state, (a, b, c, d), strict=True)]


def _heads_of_width(prefix: bytes, first: int, last: int, width: int) -> np.ndarray:
    m, length = last - first + 1, len(prefix) + width
    fixed = bytearray((length + 8) // 64 * 64 + 64)
    fixed[: len(prefix)] = prefix
    fixed[length] = 0x80
    fixed[-8:] = (8 * length).to_bytes(8, "little")
    words: list = [int.from_bytes(fixed[k : k + 4], "little") for k in range(0, len(fixed), 4)]
    rest = np.arange(first, last + 1)
    for at in range(length - 1, len(prefix) - 1, -1):
        rest, digit = np.divmod(rest, 10)
        byte = (digit + 48).astype(np.uint32) << np.uint32(8 * (at % 4))
        words[at // 4] = byte + np.uint32(words[at // 4]) if isinstance(words[at // 4], int) else words[at // 4] + byte
    state = [np.full(m, x, np.uint32) for x in (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)]
    for k in range(0, len(words), 16):
        state = _md5_block(state, words[k : k + 16])
    return state[0].byteswap()


def heads(prefix: bytes, first: int, last: int) -> np.ndarray:
    """The first eight hex digits of md5(prefix + number) as numbers, for the numbers from ``first`` to ``last``."""
    if last - first < _FEW:
        start = hashlib.md5(prefix, usedforsecurity=False)
        out = np.empty(last - first + 1, np.uint32)
        for k in range(first, last + 1):
            one = start.copy()
            one.update(b"%d" % k)
            out[k - first] = int.from_bytes(one.digest()[:4], "big")
        return out
    out, low = [], first
    while low <= last:
        width = len(str(low))
        high = min(last, low + _AT_ONCE - 1, 10**width - 1)
        out.append(_heads_of_width(prefix, low, high, width))
        low = high + 1
    return np.concatenate(out)


def encode(sorted_places: np.ndarray) -> bytes:
    """Places of a chunk by their differences: a byte each, after as many bytes 255 as 255 goes into it; four bytes each where that is shorter."""
    gaps = np.diff(sorted_places, prepend=sorted_places.dtype.type(0))
    ends = np.cumsum(gaps // 255 + 1, dtype=np.int64)
    if ends[-1] > 4 * len(gaps):
        return b"\x04" + gaps.astype(np.uint32).tobytes()
    out = np.full(ends[-1], 255, np.uint8)
    out[ends - 1] = gaps % 255
    return b"\x01" + out.tobytes()


def decode(data: bytes) -> np.ndarray:
    steps = np.frombuffer(data, np.uint8 if data[0] == 1 else np.uint32, offset=1)
    places = np.cumsum(steps, dtype=np.int64)
    return places[steps != 255] if data[0] == 1 else places


def _rows(batch: pa.RecordBatch, at_once: int = 64) -> Iterator[dict]:
    for k in range(0, batch.num_rows, at_once):
        yield from batch.slice(k, at_once).to_pylist()


def _batches(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += 64 + sum(len(x) for x in row if isinstance(x, bytes))
        if size >= _BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)


DRAWN = "base long, chunk long, rep int, last boolean, data binary"
_DRAWN = pa.schema([("base", pa.int64()), ("chunk", pa.int64()), ("rep", pa.int32()), ("last", pa.bool_()), ("data", pa.binary())])


def draw_packed(seed: int, span: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """From (base, key, n, len, blocks, rep, first, until) the starts of blocks first to until, packed by chunk of ``span`` places; the last block of a replicate apart."""

    def packed(batches):
        for batch in batches:
            for r in _rows(batch):
                below = r["n"] - r["len"] + 1
                starts = heads(f"{seed}|{r['key']}|{r['rep']}|".encode(), r["first"], r["until"])
                starts = starts % np.uint32(below) if below < 2**32 else starts
                cut = len(starts) - (r["until"] == r["blocks"] - 1)
                for last, some in ((False, starts[:cut]), (True, starts[cut:])):
                    if len(some):
                        some = np.sort(some)
                        chunks = some // np.uint32(span)
                        edges = [0, *(np.flatnonzero(np.diff(chunks)) + 1), len(some)]
                        for lo, hi in zip(edges, edges[1:]):
                            chunk = int(chunks[lo])
                            yield r["base"], chunk, r["rep"], last, encode(some[lo:hi] - np.uint32(chunk * span))

    return lambda batches: _batches(packed(batches), _DRAWN)


VALUES = "base long, chunk long, data binary, bad binary, before double, bad_before long"
_VALUES = pa.schema([("base", pa.int64()), ("chunk", pa.int64()), ("data", pa.binary()), ("bad", pa.binary()), ("before", pa.float64()), ("bad_before", pa.int64())])


def pack_values(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (base, chunk, v, b), sorted by chunk and place, one row a chunk: values, and flags of the bad ones if there are any.

    The first row of a chunk holds the sums of v and b over the chunks before it.
    """

    def chunks():
        now, held = None, []

        def done():
            v, b = (np.concatenate(x) for x in zip(*held, strict=True))
            return *now, v[1:].tobytes(), b[1:].astype(np.uint8).tobytes() if b[1:].any() else b"", float(v[0]), int(b[0])

        for batch in batches:
            base, chunk, v, b = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(4))
            edges = [0, *(np.flatnonzero((np.diff(base) != 0) | (np.diff(chunk) != 0)) + 1), len(base)] if len(base) else []
            for lo, hi in zip(edges, edges[1:]):
                key = int(base[lo]), int(chunk[lo])
                if key != now and held:
                    yield done()
                    held = []
                now = key
                held.append((v[lo:hi].copy(), b[lo:hi].copy()))
        if held:
            yield done()

    return _batches(chunks(), _VALUES)


SUMS = "base long, rep int, sum double, bad long"
_SUMS = pa.schema([("base", pa.int64()), ("rep", pa.int32()), ("sum", pa.float64()), ("bad", pa.int64())])


def _block_sums(own: dict, near: dict[int, dict], size: int, span: int) -> tuple[np.ndarray, np.ndarray | None]:
    """For each place of a chunk where a block may start, the sum of ``size`` values from there on and the count of bad ones."""
    starts = min(len(own["data"]) // 8, own["n"] - own["len"] + 1 - own["chunk"] * span)
    ends = np.arange(starts) + (size - 1)
    out = []
    for data, kind, before in (("data", np.float64, "before"), ("bad", np.uint8, "bad_before")):
        flags = [x for x in near.values() if x[data]]
        if not flags:
            out.append(None)
            continue
        upto = np.empty(starts, np.float64 if data == "data" else np.int64)
        zero = lambda x: np.frombuffer(x[data], kind) if x[data] else np.zeros(len(x["data"]) // 8, kind)
        for far in np.unique(ends // span):
            mine = ends // span == far
            row = near[int(far)]
            upto[mine] = np.cumsum(zero(row), dtype=upto.dtype)[ends[mine] % span] + (row[before] - own[before])
        first = zero(own).astype(upto.dtype)
        out.append(upto - (np.cumsum(first) - first)[:starts])
    return out[0], out[1]


def sum_blocks(span: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """From chunks of values (rep -1) and packed draws, sorted by chunk and rep, the sum of each replicate's blocks that start in a chunk."""

    def sums(batches):
        now, near, tables = None, {}, None
        for batch in batches:
            for r in _rows(batch):
                key = r["base"], r["chunk"]
                if key != now:
                    now, near, tables = key, {}, None
                if r["rep"] < 0:
                    near[r["far"]] = r
                    continue
                if tables is None:
                    own = near[0]
                    tables = {False: _block_sums(own, near, own["len"], span), True: _block_sums(own, near, own["cut"], span)}
                    near = {}
                total, bad = tables[r["last"]]
                places = decode(r["data"])
                yield *now, r["rep"], float(total[places].sum()), int(bad[places].sum()) if bad is not None else 0

    return lambda batches: _batches(((base, rep, total, bad) for base, _, rep, total, bad in sums(batches)), _SUMS)
