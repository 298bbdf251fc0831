"""Two Bloom filters: one of hashes seen once, one of hashes seen in two documents or more.

The once-seen filter is dealt to executors by ranges of hashes: each task
holds the slice of one range at a time, laid out for the hashes it expects, so
a corpus of any size needs more slices and no larger ones.  A hash that its
slice has already is a suspected repeat.  The suspects make the twice-seen
filter, sized by their number, which all executors get; beyond
``FILTER_BYTES`` it is cut into several, each for a range of hashes, and a
reader goes over its input once for each.

Too few bits make more suspects and never lose one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillon.llm import frames
from quillon.llm.text_blocks import mix64

#: Bits of a filter for each hash that it is laid out for.
BITS_PER_HASH = 16
#: Hashes that one slice of the once-seen filter is laid out for.
SLICE_HASHES = 1 << 21
#: Hashes that a task merges before it sends them on.
HELD = 1 << 20
#: Bits of a page, the part of the twice-seen filter that one row carries.
PAGE_BITS = 1 << 16
#: Bytes of a twice-seen filter that executors hold at once.
FILTER_BYTES = 64 << 20

_SENT = T.StructType([T.StructField("slice", T.IntegerType()), T.StructField("hashes", T.BinaryType()), T.StructField("again", T.BinaryType())])
_PAGES = T.StructType([T.StructField("page", T.LongType()), T.StructField("bits", T.BinaryType())])


def _ranges(h: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` equal ranges (fewer than 2**31) each hash is in."""
    return (((h >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)).astype(np.int64)


def _slots(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two places of each hash among ``bits``, a power of two of at most 2**32."""
    h, mask = mix64(h), np.uint64(bits - 1)
    return (h & mask).astype(np.int64), ((h >> np.uint64(32)) & mask).astype(np.int64)


def _have(packed: np.ndarray, slots: tuple[np.ndarray, ...]) -> np.ndarray:
    found = np.ones(len(slots[0]), bool)
    for s in slots:
        found &= (packed[s >> 3] >> (7 - (s & 7)).astype(np.uint8)) & 1 > 0
    return found


def _put(packed: np.ndarray, slots: tuple[np.ndarray, ...]) -> None:
    for s in slots:
        np.bitwise_or.at(packed, s >> 3, np.uint8(128) >> (s & 7).astype(np.uint8))


def repeats(df: DataFrame, hashes: Callable[[pa.RecordBatch], Iterator[np.ndarray]], expected: int, bits_per_hash: int = BITS_PER_HASH, slice_hashes: int = SLICE_HASHES) -> DataFrame:
    """A written table (hash: long) of hashes that come from two documents or more, and of a few others.

    ``hashes`` yields arrays in which each document has a hash once;
    ``expected`` is about how many there are in all.  Only hashes move.
    """
    slices = max(1, -(-expected // slice_hashes))
    bits = 1 << max(6, (slice_hashes * bits_per_hash - 1).bit_length())

    def merged(held: list[np.ndarray]) -> pa.RecordBatch:
        h, n = np.unique(np.concatenate(held), return_counts=True)
        cuts = np.searchsorted(_ranges(h, slices), np.arange(slices + 1))
        full = np.flatnonzero(np.diff(cuts))
        rows = [(int(k), h[cuts[k] : cuts[k + 1]].tobytes(), (n[cuts[k] : cuts[k + 1]] > 1).tobytes()) for k in full]
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(list(c), kind) for c, kind in zip(columns, (pa.int32(), pa.binary(), pa.binary()), strict=True)], names=_SENT.names)

    def send(batches):
        held, size = [], 0
        for batch in frames.pieces(batches):
            for h in hashes(batch):
                held.append(h)
                size += len(h)
                if size >= HELD:
                    yield merged(held)
                    held, size = [], 0
        if size:
            yield merged(held)

    def fill(batches):
        once = np.zeros(bits // 8, np.uint8)
        at, found, size = None, [], 0

        def close():
            return pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(found)).view(np.int64))], names=["hash"])

        for batch in batches:
            for k, sent, again in zip(*(batch.column(i) for i in range(3)), strict=True):
                if k.as_py() != at:
                    if found:
                        yield close()
                    at, found, size = k.as_py(), [], 0
                    once[:] = 0
                h = np.frombuffer(sent.as_buffer(), np.uint64)
                slots = _slots(h, bits)
                repeat = h[_have(once, slots) | np.frombuffer(again.as_buffer(), bool)]
                _put(once, slots)
                if len(repeat):
                    found.append(repeat)
                    size += len(repeat)
                    if size > 4 * HELD:  # a hash in very many documents is found again and again
                        found = [np.unique(np.concatenate(found))]
                        size = len(found[0])
        if found:
            yield close()

    dealt = df.mapInArrow(send, _SENT).repartition("slice").sortWithinPartitions("slice")
    return frames.written(dealt.mapInArrow(fill, "hash long"), "repeats")


class Filter:
    """The twice-seen filter, or the part of it for the pages from ``first`` on."""

    def __init__(self, value: tuple[bytes, int, int, int]) -> None:
        packed, self.pages, self.first, self.page_bits = value
        self.packed = np.frombuffer(packed, np.uint8)
        self.held = len(packed) * 8 // self.page_bits

    def contains(self, h: np.ndarray) -> np.ndarray:
        page = _ranges(h, self.pages) - self.first
        slots = tuple(np.clip(page, 0, self.held - 1) * self.page_bits + s for s in _slots(h, self.page_bits))
        found = _have(self.packed, slots)
        return found if self.held == self.pages else found & (page >= 0) & (page < self.held)


def filters(hashes: DataFrame, bits_per_hash: int = BITS_PER_HASH, filter_bytes: int = FILTER_BYTES, page_bits: int = PAGE_BITS) -> list[Broadcast]:
    """Broadcasts, each the argument of a :class:`Filter`, that together hold all of (hash: long).

    Executors build the pages; at most ``filter_bytes`` are on the driver at
    once.  No hashes: no filters.
    """
    spark = hashes.sparkSession
    n = hashes.count()
    if not n:
        return []
    pages = -(-n * bits_per_hash // page_bits)
    at_once = max(1, filter_bytes * 8 // page_bits)

    def build(batches):
        page, packed = None, np.zeros(page_bits // 8, np.uint8)

        def row():
            return pa.RecordBatch.from_arrays([pa.array([page], pa.int64()), pa.array([packed.tobytes()], pa.binary())], names=_PAGES.names)

        for batch in batches:
            at, h = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            edge = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1]))) if len(at) else []
            for a, b in zip(edge, [*edge[1:], len(at)], strict=True):
                if at[a] != page:
                    if page is not None:
                        yield row()
                    page = int(at[a])
                    packed[:] = 0
                _put(packed, _slots(h[a:b].view(np.uint64), page_bits))
        if page is not None:
            yield row()

    page = F.shiftright(F.shiftrightunsigned("hash", 32) * F.lit(pages).cast("long"), 32).alias("page")
    paged = hashes.select(page, "hash").repartition("page").sortWithinPartitions("page").mapInArrow(build, _PAGES)
    if pages > at_once:
        paged = frames.written(paged, "pages")
    out = []
    for first in range(0, pages, at_once):
        packed = np.zeros((min(at_once, pages - first), page_bits // 8), np.uint8)
        mine = paged.filter(F.col("page").between(first, first + at_once - 1)) if pages > at_once else paged
        for r in mine.collect():
            packed[r["page"] - first] = np.frombuffer(r["bits"], np.uint8)
        out.append(spark.sparkContext.broadcast((packed.tobytes(), pages, first, page_bits)))
    return out


def text_bytes(docs: DataFrame) -> int:
    """UTF-8 bytes of all texts."""
    return docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
