"""Substring dedup with an FM-index per shard.

A window is a run of ``window`` words of one document; a word goes if a window
over it also starts in a document with a smaller doc_id.

1. Each window has an anchor, the least hash of the word runs of ``GRAM`` in it.
   Two Bloom filters find the anchors that several documents have; windows with
   other anchors cannot repeat and are dropped here, without a shuffle.
2. Neighbouring windows of one anchor form a segment.  Equal segments are
   summed up in each task.  Segments are dealt to shards by anchor, so equal
   windows meet; a shard builds an FM-index of its segments and streams them
   through it by backward search, which gives the interval, and so the
   smallest document, of every window.  Shards hold a bounded number of words.
3. An anchor with more than ``HOT_ROWS`` segments would not fit a shard.  Its
   windows take the least hash that is not such an anchor's instead; if that is
   hot too, or there is none, the hash of the window itself, of which there are
   few segments.  So all windows go through an index.
4. Windows that an earlier document has go back to the documents by segment;
   documents without any are not moved if the keys of the others are few enough
   to be broadcast.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillon.llm import bloom, frames
from quillon.llm.fm_index import FMIndex
from quillon.llm.text_blocks import Block, blocks, covered, mix64, windows

WINDOW, GRAM = 13, 6
#: Windows of one segment at most, so that a segment is short whatever the text.
RUN = 32
#: Words of a shard's index, about.
SHARD_WORDS = 1 << 20
HOT_ROWS = 50_000
#: Segments a task sums up before it sends them on.
HELD = 100_000
#: UTF-8 bytes of text for each anchor of a document that the filters are laid out for.
BYTES_PER_ANCHOR = 24
#: Keys of documents that lose words, broadcast up to this many; beyond that every document is joined.
BROADCAST_KEYS = 1_000_000
_MOST = np.uint64(2**64 - 1)

_SEGMENTS = "anchor long, text binary, low long, high long"
_PLACES = "doc_id long, digest long, id binary, start int"
_EARLIER = "id binary, offs array<int>, mins array<long>"


class Segments:
    """Segments of a block: first word, number of windows, anchor and document of each.

    Hashes of the filter ``hot[0]`` are no anchors while there are others;
    windows whose anchor is in ``hot[1]`` have themselves as anchor.
    """

    def __init__(self, block: Block, window: int, hot: Sequence[bloom.Filter] = ()) -> None:
        starts, ends, docs = block.words()
        hashes = block.hashes(starts, ends)
        gram = min(GRAM, window)
        at, grams = windows(hashes, docs, gram)
        n = len(starts) - window + 1
        empty = np.zeros(0, np.int64)
        self.first, self.count, self.doc, self.anchor = empty, empty, empty, empty.astype(np.uint64)
        if n <= 0:
            return
        if hot:
            grams = np.where(hot[0].contains(mix64(grams)), _MOST, grams)
        least = np.full(len(starts), _MOST)
        least[at] = grams
        width, span = 1, window - gram + 1
        while width < span:
            step = min(width, span - width)
            least = np.minimum(least[:-step], least[step:])
            width += step
        valid, whole = windows(hashes, docs, window)
        if not len(valid):
            return
        anchor = mix64(least[valid])
        if hot:
            alone = least[valid] == _MOST
            for more in hot[1:]:
                alone |= more.contains(anchor)
            anchor = np.where(alone, mix64(whole + np.uint64(1)), anchor)
        new = np.ones(len(valid), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (valid[1:] != valid[:-1] + 1)
        heads = np.flatnonzero(new)
        place = np.arange(len(valid)) - np.repeat(heads, np.diff(np.append(heads, len(valid))))
        heads = np.flatnonzero(place % RUN == 0)
        self.first = valid[heads]
        self.count = np.diff(np.append(heads, len(valid)))
        self.anchor = anchor[heads]
        self.doc = docs[self.first]

    def anchors_once_a_doc(self) -> np.ndarray:
        order = np.lexsort((self.anchor, self.doc))
        a, d = self.anchor[order], self.doc[order]
        new = np.ones(len(order), bool)
        new[1:] = (a[1:] != a[:-1]) | (d[1:] != d[:-1])
        return a[new]


class Cut:
    """How documents are cut into segments and which of these are suspects; opened in each task."""

    def __init__(self, window: int, hot: Sequence[Broadcast], repeated: Broadcast | None = None) -> None:
        self.window, self.hot, self.repeated = window, tuple(hot), repeated

    def open(self) -> Cut:
        opened = Cut(self.window, ())
        opened.hot = tuple(bloom.Filter(h.value) for h in self.hot)
        opened.repeated = self.repeated and bloom.Filter(self.repeated.value)
        return opened

    def segments(self, block: Block) -> Segments:
        return Segments(block, self.window, self.hot)


def _suspects(block: Block, cut: Cut):
    """Document, first word, id, text and anchor of the segments whose anchor is in the filter."""
    segments, window = cut.segments(block), cut.window
    use = np.flatnonzero(cut.repeated.contains(segments.anchor))
    if not len(use):
        return
    joined, starts, ends, docs = block.joined(block.data)
    doc_head = np.searchsorted(docs, np.arange(block.docs))
    first, last = segments.first[use], segments.first[use] + segments.count[use] + window - 2
    data = joined.tobytes()
    spans = zip(segments.doc[use].tolist(), (first - doc_head[segments.doc[use]]).tolist(), starts[first].tolist(), ends[last].tolist(), segments.anchor[use].view(np.int64).tolist(), strict=True)
    for d, p, a, b, anchor in spans:
        text = data[a:b]
        yield d, p, segment_id(text), text, anchor


def _segment_rows(docs: DataFrame, cut: Cut) -> DataFrame:
    """Distinct segments of each task, with the smallest and largest doc_id that has them."""

    def run(batches):
        here = cut.open()
        held: dict[bytes, list] = {}

        def flush():
            rows = list(held.values())
            columns = [pa.array([r[k] for r in rows], kind) for k, kind in ((2, pa.int64()), (3, pa.binary()), (0, pa.int64()), (1, pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["anchor", "text", "low", "high"])
            held.clear()

        for batch in frames.pieces(batches):
            ids = batch.column(0).to_pylist()
            for block in blocks(batch.column(1)):
                for d, _, key, text, anchor in _suspects(block, here):
                    doc = ids[block.first + d]
                    have = held.get(key)
                    if have is None:
                        held[key] = [doc, doc, anchor, text]
                    elif doc < have[0]:
                        have[0] = doc
                    elif doc > have[1]:
                        have[1] = doc
                if len(held) >= HELD:
                    yield from flush()
        if held:
            yield from flush()

    return docs.select("doc_id", "text").mapInArrow(run, _SEGMENTS)


def _place_rows(docs: DataFrame, cut: Cut) -> DataFrame:
    """Where each suspected segment stands: document, first word."""

    def run(batches):
        here = cut.open()
        for batch in frames.pieces(batches):
            ids, digests = batch.column(0).to_numpy(zero_copy_only=False), batch.column(2).to_numpy(zero_copy_only=False)
            for block in blocks(batch.column(1)):
                rows = [(block.first + d, p, key) for d, p, key, _, _ in _suspects(block, here)]
                if rows:
                    d, p, keys = zip(*rows, strict=True)
                    d = np.array(d)
                    yield pa.RecordBatch.from_arrays([pa.array(ids[d], pa.int64()), pa.array(digests[d], pa.int64()), pa.array(keys, pa.binary()), pa.array(p, pa.int32())], names=["doc_id", "digest", "id", "start"])

    return docs.select("doc_id", "text", "digest").mapInArrow(run, _PLACES)


def segment_id(text: bytes) -> bytes:
    return hashlib.md5(text, usedforsecurity=False).digest()


def _search(texts: list[bytes], low: np.ndarray, high: np.ndarray, window: int):
    """Index the segments of a shard and stream them: for each the windows that some document before its last one has."""
    words = [t.split(b" ") for t in texts]
    lengths = np.array([len(w) for w in words])
    number: dict[bytes, int] = {}
    ends = np.cumsum(lengths + 1)
    starts = ends - lengths - 1
    text = np.zeros(int(ends[-1]), np.int64)
    flat = [number.setdefault(x, len(number) + 1) for w in words for x in w]
    inside = np.ones(len(text), bool)
    inside[ends - 1] = False
    text[inside] = flat
    index = FMIndex(text, window, np.repeat(low, lengths + 1))
    segment, offset, _, _, kind = index.matching(text, starts, lengths)
    minimum = index.least[kind]
    tell = np.flatnonzero(minimum < high[segment])
    order = tell[np.lexsort((offset[tell], segment[tell]))]
    segment, offset, minimum = segment[order], offset[order], minimum[order]
    head = np.flatnonzero(np.concatenate(([True], segment[1:] != segment[:-1]))) if len(segment) else np.zeros(0, np.int64)
    bounds = pa.array(np.append(head, len(segment)), pa.int32())
    return pa.RecordBatch.from_arrays(
        [pa.array([segment_id(texts[i]) for i in segment[head]], pa.binary()), pa.ListArray.from_arrays(bounds, pa.array(offset, pa.int32())), pa.ListArray.from_arrays(bounds, pa.array(minimum, pa.int64()))], names=["id", "offs", "mins"]
    )


def _shards(segments: DataFrame, window: int) -> DataFrame:
    """The windows of each segment that an earlier document has, from one FM-index per shard."""

    def run(batches):
        held: dict[bytes, list[int]] = {}
        words, last = 0, None

        def close():
            low, high = np.array(list(held.values())).T
            out = _search(list(held), low, high, window)
            held.clear()
            return out

        for batch in batches:
            anchors = batch.column(0).to_pylist()
            for anchor, text, low, high in zip(anchors, *(batch.column(i).to_pylist() for i in range(1, 4)), strict=True):
                if anchor != last:  # only between anchors may a shard end
                    if words >= SHARD_WORDS:
                        yield close()
                        words = 0
                    last = anchor
                have = held.get(text)
                if have is None:
                    held[text] = [low, high]
                    words += text.count(b" ") + 2
                else:
                    have[0], have[1] = min(have[0], low), max(have[1], high)
        if held:
            yield close()

    return segments.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, _EARLIER)


def _cuts(docs: DataFrame, window: int, hot: Sequence[Broadcast], expected: int, layout: dict[str, int]) -> list[Cut]:
    """A cut for each part of the filter of repeated anchors."""
    unfiltered = Cut(window, hot)

    def anchors(batch: pa.RecordBatch):
        here = unfiltered.open()
        for block in blocks(batch.column(0)):
            yield here.segments(block).anchors_once_a_doc()

    sizes = {k: layout[k] for k in ("bits_per_hash", "slice_hashes") if k in layout}
    repeated = bloom.repeats(docs.select("text"), anchors, expected, **sizes)
    found = bloom.filters(repeated, **{k: layout[k] for k in ("bits_per_hash", "filter_bytes", "page_bits") if k in layout})
    frames.forget(docs.sparkSession, repeated)
    return [Cut(window, hot, f) for f in found]


def _union(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def earlier_windows(docs: DataFrame, window: int, hot_rows: int, **layout: int) -> DataFrame | None:
    """doc_id, digest, starts: the words at which windows start that a smaller doc_id has, as lists of lists; None: there are none."""
    spark = docs.sparkSession
    expected = bloom.text_bytes(docs) // BYTES_PER_ANCHOR + 1
    hot: list[Broadcast] = []
    while True:
        cuts = _cuts(docs, window, hot, expected, layout)
        if not cuts:
            return None
        segments = frames.written(_union([_segment_rows(docs, cut) for cut in cuts]), "segments")
        if len(hot) == 2:  # windows of hot anchors are their own anchors now
            break
        many = segments.groupBy("anchor").agg(F.count("*").alias("n")).filter(F.col("n") > hot_rows).select(F.col("anchor").alias("hash"))
        many = frames.written(many, "hot-anchors")
        found = bloom.filters(many, filter_bytes=1 << 40)  # two bytes for each, of which there are fewer than segments / hot_rows
        frames.forget(spark, many)
        if not found:
            break
        frames.forget(spark, segments)
        hot += found
    found = frames.written(_shards(segments, window), "earlier")
    frames.forget(spark, segments)
    joined = _union([_place_rows(docs, cut) for cut in cuts]).join(found, "id")
    mine = F.filter(F.arrays_zip("offs", "mins"), lambda x: x["mins"] < F.col("doc_id"))
    joined = joined.select("doc_id", "digest", F.transform(mine, lambda x: x["offs"] + F.col("start")).alias("at")).filter(F.size("at") > 0)
    return joined.groupBy("doc_id", "digest").agg(F.collect_list("at").alias("_starts"))


def dedup_substrings(docs: DataFrame, window: int = WINDOW, hot_rows: int = HOT_ROWS, broadcast_keys: int = BROADCAST_KEYS, **layout: int) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text (kept words joined by one blank) and kept_sha256 of each row.

    Words are taken as they stand.  Null or empty texts have none.  A row with
    a null doc_id comes neither before nor after others: it loses nothing and
    takes nothing.  Rows that repeat an id are one document where windows are
    compared (neither is smaller) and come back each.  Other columns are not
    looked at.  ``layout`` overrides the sizes of :mod:`bloom`, for tests.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("digest"))
    starts = earlier_windows(rows.filter("doc_id is not null"), window, hot_rows, **layout)
    none = F.lit(None).cast("array<array<int>>").alias("_starts")
    if starts is None:
        return _kept(rows.select("*", none), window)
    starts = frames.written(starts, "window-starts")
    if starts.count() > broadcast_keys:
        return _kept(rows.join(starts, ["doc_id", "digest"], "left"), window)
    keys = F.broadcast(starts.select("doc_id", "digest"))  # at most broadcast_keys
    losing = rows.join(keys, ["doc_id", "digest"], "left_semi").join(starts, ["doc_id", "digest"])
    whole = rows.join(keys, ["doc_id", "digest"], "left_anti").select("*", none)
    return _kept(whole, window).unionByName(_kept(losing, window))


def _kept(rows: DataFrame, window: int) -> DataFrame:
    """The output rows of documents (doc_id, text, _starts)."""
    fields = [("n_words", T.LongType()), ("n_removed", T.LongType()), ("kept_text", T.StringType()), ("kept_sha256", T.StringType())]

    def run(batch: pa.RecordBatch) -> dict:
        lists = batch.column(batch.schema.get_field_index("_starts"))
        n_words, n_removed, kept = [], [], []
        for block in blocks(batch.column(batch.schema.get_field_index("text"))):
            joined, begin, end, docs = block.joined(block.data)
            head = np.searchsorted(docs, np.arange(block.docs + 1))
            data = joined.tobytes()
            for d in range(block.docs):
                a, b = int(head[d]), int(head[d + 1])
                n_words.append(b - a)
                row = lists[block.first + d]
                if not row.is_valid:
                    n_removed.append(0)
                    kept.append(data[begin[a] : end[b - 1]] if b > a else b"")
                    continue
                gone = covered(row.values.flatten().to_numpy(zero_copy_only=False), window, b - a)
                n_removed.append(int(gone.sum()))
                edge = np.flatnonzero(np.diff(np.concatenate(([0], (~gone).view(np.int8), [0]))))
                kept.append(b" ".join(data[begin[a + s] : end[a + e - 1]] for s, e in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)))
        return {"n_words": n_words, "n_removed": n_removed, "kept_text": pa.array(kept, pa.binary()).cast(pa.string()), "kept_sha256": [hashlib.sha256(k).hexdigest() for k in kept]}

    return frames.map_batches(rows, fields, run, keep=["doc_id"])
