"""Line dedup with two Bloom filters.

A first pass over the documents sends hashes of line keys to the once-seen
filter; those that it has already make the twice-seen filter (:mod:`bloom`).
A second pass looks every line up in that; only the suspected repeats are
shuffled, as key texts with counts that each task has already summed, and
confirmed by exact text; there too the first document is chosen.  A third pass
drops the confirmed lines.

The filters are laid out for the input.  Too small ones make more suspects and
a larger shuffle, never another result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillon.llm import bloom, frames
from quillon.llm.text_blocks import Block, blocks

#: Confirmed keys up to this many bytes in all go to every executor; beyond that they are joined.
BROADCAST_BYTES = 32 << 20
#: UTF-8 bytes of text for each line key that the filters are laid out for.
BYTES_PER_KEY = 32

_COUNTS = T.StructType([T.StructField("key", T.BinaryType()), T.StructField("words", T.BinaryType()), T.StructField("n", T.LongType()), T.StructField("first_doc", T.LongType())])
_DIGEST = "__quillon_digest"


class _Lines:
    """The lines of a block with their keys: ends stripped of white space, A-Z lower-cased."""

    def __init__(self, block: Block) -> None:
        self.block, self.low = block, block.lowered()
        self.starts, self.ends, self.docs = block.lines()
        word_starts, word_ends, _ = block.words()
        first, past = np.searchsorted(word_starts, self.starts), np.searchsorted(word_starts, self.ends)
        self.keyed = np.flatnonzero(past > first)
        self.key_starts, self.key_ends = word_starts[first[self.keyed]], word_ends[past[self.keyed] - 1]
        self.hashes = block.hashes(self.key_starts, self.key_ends, self.low)

    def key(self, k: int) -> bytes:
        return self.low[self.key_starts[k] : self.key_ends[k]].tobytes()

    def once_a_doc(self) -> np.ndarray:
        """Of the keyed lines, one for each document and hash, in document order."""
        order = np.lexsort((self.hashes, self.docs[self.keyed]))
        h, d = self.hashes[order], self.docs[self.keyed][order]
        new = np.ones(len(order), bool)
        new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
        return np.sort(order[new])

    def digests(self) -> list[bytes]:
        """A digest of the words of each document, alike for texts that differ in white space or case of A-Z only."""
        joined, starts, ends, docs = self.block.joined(self.low)
        cuts = np.searchsorted(docs, np.arange(self.block.docs + 1)).tolist()
        return [_words_digest(joined[starts[a] : ends[b - 1]] if b > a else b"") for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def without(self, gone: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Data and offsets of the texts without the flagged lines; the lines left stay joined by \\n."""
        left = np.flatnonzero(~gone)
        later = np.zeros(len(left), bool)  # not the first line left of its document: the break before it stays too
        later[1:] = self.docs[left[1:]] == self.docs[left[:-1]]
        step = np.zeros(len(self.block.data) + 1, np.int32)
        np.add.at(step, self.starts[left] - later, 1)
        np.add.at(step, self.ends[left], -1)
        keep = np.cumsum(step[:-1]) > 0
        return self.block.data[keep], np.concatenate(([0], np.cumsum(self.block.per_doc(keep))))


def _words_digest(words) -> bytes:
    return hashlib.blake2b(words, digest_size=16).digest()


def _key_hashes_of(batch: pa.RecordBatch):
    for block in blocks(batch.column(0)):
        lines = _Lines(block)
        yield lines.hashes[lines.once_a_doc()]


def repeated_keys(docs: DataFrame, min_docs: int, copies_once: bool = False, **layout: int) -> tuple[DataFrame, list[Broadcast]]:
    """Line keys found in at least ``min_docs`` >= 2 documents, and the filters that hold them all.

    The table has key, n, first_doc (the smallest doc_id with the line) and
    first_words (with ``copies_once``: the digest of that document's words).
    ``copies_once`` counts documents of the same words as one.
    """
    expected = bloom.text_bytes(docs) // BYTES_PER_KEY + 1
    sizes = {k: layout[k] for k in ("bits_per_hash", "slice_hashes") if k in layout}
    suspected = bloom.repeats(docs.select("text"), _key_hashes_of, expected, **sizes)
    filters = bloom.filters(suspected, **{k: layout[k] for k in ("bits_per_hash", "filter_bytes", "page_bits") if k in layout})

    def suspects(shared: Broadcast):
        def run(batches):
            repeated = bloom.Filter(shared.value)
            for batch in frames.pieces(batches):
                counts: dict[tuple[bytes, bytes | None], list[int | None]] = {}
                ids = batch.column(1).to_pylist()
                for block in blocks(batch.column(0)):
                    lines = _Lines(block)
                    at = lines.once_a_doc()
                    at = at[repeated.contains(lines.hashes[at])]
                    words = lines.digests() if copies_once and len(at) else [None] * block.docs
                    for k in at:
                        place = lines.docs[lines.keyed[k]]
                        doc = ids[block.first + place]
                        have = counts.setdefault((lines.key(k), words[place]), [0, None])
                        have[0] += 1
                        have[1] = doc if have[1] is None else have[1] if doc is None else min(have[1], doc)
                if counts:
                    columns = ([k for k, _ in counts], [w for _, w in counts], [x[0] for x in counts.values()], [x[1] for x in counts.values()])
                    yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, (pa.binary(), pa.binary(), pa.int64(), pa.int64()), strict=True)], names=_COUNTS.names)

        return docs.select("text", F.col("doc_id").cast("long")).mapInArrow(run, _COUNTS)

    found = _union([suspects(shared) for shared in filters]) or docs.sparkSession.createDataFrame([], _COUNTS)
    if copies_once:  # copies meet by key and words, so a line that very many texts have is no large group
        found = found.groupBy("key", "words").agg(F.lit(1).cast("long").alias("n"), F.min("first_doc").alias("first_doc"))
    first = F.min(F.when(F.col("first_doc").isNotNull(), F.struct("first_doc", "words")))
    counted = found.groupBy("key").agg(F.sum("n").alias("n"), first.alias("first")).filter(F.col("n") >= min_docs)
    return counted.select("key", "n", "first.first_doc", F.col("first.words").alias("first_words")), filters


def _union(tables: list[DataFrame]) -> DataFrame | None:
    out = None
    for t in tables:
        out = t if out is None else out.unionByName(t)
    return out


def dedup_lines(docs: DataFrame, min_docs: int = 10, keep: str = "none", broadcast_bytes: int = BROADCAST_BYTES, copies_once: bool = False, **layout: int) -> DataFrame:
    """Drop lines whose key stands in at least ``min_docs`` documents.

    ``keep='none'`` drops all of them; ``keep='first'`` leaves the first such
    line of the document with the smallest doc_id.  Returns all columns of
    ``docs`` with the new ``text``, and n_lines (before) and n_dropped.

    Null or empty text is one empty line and comes back as it was (null stays
    null).  Lines of white space only have no key and stay.  Repeated rows are
    documents of their own: each counts, unless ``copies_once`` counts all
    documents of the same words (case of A-Z aside) as one; then 'first' means
    all of those that have the words of the first.  A null doc_id is never the
    first.  Input columns named n_lines or n_dropped are replaced; others are
    carried.  ``layout`` overrides the sizes of :mod:`bloom`, for tests.
    """
    if min_docs < 2 or keep not in ("none", "first"):
        raise ValueError("min_docs must be at least 2, keep 'none' or 'first'")
    spark = docs.sparkSession
    keys, filters = repeated_keys(docs, min_docs, copies_once, **layout)
    keys = frames.written(keys, "line-keys")
    size = keys.agg(F.sum(F.length("key") + 80)).first()[0] or 0
    keep_first = keep == "first"
    fields = [("text", T.StringType()), ("n_lines", T.LongType()), ("n_dropped", T.LongType())]

    def rewrite(batch: pa.RecordBatch, drop_of) -> dict:
        column = batch.column(batch.schema.get_field_index("text"))
        ids = batch.column(batch.schema.get_field_index("doc_id")).to_pylist()
        n_lines, n_dropped, texts = [], [], []
        for block in blocks(column):
            lines = _Lines(block)
            gone = np.zeros(len(lines.starts), bool)
            kept_first: set[tuple[int, bytes]] = set()
            words: list[bytes] | None = None
            for k in drop_of.candidates(lines):
                line = int(lines.keyed[k])
                doc, key = int(lines.docs[line]), lines.key(k)
                if not drop_of.has(block.first + doc, key):
                    continue
                if keep_first and (doc, key) not in kept_first:
                    first_doc, first_words = drop_of.first[key]
                    if copies_once:
                        words = lines.digests() if words is None else words
                        mine = first_words is not None and words[doc] == first_words
                    else:
                        mine = first_doc is not None and first_doc == ids[block.first + doc]
                    if mine:
                        kept_first.add((doc, key))
                        continue
                gone[line] = True
            n_lines.append(np.bincount(lines.docs, minlength=block.docs))
            n_dropped.append(np.bincount(lines.docs[gone], minlength=block.docs))
            data, off = lines.without(gone) if gone.any() else (block.data, block.off)
            texts.append(pa.LargeStringArray.from_buffers(block.docs, pa.py_buffer(np.ascontiguousarray(off, np.int64)), pa.py_buffer(np.ascontiguousarray(data))))
        text = pa.concat_arrays(texts).cast(pa.string())
        if column.null_count:
            text = pc.if_else(column.is_valid(), text, pa.scalar(None, pa.string()))
        return {"text": text, "n_lines": np.concatenate(n_lines), "n_dropped": np.concatenate(n_dropped)}

    if size <= broadcast_bytes:
        rows = keys.select("key", "first_doc", "first_words").collect()
        table = spark.sparkContext.broadcast({bytes(r["key"]): (r["first_doc"], r["first_words"] and bytes(r["first_words"])) for r in rows})
        drop = _Everywhere(table)
        return frames.map_batches(docs, fields, lambda batch: rewrite(batch, drop), keep=docs.columns)
    # The keys of each distinct text meet by join; equal texts lose equal keys, so copies are looked up once.
    marked = docs.withColumn(_DIGEST, F.sha2(F.coalesce("text", F.lit("")), 256))

    def pairs(shared: Broadcast):
        def run(batches):
            repeated = bloom.Filter(shared.value)
            for batch in frames.pieces(batches):
                digests, keyed = [], []
                names = batch.column(1).to_pylist()
                for block in blocks(batch.column(0)):
                    lines = _Lines(block)
                    at = lines.once_a_doc()
                    for k in at[repeated.contains(lines.hashes[at])]:
                        digests.append(names[block.first + lines.docs[lines.keyed[k]]])
                        keyed.append(lines.key(k))
                if keyed:
                    yield pa.RecordBatch.from_arrays([pa.array(digests, pa.string()), pa.array(keyed, pa.binary())], names=[_DIGEST, "key"])

        return marked.select("text", _DIGEST).mapInArrow(run, f"{_DIGEST} string, key binary")

    held = _union([pairs(shared) for shared in filters]).distinct()
    drops = F.collect_list(F.struct("key", "first_doc", "first_words"))
    per_text = held.join(keys, "key").groupBy(_DIGEST).agg(drops.alias("__quillon_drop"))
    joined = marked.join(per_text, _DIGEST, "left")
    return frames.map_batches(joined, fields, lambda batch: rewrite(batch, _OwnColumn(batch)), keep=docs.columns)


class _Everywhere:
    """One table of dropped keys for all documents."""

    def __init__(self, table) -> None:
        self.table, self._hashes = table, None

    def __getstate__(self):
        return {"table": self.table, "_hashes": None}

    @property
    def first(self) -> dict:
        return self.table.value

    def candidates(self, lines: _Lines) -> np.ndarray:
        if self._hashes is None:
            self._hashes = np.sort(_key_hashes(list(self.first)))
        if not len(self._hashes):
            return np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self._hashes, lines.hashes), len(self._hashes) - 1)
        return np.flatnonzero(self._hashes[at] == lines.hashes)

    def has(self, doc: int, key: bytes) -> bool:
        return key in self.first


class _OwnColumn:
    """Dropped keys that come with each row."""

    def __init__(self, batch: pa.RecordBatch) -> None:
        rows = batch.column(batch.schema.get_field_index("__quillon_drop")).to_pylist()
        self.rows = [{bytes(x["key"]) for x in row or ()} for row in rows]
        self.first = {bytes(x["key"]): (x["first_doc"], x["first_words"] and bytes(x["first_words"])) for row in rows for x in row or ()}

    def candidates(self, lines: _Lines) -> np.ndarray:
        return np.flatnonzero(np.isin(lines.hashes, _key_hashes(list(self.first))))

    def has(self, doc: int, key: bytes) -> bool:
        return key in self.rows[doc]


def _key_hashes(keys: list[bytes]) -> np.ndarray:
    sizes = np.array([len(k) for k in keys], np.int64)
    ends = np.cumsum(sizes)
    data = np.frombuffer(b"".join(keys), np.uint8)
    return Block(0, data, np.array([0, len(data)])).hashes(ends - sizes, ends) if keys else np.zeros(0, np.uint64)
