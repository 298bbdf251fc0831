"""Benchmark decontamination by greedy string tiling.

Documents and test items are token sequences (runs of letters, digits and
bytes over 127; A-Z lower-cased).  A document is a candidate for an item when
they share enough seeds, runs of ``tile`` tokens.  For a candidate the longest
common run of unmarked tokens is marked again and again, until none of at
least ``tile`` tokens is left; runs of a length are found by Karp-Rabin hashes
and confirmed token by token.  The share of the item that the tiles cover, in
whatever order they stand, decides.  An item of fewer than ``tile`` tokens is
its own seed and one tile: it is found where it stands whole.

One pass reads the documents, whatever the size of the benchmark: a Bloom
filter of all seeds tells the runs of tokens that could matter, and only these
runs move on.  Seeds meet by join, and a task tiles one document's runs with
one item after the other.
"""

from __future__ import annotations

from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.llm import bloom, frames
from quillon.llm.text_blocks import Block, blocks, covered, mix64, windows

TILE, COVERAGE = 5, 0.5
#: Digests of contaminated texts that are broadcast to drop them, at most; more are joined.
BROADCAST_ROWS = 500_000
_TOKEN = np.zeros(256, bool)
_TOKEN[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_BASE = 0x9E3779B97F4A7C15

_ITEMS = "item long, item_id long, tokens string, n int, tile int, seeds array<long>"
_RUNS = "doc_id long, digest binary, part int, starts array<int>, runs array<string>, seeds array<long>"
_FOUND = "digest binary, item_id long, item_tokens long, covered_tokens long, n_tiles long, coverage double"


class Tokens:
    """The tokens of a block, their hashes and documents."""

    def __init__(self, block: Block) -> None:
        self.low = block.lowered()
        marked = Block(block.first, np.where(_TOKEN[self.low], self.low, np.uint8(32)), block.off)
        self.starts, self.ends, self.docs = marked.words()
        self.hashes = marked.hashes(self.starts, self.ends)
        self.first = np.searchsorted(self.docs, np.arange(block.docs + 1))

    def text(self, a: int, b: int) -> str:
        """Tokens a to b - 1, joined by blanks."""
        return b" ".join(self.low[s:e].tobytes() for s, e in zip(self.starts[a:b], self.ends[a:b], strict=True)).decode()


def _items(benchmark: DataFrame, tile: int) -> DataFrame:
    """A written table of the test items with tokens: key, item_id, tokens, their number, tile and seeds."""

    def run(batches):
        for batch in frames.pieces(batches):
            keys, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            rows = []
            for block in blocks(batch.column(2)):
                t = Tokens(block)
                for d, (a, b) in enumerate(pairwise(t.first.tolist())):
                    if a < b:
                        own = min(tile, b - a)
                        seeds = windows(t.hashes[a:b], t.docs[a:b], own)[1]
                        rows.append((keys[block.first + d], ids[block.first + d], t.text(a, b), b - a, own, seeds.view(np.int64)))
            if rows:
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=[c.split()[0] for c in _ITEMS.split(", ")])

    rows = benchmark.select(F.monotonically_increasing_id().alias("item"), F.col("item_id").cast("long"), "text")
    return frames.written(rows.mapInArrow(run, _ITEMS), "items")


def _digest():
    return F.unhex(F.md5(F.coalesce("text", F.lit(""))))


def _runs(docs: DataFrame, shared: Broadcast, part: int, lengths: list[int]) -> DataFrame:
    """Of each document with a seed in the filter, the runs of tokens that such seeds cover, and the seeds."""

    def run(batches):
        seeds = bloom.Filter(shared.value)
        for batch in frames.pieces(batches):
            ids, digests, rows = batch.column(0), batch.column(1), []
            for block in blocks(batch.column(2)):
                t = Tokens(block)
                mine, hits = np.zeros(len(t.starts), bool), []
                for n in lengths:
                    at, h = windows(t.hashes, t.docs, n)
                    found = seeds.contains(h)
                    mine |= covered(at[found], n, len(t.starts))
                    hits.append((t.docs[at[found]], h[found]))
                if not mine.any():
                    continue
                doc, h = (np.concatenate(x) for x in zip(*hits, strict=True))
                edge = mine[1:] != mine[:-1]
                edge |= t.docs[1:] != t.docs[:-1]
                cuts = np.concatenate(([0], np.flatnonzero(edge) + 1, [len(mine)]))
                begin, end = cuts[:-1][mine[cuts[:-1]]], cuts[1:][mine[cuts[:-1]]]
                owner = t.docs[begin]
                for d in np.unique(owner).tolist():
                    own = owner == d
                    runs = [t.text(a, b) for a, b in zip(begin[own].tolist(), end[own].tolist(), strict=True)]
                    rows.append((ids[block.first + d].as_py(), digests[block.first + d].as_py(), part, begin[own] - t.first[d], runs, np.unique(h[doc == d]).view(np.int64)))
            if rows:
                kinds = (pa.int64(), pa.binary(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.string()), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=[c.split()[0] for c in _RUNS.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), _digest().alias("digest"), "text").mapInArrow(run, _RUNS)


class _Sequence:
    """Numbered tokens (below zero: matches nothing), which of them are free, and Karp-Rabin hashes of their runs."""

    def __init__(self, tokens: np.ndarray) -> None:
        self.tokens, self.free = tokens, tokens >= 0
        n = len(tokens)
        self.back = np.full(n + 1, pow(_BASE, -1, 1 << 64), np.uint64)
        up = np.full(n + 1, _BASE, np.uint64)
        self.back[0] = up[0] = 1
        up, self.back = np.multiply.accumulate(up), np.multiply.accumulate(self.back)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(mix64(tokens.astype(np.uint64)) * up[:-1], out=self.sums[1:])
        self.measure()

    def measure(self) -> None:
        """How many free tokens stand in a row from each place on."""
        blocked = np.where(self.free, len(self.free), np.arange(len(self.free)))
        self.room = np.minimum.accumulate(blocked[::-1])[::-1] - np.arange(len(self.free))

    def runs(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the free runs of ``n`` tokens, and their hashes."""
        at = np.flatnonzero(self.room >= n)
        return at, (self.sums[at + n] - self.sums[at]) * self.back[at]


def tiles(doc: np.ndarray, item: np.ndarray, tile: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling of two sequences of token numbers: (place in doc, place in item, length).

    Longest first; of equal lengths the one that stands first in the document,
    then in the item.  The length of the longest common run left is found by
    bisection, so time grows with the sequences times the lengths that occur,
    and memory with the sequences, however often runs repeat.
    """
    if not len(doc) or not len(item):
        return []
    d, i = _Sequence(doc), _Sequence(item)
    out: list[tuple[int, int, int]] = []
    most = int(min(d.room.max(), i.room.max()))
    while most >= tile:
        low, high = tile - 1, most  # a common run of `low` tokens is known, or low < tile
        while low < high:
            n = (low + high + 1) // 2
            if np.isin(d.runs(n)[1], i.runs(n)[1]).any():
                low = n
            else:
                high = n - 1
        if low < tile:
            break
        (p, hp), (q, hq) = d.runs(low), i.runs(low)
        places: dict[int, list[int]] = {}
        for place, h in zip(q[::-1].tolist(), hq[::-1].tolist(), strict=True):
            places.setdefault(h, []).append(place)  # the first place is the last of its list
        met, past = np.isin(hp, hq), 0
        for a, h in zip(p[met].tolist(), hp[met].tolist(), strict=True):
            if not places:
                break
            if a < past or h not in places:
                continue
            left = places[h]
            while left and not i.free[left[-1] : left[-1] + low].all():
                left.pop()
            if not left:
                del places[h]
                continue
            b = left[-1]
            if (doc[a : a + low] == item[b : b + low]).all():
                out.append((a, b, low))
                d.free[a : a + low] = i.free[b : b + low] = False
                past = a + low
        d.measure()
        i.measure()
        most = min(low - 1, int(min(d.room.max(), i.room.max())))
    return out


def _numbered(starts: list[int], runs: list[str], number: dict[str, int]) -> np.ndarray:
    """The tokens of a document's runs by number, -1 where an item has no such token and between runs that do not touch."""
    token: dict[int, int] = {}
    for start, text in zip(starts, runs, strict=True):
        for k, word in enumerate(text.split(" ")):
            token[start + k] = number.get(word, -1)
    out, last = [], None
    for place in sorted(token):
        if last is not None and place != last + 1:
            out.append(-1)
        out.append(token[place])
        last = place
    return np.array(out, np.int64)


def _tile(rows: DataFrame, coverage: float) -> DataFrame:
    """Tiles for sorted rows (digest, item_id, tokens, tile, starts, runs): the runs of a text, then its candidates."""

    def run(batches):
        at, starts, runs = None, [], []
        for batch in batches:
            found = []
            for r in frames.rows(batch):
                if r["runs"] is not None:
                    at, starts, runs = r["digest"], r["starts"], r["runs"]
                elif r["digest"] == at:
                    words = r["tokens"].split(" ")
                    number: dict[str, int] = {}
                    item = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
                    placed = tiles(_numbered(starts, runs, number), item, r["tile"])
                    n, share = len(words), sum(x[2] for x in placed)
                    if share >= coverage * n:
                        found.append((at, r["item_id"], n, share, len(placed), share / n))
            if found:
                kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)], names=[c.split()[0] for c in _FOUND.split(", ")])

    return rows.repartition("digest").sortWithinPartitions("digest", F.col("runs").isNull()).mapInArrow(run, _FOUND)


def _matches(docs: DataFrame, benchmark: DataFrame, tile: int, coverage: float, filter_bytes: int) -> tuple[DataFrame, DataFrame] | None:
    """Rows of documents, those with seeds at least (doc_id, digest), and what is found in each text; None for an empty benchmark."""
    items = _items(benchmark, tile)
    seeds = items.select("item", "n", "tile", F.explode("seeds").alias("seed"))
    parts = bloom.filters(seeds.select(F.col("seed").alias("hash")), filter_bytes=filter_bytes)
    if not parts:
        return None
    lengths = [r["tile"] for r in items.select("tile").distinct().orderBy("tile").collect()]  # 1 to `tile`
    hits = None
    for k, shared in enumerate(parts):
        found = _runs(docs, shared, k, lengths)
        hits = found if hits is None else hits.unionByName(found)
    hits = frames.written(hits, "runs")
    # Copies of a text are tiled once.
    texts = hits.groupBy("digest", "part").agg(F.first(F.struct("starts", "runs", "seeds")).alias("t")).select("digest", "t.*")
    if len(parts) > 1:
        texts = texts.groupBy("digest").agg(*[F.flatten(F.collect_list(c)).alias(c) for c in ("starts", "runs", "seeds")])
    texts = frames.written(texts, "texts")
    # Tiles of at least `tile` tokens that cover c tokens hold c / tile seeds of the item or more.
    pairs = texts.select("digest", F.explode("seeds").alias("seed")).join(seeds, "seed").groupBy("digest", "item").agg(F.count("*").alias("shared"), F.first("n").alias("n"), F.first("tile").alias("tile"))
    pairs = pairs.filter(F.col("shared") * F.col("tile") >= F.lit(coverage) * F.col("n")).select("digest", "item")
    void = lambda kind, name: F.lit(None).cast(kind).alias(name)
    candidates = pairs.join(items.select("item", "item_id", "tokens", "tile"), "item").select("digest", "item_id", "tokens", "tile", void("array<int>", "starts"), void("array<string>", "runs"))
    whole = texts.select("digest", void("long", "item_id"), void("string", "tokens"), void("int", "tile"), "starts", "runs")
    found = frames.written(_tile(whole.unionByName(candidates), coverage), "tiled")
    if len(parts) == 1:  # every row of a document with seeds is there once
        return hits.select("doc_id", "digest"), found
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), _digest().alias("digest")), found


def contaminated(docs: DataFrame, benchmark: DataFrame, tile: int = TILE, coverage: float = COVERAGE, filter_bytes: int = bloom.FILTER_BYTES) -> DataFrame:
    """One row for each document and test item whose tiles cover at least ``coverage`` > 0 of the item.

    doc_id, item_id, item_tokens, covered_tokens, n_tiles, coverage.  Null or
    empty texts match nothing; items of fewer than ``tile`` tokens match where
    they stand whole.  Repeated rows, of documents and of items, are reported
    each; an empty benchmark finds nothing; other columns are not looked at.
    """
    made = _matches(docs, benchmark, tile, coverage, filter_bytes)
    columns = ["doc_id", *[c.split()[0] for c in _FOUND.split(", ")][1:]]
    if made is None:
        spark = docs.sparkSession
        return spark.createDataFrame([], "doc_id long, " + _FOUND.split(", ", 1)[1]).select(columns)
    rows, found = made
    return rows.join(found, "digest").select(columns)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, tile: int = TILE, coverage: float = COVERAGE, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """The documents that :func:`contaminated` does not report, with their own columns as they are."""
    made = _matches(docs, benchmark, tile, coverage, bloom.FILTER_BYTES)
    if made is None:
        return docs
    texts = frames.written(made[1].select(F.col("digest").alias("__quillon_digest")).distinct(), "contaminated")
    few = texts.count() <= broadcast_rows
    marked = docs.withColumn("__quillon_digest", _digest())
    return marked.join(F.broadcast(texts) if few else texts, "__quillon_digest", "left_anti").select(docs.columns)
