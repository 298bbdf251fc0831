"""SimHash near-dedup with pivot distance tables.

Fingerprints that could be close meet in buckets.  Inside a bucket each
fingerprint's Hamming distances to fixed reference fingerprints (pivots) are
tabulated; by the triangle inequality two fingerprints whose distances to any
pivot differ by more than the limit cannot be close, so such pairs are
discarded by their largest coordinate difference and only survivors are
compared.  A bucket hands on a spanning forest of its links, not all links.

Buckets: for 64-bit fingerprints every choice of agreeing blocks, which loses
no pair (``blocks`` - ``agree`` blocks may differ); for wide fingerprints, whose
limit is too large for blocks, bands of word-shingle minima, which find a pair
of similarity 0.8 with probability 0.99997.

Near-dedup by similarity works alike: in the bands' buckets pairs are discarded
by pivot distances and by the fingerprints' own distance, within a limit that
pairs of that similarity keep to; each link left is confirmed by the exact
Jaccard similarity of the two shingle sets.

A bucket too large for a task is dealt into tiles.  In a first round each tile
is looked at alone; tiles differ from bucket to bucket, so what belongs
together mostly joins up there.  In a second round tiles of the same bucket
meet, but the largest component of a bucket is not held against itself: a
large group of near copies costs its size, not its square.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillon.llm import frames
from quillon.llm.components import components
from quillon.llm.text_blocks import Block, blocks, mix64

#: Rows of a bucket compared in one task; larger buckets are cut into tiles.
TILE_ROWS = 8192
#: Shingles of a bucket compared in one task where links are confirmed; tiles likewise.
TILE_SHINGLES = 1 << 21
#: Rows (id and hash) that are broadcast to pick documents, at most; more are joined.
BROADCAST_ROWS = 1_000_000
PIVOTS = 24
BANDS, BAND_ROWS = 20, 4
#: Shingles whose bits are counted together.
_CHUNK = 1 << 15


def shingle_hashes(block: Block, words: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 (seed 42) of every shingle of ``words`` words, repeats included, and how many each document has.

    A document with fewer words has one shingle, its whole sequence; one without words has none.
    """
    joined, starts, ends, docs = block.joined(block.lowered())
    data = memoryview(joined)
    n = np.bincount(docs, minlength=block.docs)
    count = np.where(n >= words, n - words + 1, np.minimum(n, 1))
    first_word = np.concatenate(([0], np.cumsum(n)))[:-1]
    begin = np.repeat(first_word - np.concatenate(([0], np.cumsum(count)))[:-1], count) + np.arange(count.sum())
    last = np.minimum(begin + words, np.repeat(first_word + n, count)) - 1
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[begin].tolist(), ends[last].tolist(), strict=True)
    return np.fromiter((digest(data[a:b], 42) for a, b in spans), np.uint64, len(begin)), count


def majority_bits(hashes: np.ndarray, count: np.ndarray) -> np.ndarray:
    """For each document one 64-bit word: bit set if set in over half of its hashes; zero without hashes."""
    sums = np.zeros((len(count), 64), np.int64)
    doc = np.repeat(np.arange(len(count)), count)
    for i in range(0, len(hashes), _CHUNK):
        part = hashes[i : i + _CHUNK]
        bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        at = doc[i : i + _CHUNK]
        edge = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        sums[at[edge]] += np.add.reduceat(bits, edge, axis=0, dtype=np.int32)
    return np.packbits(2 * sums > count[:, None], axis=1, bitorder="little").view("<u8").ravel().astype(np.uint64)


_BAND_SEEDS = mix64(np.arange(1, BANDS * BAND_ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def band_keys(hashes: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Band keys of minima of the shingle hashes under BANDS * BAND_ROWS mixings: (documents, BANDS)."""
    out = np.zeros((len(count), BANDS), np.uint64)
    full = np.flatnonzero(count)
    if len(full):
        edge = np.concatenate(([0], np.cumsum(count[full])))[:-1]
        for k, seed in enumerate(_BAND_SEEDS):
            mixed = hashes * seed
            mixed ^= mixed >> np.uint64(29)
            mixed *= np.uint64(0xD6E8FEB86659FD93)
            out[full, k // BAND_ROWS] = mix64(out[full, k // BAND_ROWS] * np.uint64(31) + np.minimum.reduceat(mixed, edge))
    return out ^ mix64(np.arange(1, BANDS + 1, dtype=np.uint64))


def block_keys(fp: np.ndarray, n_blocks: int, agree: int) -> np.ndarray:
    """One key for every choice of ``agree`` out of ``n_blocks`` bit blocks: (fingerprints, choices)."""
    cuts = np.linspace(0, 64, n_blocks + 1).astype(int)
    masks = [((1 << int(b)) - 1) ^ ((1 << int(a)) - 1) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    chosen = [sum(c) for c in combinations(masks, agree)]
    return np.stack([mix64(mix64(fp & np.uint64(m)) + np.uint64(k)) for k, m in enumerate(chosen)], axis=1)


def shingle_sets(hashes: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each document in ascending order, and how many each has."""
    doc = np.repeat(np.arange(len(count)), count)
    order = np.lexsort((hashes, doc))
    h, d = hashes[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    return h[new], np.bincount(d[new], minlength=len(count))


def fingerprints(docs: DataFrame, words: int, lanes: int, n_blocks: int = 5, agree: int = 2, keep: tuple[str, ...] = (), sets: bool = False) -> DataFrame:
    """doc_id, the columns of ``keep``, fp (array of ``lanes`` longs, 64 bits each) and bucket keys of each document.

    One lane: XXH64 itself, block keys.  More lanes: the hash mixed anew for each lane, band keys.
    ``sets`` takes each shingle once and adds digest and size of the shingle set.
    """

    def run(batch: pa.RecordBatch) -> dict:
        fps, keys, digests, sizes = [], [], [], []
        for block in blocks(batch.column(batch.schema.get_field_index("text"))):
            hashes, count = shingle_hashes(block, words)
            if sets:
                distinct, size = shingle_sets(hashes, count)
                cuts = np.concatenate(([0], np.cumsum(size))).tolist()
                digests += [hashlib.blake2b(distinct[a:b], digest_size=16).digest() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                sizes.append(size)
                hashes, count = distinct, size
            lane = [majority_bits(hashes if k == 0 else mix64(hashes + np.uint64(k)), count) for k in range(lanes)]
            fps.append(np.stack(lane, axis=1))
            keys.append(block_keys(lane[0], n_blocks, agree) if lanes == 1 else band_keys(hashes, count))
        out = {"fp": _lists(np.concatenate(fps)), "keys": _lists(np.concatenate(keys))}
        return out | {"digest": digests, "size": np.concatenate(sizes)} if sets else out

    long = T.ArrayType(T.LongType(), False)
    fields = [("fp", long), ("keys", long)] + ([("digest", T.BinaryType()), ("size", T.LongType())] if sets else [])
    return frames.map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *keep), fields, run, keep=["doc_id", *keep])


def _lists(x: np.ndarray) -> pa.Array:
    flat = pa.array(np.ascontiguousarray(x).view(np.int64).ravel())
    return pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1]), pa.int32()), flat)


def similarity_limit(similarity: float, lanes: int) -> int:
    """Bits in which fingerprints of sets of a Jaccard similarity of ``similarity`` may differ.

    Each of the 64 * ``lanes`` bits differs with the angle's share; the limit is
    eight deviations above the mean.  The worst small sets at 0.8 (four members
    of five) differ in 3/16 of the bits, where that still is 5.8 deviations.
    """
    share, bits = math.acos(2 * similarity / (1 + similarity)) / math.pi, 64 * lanes
    return min(bits, math.ceil(bits * share + 8 * math.sqrt(bits * share * (1 - share))))


def _references(lanes: int) -> np.ndarray:
    return mix64(np.arange(1, PIVOTS * lanes + 1, dtype=np.uint64) * np.uint64(0xBF58476D1CE4E5B9)).reshape(PIVOTS, lanes)


def pivot_table(fp: np.ndarray) -> np.ndarray:
    """Hamming distances to the reference fingerprints: (fingerprints, PIVOTS)."""
    ref = _references(fp.shape[1])
    return np.stack([np.bitwise_count(fp ^ r).sum(axis=1, dtype=np.int16) for r in ref], axis=1)


def _trees(component: np.ndarray | None, n: int) -> np.ndarray:
    """The first row of each row's component."""
    if component is None:
        return np.arange(n)
    _, first, which = np.unique(component, return_index=True, return_inverse=True)
    return first[which]


def close_forest(fp: np.ndarray, limit: int, table: np.ndarray | None = None, component: np.ndarray | None = None) -> np.ndarray:
    """A spanning forest of the links (distance at most ``limit``) among fingerprints, as an array of parents.

    Rows of one ``component`` are linked already.

    Rows are ordered by their distance to the first pivot; each is held only
    against rows within ``limit`` of it there, these are thinned by the other
    pivots, and only survivors not yet in its tree are compared.
    """
    table = pivot_table(fp) if table is None else table
    order = np.argsort(table[:, 0], kind="stable")
    fp, table = fp[order], table[order]
    parent = _trees(None if component is None else component[order], len(fp))
    past = np.searchsorted(table[:, 0], table[:, 0] + limit, side="right")

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(fp)):
        rows = np.arange(i + 1, past[i])
        for k in range(1, table.shape[1], 4):
            if len(rows) < 16 and k > 1:
                break
            rows = rows[(np.abs(table[rows, k : k + 4] - table[i, k : k + 4]) <= limit).all(axis=1)]
        if len(rows):
            mine = root(i)
            rows = rows[parent[rows] != mine]
            rows = rows[np.bitwise_count(fp[rows] ^ fp[i]).sum(axis=1, dtype=np.int16) <= limit]
            for j in rows.tolist():
                a, b = root(i), root(j)
                if a != b:
                    parent[max(a, b)] = min(a, b)
    roots = np.array([root(i) for i in range(len(fp))], np.int64)
    out = np.empty(len(fp), np.int64)
    out[order] = order[roots]
    return out


def _edges(component: np.ndarray, up: np.ndarray) -> pa.RecordBatch | None:
    """The links of a forest as distinct edges (a, b) between components."""
    pairs = np.stack((component, component[up]), axis=1)
    pairs = np.unique(pairs[pairs[:, 0] != pairs[:, 1]], axis=0)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"]) if len(pairs) else None


def _bucket_links(limit: int):
    """For sorted (key, tile, component, fp) rows: edges of the forests of each meeting, one meeting in memory at a time."""

    def meeting(rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        component, fp, table = rows[0] if len(rows) == 1 else (np.concatenate([r[k] for r in rows]) for k in range(3))
        if len(component) > 1 and (component != component[0]).any():
            edges = _edges(component, close_forest(fp, limit, table, component))
            if edges:
                yield edges

    def run(batches):
        held, last = [], None
        small: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            key, tile, component = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            fp = batch.column(3).flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(len(key), -1)
            table = pivot_table(fp)
            edge = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (tile[1:] != tile[:-1]))))
            for a, b in zip(edge, [*edge[1:], len(key)], strict=True):
                if (key[a], tile[a]) != last:
                    small += meeting(held) if held else ()
                    held, last = [], (key[a], tile[a])
                held.append((component[a:b], fp[a:b], table[a:b]))
            if len(small) > 64:
                yield from pa.Table.from_batches(small).combine_chunks().to_batches()
                small = []
        small += meeting(held) if held else ()
        if small:
            yield from pa.Table.from_batches(small).combine_chunks().to_batches()

    return run


def _tiles(n: Column, total: Column, tile_rows: int, tile_size: int) -> Column:
    return F.ceil(F.greatest(n / tile_rows, total / tile_size)).cast("int")


def _alone(rows: DataFrame) -> DataFrame:
    """First meetings of (key, node, size, tiles, ...): each tile of a bucket by itself, other tiles in every bucket."""
    tile = F.pmod(F.xxhash64("node", "key"), F.col("tiles")).cast("int")
    return rows.withColumns({"tile": tile, "component": F.col("node")}).drop("size", "tiles")


def _second(rows: DataFrame, joined: DataFrame, tile_rows: int, tile_size: int) -> DataFrame:
    """Second meetings of (key, node, size, tiles, ...) in buckets of several tiles, given the components of the first round.

    In a bucket the tiles of its largest component (the others: minor) meet the
    minor tiles only; minor tiles meet each other.  So every two rows of a
    bucket that are in different components meet.
    """
    large = rows.filter("tiles > 1").join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    parts = large.groupBy("key", "component").agg(F.count("*").alias("n"), F.sum("size").alias("total"))
    most = F.max(F.struct("n", "total", "component")).alias("most")
    cut = parts.groupBy("key").agg(most, F.sum("n").alias("n"), F.sum("total").alias("total")).filter(F.col("n") > F.col("most.n"))
    cut = cut.select(
        "key",
        F.col("most.component").alias("main"),
        _tiles(F.col("most.n"), F.col("most.total"), tile_rows, tile_size).alias("mains"),
        _tiles(F.col("n") - F.col("most.n"), F.col("total") - F.col("most.total"), tile_rows, tile_size).alias("minors"),
    )
    met = large.join(cut, "key")
    hashed = F.xxhash64("node", "key")
    to = lambda n, make: F.transform(F.sequence(F.lit(0), F.col(n) - 1), make)
    main, minor = F.pmod(hashed, F.col("mains")).cast("int"), F.pmod(hashed, F.col("minors")).cast("int")
    mixed = lambda a, b: F.col("minors") * F.col("minors") + a * F.col("mains") + b
    of_minor = F.concat(to("minors", lambda k: F.least(k, minor) * F.col("minors") + F.greatest(k, minor)), to("mains", lambda k: mixed(minor, k)))
    of_main = to("minors", lambda k: mixed(k, main))
    places = F.when(F.col("component") == F.col("main"), of_main).otherwise(of_minor)
    return met.withColumn("tile", F.explode(places)).drop("size", "tiles", "main", "mains", "minors")


def links(nodes: DataFrame, limit: int, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Edges (a, b) that connect what fingerprints within ``limit`` connect, of nodes (node, fp, keys).

    No task holds more than about two tiles, and no pair of a bucket is missed
    that is not connected otherwise.
    """
    rows = nodes.select("node", "fp", F.lit(1).cast("long").alias("size"), F.explode("keys").alias("key"))
    counts = rows.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    rows = rows.join(counts, "key").withColumn("tiles", _tiles(F.col("n"), F.col("n"), tile_rows, tile_rows)).drop("n")

    def found(places: DataFrame) -> DataFrame:
        sent = places.select("key", "tile", "component", "fp")
        return sent.repartition("key", "tile").sortWithinPartitions("key", "tile").mapInArrow(_bucket_links(limit), "a long, b long")

    return _two_rounds(rows, found, tile_rows, tile_rows)


def _two_rounds(rows: DataFrame, found: Callable[[DataFrame], DataFrame], tile_rows: int, tile_size: int) -> DataFrame:
    """Edges of the first meetings of (key, node, size, tiles, ...) and, where buckets have several tiles, of the second."""
    rows = frames.written(rows, "bucket-rows")
    edges = frames.written(found(_alone(rows)), "links")
    if rows.filter("tiles > 1").limit(1).count():
        joined = frames.written(components(edges), "first-components")
        stars = joined.select(F.col("node").alias("a"), F.col("component").alias("b")).filter("a <> b")
        edges = stars.unionByName(found(_second(rows, joined, tile_rows, tile_size)))
    return edges


def similar_forest(flat: np.ndarray, sizes: np.ndarray, similarity: float, component: np.ndarray | None = None, fp: np.ndarray | None = None) -> np.ndarray:
    """A spanning forest of the links (Jaccard similarity of at least ``similarity``) among non-empty sets, as an array of parents.

    ``flat`` holds the sets one after the other; rows of one ``component`` are
    linked already.  Rows are ordered by size;
    each is held against the larger ones that are not too large and not yet in
    its tree.  With fingerprints ``fp`` of the sets, those whose distances to a
    pivot differ by more than :func:`similarity_limit` are discarded, then
    those that differ themselves in more bits.  What is left is confirmed by
    counting shared members.
    """
    order = np.argsort(sizes, kind="stable")
    if fp is not None:
        limit = similarity_limit(similarity, fp.shape[1])
        fp = fp[order]
        table = pivot_table(fp)
    begin = np.cumsum(sizes) - sizes
    size = sizes[order].astype(np.int64)
    off = np.concatenate(([0], np.cumsum(size)))
    moved = np.repeat(begin[order] - off[:-1], size) + np.arange(off[-1])
    values, ids = np.unique(flat[moved], return_inverse=True)
    past = np.searchsorted(size, size / similarity + 1e-9, side="right")
    tree = _trees(None if component is None else component[order], len(size))
    mark = np.zeros(len(values), np.uint8)
    for i in range(len(size)):
        rows = i + 1 + np.flatnonzero(tree[i + 1 : past[i]] != tree[i])
        if fp is not None and len(rows):
            for k in range(0, table.shape[1], 4):
                if len(rows) < 16 and k:
                    break
                rows = rows[(np.abs(table[rows, k : k + 4] - table[i, k : k + 4]) <= limit).all(axis=1)]
            rows = rows[np.bitwise_count(fp[rows] ^ fp[i]).sum(axis=1, dtype=np.int16) <= limit]
        if not len(rows):
            continue
        mine = ids[off[i] : off[i + 1]]
        mark[mine] = 1
        if 2 * len(rows) > past[i] - i:
            starts = off[i + 1 : past[i]]
            shared = np.add.reduceat(mark[ids[starts[0] : off[past[i]]]], starts - starts[0], dtype=np.int64)[rows - i - 1]
        else:
            n = size[rows]
            starts = np.cumsum(n) - n
            shared = np.add.reduceat(mark[ids[np.repeat(off[rows] - starts, n) + np.arange(n.sum())]], starts, dtype=np.int64)
        mark[mine] = 0
        near = rows[shared >= similarity * (size[rows] + size[i] - shared) - 1e-9]
        if len(near):
            met = np.unique(np.append(tree[near], tree[i]))
            tree[np.isin(tree, met)] = met[0]
    out = np.empty(len(size), np.int64)
    out[order] = order[tree]
    return out


def _similar_links(similarity: float):
    """For sorted (key, tile, component, shingles, fp) rows: edges of the forests of each meeting, one meeting in memory at a time."""

    def meeting(rows: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        component, sizes, flat, fp = (np.concatenate([r[k] for r in rows]) for k in range(4))
        if len(component) > 1 and (component != component[0]).any():
            edges = _edges(component, similar_forest(flat, sizes, similarity, component, fp))
            if edges:
                yield edges

    def run(batches):
        held, last = [], None
        for batch in frames.pieces(batches):
            if not batch.num_rows:
                continue
            key, tile, component = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            sizes = pc.list_value_length(batch.column(3)).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = batch.column(3).flatten().to_numpy(zero_copy_only=False)
            fp = batch.column(4).flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(len(key), -1)
            off = np.concatenate(([0], np.cumsum(sizes)))
            edge = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (tile[1:] != tile[:-1]))))
            for a, b in zip(edge, [*edge[1:], len(key)], strict=True):
                if (key[a], tile[a]) != last:
                    yield from meeting(held) if held else ()
                    held, last = [], (key[a], tile[a])
                held.append((component[a:b].copy(), sizes[a:b].copy(), flat[off[a] : off[b]].copy(), fp[a:b].copy()))
        yield from meeting(held) if held else ()

    return run


def similar_links(docs: DataFrame, nodes: DataFrame, words: int, similarity: float, tile_rows: int = TILE_ROWS, tile_shingles: int = TILE_SHINGLES) -> DataFrame:
    """Edges (a, b) that connect what pairs of ``similarity`` and more connect, of nodes (node, at, fp, keys, size).

    ``docs``: doc_id, text and its hash, by which the row of a node is found
    (``at``: id and hash).  Of buckets with the same members one is looked at.
    Only documents of shared buckets are shingled again, and their sets alone
    go to the buckets.
    """
    rows = nodes.filter("size > 0").select("node", "size", F.explode("keys").alias("key"))
    member = [F.bit_xor(F.xxhash64("node", F.lit(k))).alias(f"h{k}") for k in range(2)]
    shared = rows.groupBy("key").agg(F.count("*").alias("n"), F.sum("size").alias("total"), *member).filter("n > 1")
    shared = shared.groupBy("n", "total", "h0", "h1").agg(F.min("key").alias("key"))
    tiles = _tiles(F.col("n"), F.col("total"), tile_rows, tile_shingles).alias("tiles")
    rows = rows.join(shared.select("key", tiles), "key")

    def run(batch: pa.RecordBatch) -> dict:
        made = []
        for block in blocks(batch.column(batch.schema.get_field_index("text"))):
            distinct, size = shingle_sets(*shingle_hashes(block, words))
            off = np.concatenate(([0], np.cumsum(size)))
            made.append(pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(distinct.view(np.int64))))
        return {"shingles": pa.concat_arrays(made)}

    def found(meetings: DataFrame) -> DataFrame:
        places = meetings.groupBy("node", "component").agg(F.collect_list(F.struct("key", "tile")).alias("places"))  # a node has BANDS keys
        places = frames.written(places, "places")
        of = places.select("node").join(nodes.select("node", F.struct("at.doc_id", "at.hash").alias("at")), "node")
        texts = docs.select(F.struct("doc_id", "hash").alias("at"), "text").join(_bounded(of), "at").select("node", "text")
        sets = frames.map_batches(texts.join(places.join(nodes.select("node", "fp"), "node"), "node"), [("shingles", T.ArrayType(T.LongType(), False))], run, keep=["component", "fp", "places"])
        sent = sets.select("component", "shingles", "fp", F.explode("places").alias("p")).select("p.key", "p.tile", "component", "shingles", "fp")
        return sent.repartition("key", "tile").sortWithinPartitions("key", "tile").mapInArrow(_similar_links(similarity), "a long, b long")

    return _two_rounds(rows, found, tile_rows, tile_shingles)


def _bounded(rows: DataFrame) -> DataFrame:
    """Rows of a few longs, to be broadcast if there are at most BROADCAST_ROWS of them."""
    rows = frames.written(rows, "picked")
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def _similar(docs: DataFrame, words: int, lanes: int, similarity: float, tile_rows: int) -> tuple[DataFrame, DataFrame]:
    """Written rows of ``docs`` (doc_id, hash, fp, print) and the component of each print, its shingle set's digest."""
    prints = fingerprints(docs, words, lanes, keep=("hash",), sets=True).withColumnRenamed("digest", "print")
    prints = frames.written(prints.withColumn("row", F.monotonically_increasing_id()), "fingerprints")
    # One node for each shingle set, named apart from the ids; copies stop here.
    at = F.struct("doc_id", "hash")
    nodes = prints.groupBy("print").agg(F.min("row").alias("node"), F.min("doc_id").alias("least"), F.min(at).alias("at"), F.min("fp").alias("fp"), F.min("keys").alias("keys"), F.min("size").alias("size"))
    nodes = frames.written(nodes, "nodes", prints.count())
    return prints, _members(nodes, similar_links(docs, nodes, words, similarity, tile_rows))


def _close(docs: DataFrame, words: int, lanes: int, limit: int, tile_rows: int) -> tuple[DataFrame, DataFrame]:
    """The same where fingerprints within ``limit`` bits link; the print is the fingerprint."""
    prints = fingerprints(docs, words, lanes, 5, 2, keep=("hash",)).withColumn("row", F.monotonically_increasing_id())
    prints = frames.written(prints.withColumn("print", F.col("fp")), "fingerprints")
    # One node for each fingerprint and key set; copies stop here.
    nodes = prints.groupBy("print", "fp", "keys").agg(F.min("row").alias("node"), F.min("doc_id").alias("least"))
    nodes = frames.written(nodes, "nodes", prints.count())
    edges = links(nodes, limit, tile_rows)
    if lanes > 1:  # equal fingerprints of unlike key sets
        least = nodes.groupBy("fp").agg(F.min("node").alias("b"), F.count("*").alias("n")).filter("n > 1")
        edges = edges.unionByName(nodes.join(least, "fp").select(F.col("node").alias("a"), "b"))
    return prints, _members(nodes, edges)


def _members(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(print, component, component_id) of nodes (print, node, least): the smallest id of a component names it."""
    joined, n = components(edges), nodes.count()
    member = nodes.join(joined, "node", "left").select("print", "least", F.coalesce("component", "node").alias("component"))
    member = frames.written(member, "members", n)
    least = frames.written(member.groupBy("component").agg(F.min("least").alias("component_id")), "names", n)
    member = member.groupBy("print").agg(F.min("component").alias("component"))
    # Written, so that both sides of a join with all rows come straight from a shuffle, which splits a hot print.
    return frames.written(member.join(least, "component").select("print", "component", "component_id"), "components", n)


def _grouped(docs: DataFrame, words: int, lanes: int, limit: int | None, similarity: float, tile_rows: int) -> tuple[DataFrame, DataFrame]:
    if lanes == 1 and limit is None:
        raise ValueError("similarity needs more lanes, one lane a limit")
    if lanes == 1 and limit > 3:
        raise ValueError("block keys find up to 3 differing bits; use more lanes")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("hash"))
    return _similar(docs, words, lanes, similarity, tile_rows) if limit is None else _close(docs, words, lanes, limit, tile_rows)


def near_duplicates(docs: DataFrame, words: int = 5, lanes: int = 4, limit: int | None = None, similarity: float = 0.8, tile_rows: int = TILE_ROWS) -> DataFrame:
    """doc_id, fingerprint (hex) and component_id (the smallest doc_id that links reach, its own included).

    Fingerprints link at ``limit`` or fewer differing bits.  Left out, texts
    link whose sets of shingles have a Jaccard similarity of ``similarity`` or
    more: bands of minima find the candidates (a pair at 0.8 is missed with
    probability 3e-5) and each link is confirmed on the sets.

    Texts without words have fingerprint zero and link like others.  Rows with
    a null id link like others, but a null names a component only if all its
    ids are null (component_id null).  Repeated rows and rows of one id come
    back each, by their own texts.  Other columns are not looked at.
    """
    text = F.concat(*[F.lpad(F.lower(F.hex(F.col("fp")[k])), 16, "0") for k in range(lanes)])
    prints, member = _grouped(docs, words, lanes, limit, similarity, tile_rows)
    return prints.select("doc_id", "fp", "print").join(member, "print").select("doc_id", text.alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, words: int = 5, lanes: int = 4, limit: int | None = None, similarity: float = 0.8, tile_rows: int = TILE_ROWS) -> DataFrame:
    """One document of each near-duplicate group: the one of smallest doc_id (null ids last, then by a hash of the text).

    Rows of one id and different texts are documents of their own; repeated
    rows are reduced to one.  Input columns are carried as they are.
    """
    prints, member = _grouped(docs, words, lanes, limit, similarity, tile_rows)
    at = F.struct(F.col("doc_id").cast("long").alias("doc_id"), "hash")
    rows = prints.select("doc_id", "hash", "print").join(member, "print").groupBy("doc_id", "hash", "component").agg(F.count("*").alias("n"))
    rows = frames.written(rows, "grouped", prints.count())
    order = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "hash")
    first = rows.groupBy("component").agg(F.min(order).alias("first"))
    stays = (F.col("doc_id").eqNullSafe(F.col("first.doc_id"))) & (F.col("hash") == F.col("first.hash"))
    gone = _bounded(rows.join(first, "component").filter(~stays).select(at.alias("__quillon_at")))
    left = docs.withColumn("__quillon_at", F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("hash")))
    left = left.join(gone, "__quillon_at", "left_anti")
    if rows.filter("n > 1").limit(1).count():
        left = left.dropDuplicates(["__quillon_at"])
    return left.select(docs.columns)
