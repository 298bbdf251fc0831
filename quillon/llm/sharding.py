"""Sharding by a k-d tree over document metadata.

Documents of equal text form a group that stays in one shard.  Groups are
summed into cells of a grid over their metadata: source, language and length.
A coordinate is the share of all bytes that stands before a value, so widths
of unlike dimensions compare: a node's width is the share of the corpus
between its least and its greatest value.  The tree is grown on the cells: a
node that owes k shards is cut at the weighted (k // 2) / k quantile of its
widest dimension, ties inside the crossing value being cut along the content
hash (which is the last dimension where all others have one value), until
every leaf is one shard and so holds the target bytes.  Everything runs in
DataFrame operations; what comes to the driver is one histogram of at most
SHARDS * GRID rows a level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillon.llm import frames

#: Values of a dimension's coordinate, bins that names and lengths are counted in, and values of the hash that breaks ties.
GRID, BINS, FINE = 256, 512, 4096
METADATA = ("source", "lang", "chars")
DIMENSIONS = (*METADATA, "hash")
#: Rows of an average shard that one task numbers.
SLOT_ROWS = 200_000


def _grid(df: DataFrame) -> DataFrame:
    """Coordinates 0 .. GRID - 1 of every group; groups without a value stand at the low end."""
    name = lambda c: F.when(F.col(c).isNull(), F.lit(0)).otherwise(1 + F.pmod(F.xxhash64(F.col(c).cast("string")), F.lit(BINS - 1))).cast("int")
    length = F.least(F.lit(BINS - 1), F.floor(F.log2(F.col("chars") + 1) * 8)).cast("int")
    out = binned = frames.written(df.withColumns({"source": name("source"), "lang": name("lang"), "chars": length}), "binned")
    for c in METADATA:
        weights = binned.groupBy(c).agg(F.sum("bytes").alias("w"))  # at most BINS rows
        running = F.sum("w").over(Window.orderBy(c)) - F.col("w") / 2
        at = F.least(F.lit(GRID - 1), F.floor(running * GRID / F.sum("w").over(Window.partitionBy()))).cast("int")
        out = out.join(F.broadcast(weights.select(c, at.alias("_at"))), c).drop(c).withColumnRenamed("_at", c)
    fine = F.shiftrightunsigned("h1", 52).cast("int")
    return out.select("h1", "h2", "bytes", "source", "lang", "chars", F.shiftrightunsigned("h1", 56).cast("int").alias("hash"), fine.alias("fine"))


def _pick(choices: dict[int, object], node: Column, kind: str, default=None) -> Column:
    """A CASE over node numbers: at most one branch for each shard."""
    out = F.lit(default).cast(kind)
    for k, v in choices.items():
        out = F.when(node == k, F.lit(v).cast(kind)).otherwise(out)
    return out


def _cut(hist: list, goal: float) -> tuple[int, float]:
    """The value whose running weight first passes ``goal``, and the weight before it."""
    before = 0.0
    for value, weight in hist:
        if before + weight > goal or (value, weight) == hist[-1]:
            return value, before
        before += weight
    raise ValueError("an empty node has no median")


def grow(cells: DataFrame, shards: int) -> Column:
    """The leaf (0 .. shards - 1) of a cell, as an expression over its coordinates."""
    node, owed = F.lit(0), {0: (0, shards)}  # node number -> first shard, shards
    while any(k > 1 for _, k in owed.values()):
        open_nodes = {n: v for n, v in owed.items() if v[1] > 1}
        here = cells.withColumn("node", node).filter(F.col("node").isin(list(open_nodes)))
        spans = here.groupBy("node").agg(F.sum("bytes").alias("total"), *[(F.max(d) - F.min(d)).alias(d) for d in DIMENSIONS]).collect()
        widest = {r["node"]: max(METADATA, key=lambda d, r=r: r[d]) if any(r[d] for d in METADATA) else "hash" for r in spans}
        total = {r["node"]: r["total"] for r in spans}
        coordinate = F.lit(None).cast("int")
        for n, d in widest.items():
            coordinate = F.when(F.col("node") == n, F.col(d)).otherwise(coordinate)
        here = here.withColumn("at", coordinate)
        hist: dict[int, list] = {}
        for r in here.groupBy("node", "at").agg(F.sum("bytes").alias("w")).collect():
            hist.setdefault(r["node"], []).append((r["at"], r["w"]))
        cuts = {n: (*_cut(sorted(h), total[n] * (open_nodes[n][1] // 2) / open_nodes[n][1]), open_nodes[n][1]) for n, h in hist.items()}
        inside: dict[int, list] = {}
        crossing = here.filter(F.col("at") == _pick({n: c[0] for n, c in cuts.items()}, F.col("node"), "int"))
        for r in crossing.groupBy("node", "fine").agg(F.sum("bytes").alias("w")).collect():
            inside.setdefault(r["node"], []).append((r["fine"], r["w"]))
        new, following = node, {n: v for n, v in owed.items() if v[1] == 1}
        for n, (first, k) in open_nodes.items():
            left, right = 2 * n + 1, 2 * n + 2
            following |= {left: (first, k // 2), right: (first + k // 2, k - k // 2)}
            if n not in cuts:
                continue
            value, before, _ = cuts[n]
            goal = total[n] * (k // 2) / k - before
            fine, under = _cut(sorted(inside[n]), goal)
            weight = dict(inside[n])[fine]
            if goal - under > weight / 2:  # the nearer side of the crossing hash value
                fine += 1
            d = F.col(widest[n])
            goes_left = (d < value) | ((d == value) & (F.col("fine") < fine))
            new = F.when(node == n, F.when(goes_left, F.lit(left)).otherwise(F.lit(right))).otherwise(new)
        # The path expression is kept flat: each level reads the node column that the level before wrote.
        cells = frames.written(cells.withColumn("_new", new).drop("node").withColumnRenamed("_new", "node"), "cells")
        node, owed = F.col("node"), following
    return cells.withColumn("shard", _pick({n: first for n, (first, _) in owed.items()}, node, "int")).drop("node")


def shard_documents(docs: DataFrame, shards: int = 24) -> DataFrame:
    """doc_id, size, text_crc32, law ('bytes'), shard, slot, grown_shard (null) of each row.

    Size is the text's UTF-8 bytes (null: none) plus 8.  Groups of equal texts
    (null equals empty) stay together; one larger than an even share gets a
    shard of its own and the others share the remaining shards.  Slots number
    a shard's rows from 0 without gaps, by doc_id within parts of a shard;
    parts are dealt by row, so rows of one id or none are no large group.
    Documents without source or language stand at the low end of those
    dimensions.  Repeated rows each have a slot; an empty table gives no rows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    have = set(docs.columns)
    rows = docs.select(
        F.col("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("h1"),
        F.xxhash64(F.lit("second"), text).alias("h2"),
        F.char_length(text).cast("long").alias("chars"),
        *[(F.col(c).cast("string") if c in have else F.lit(None).cast("string")).alias(c) for c in ("source", "lang")],
        F.monotonically_increasing_id().alias("row"),
    )
    rows = frames.written(rows, "rows")
    groups = rows.groupBy("h1", "h2").agg(F.sum("size").alias("bytes"), F.min("source").alias("source"), F.min("lang").alias("lang"), F.min("chars").alias("chars"))
    groups = frames.written(_grid(groups), "groups")
    # Groups larger than an even share of what is left: fewer than `shards`.
    alone: list[tuple[int, int]] = []
    left = groups.agg(F.sum("bytes")).first()[0] or 0
    for r in groups.filter(F.col("bytes") * shards > left).orderBy(F.desc("bytes"), "h1", "h2").collect():
        if len(alone) + 1 < shards and r["bytes"] * (shards - len(alone)) > left:
            alone.append((r["h1"], r["h2"]))
            left -= r["bytes"]
    own = F.lit(None).cast("int")
    for k, (h1, h2) in enumerate(alone):
        own = F.when((F.col("h1") == h1) & (F.col("h2") == h2), F.lit(shards - 1 - k)).otherwise(own)
    coordinates = [*DIMENSIONS, "fine"]
    cells = groups.filter(own.isNull()).groupBy(*coordinates).agg(F.sum("bytes").alias("bytes"))
    leaf = grow(frames.written(cells, "cells"), shards - len(alone)).select(*coordinates, F.col("shard").alias("leaf"))
    placed = groups.join(leaf, coordinates, "left").select("h1", "h2", F.coalesce(own, F.col("leaf")).alias("shard"))
    parts = max(1, -(-rows.count() // (shards * SLOT_ROWS)))
    part = F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int").alias("part")
    dealt = frames.written(rows.select("doc_id", "size", "text_crc32", "row", "h1", "h2", part).join(placed, ["h1", "h2"]).drop("h1", "h2"), "placed")
    return _slots(dealt).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def _slots(dealt: DataFrame) -> DataFrame:
    """Number rows of a shard: by part, within a part by doc_id, each part starting where the one before ends."""
    counts = dealt.groupBy("shard", "part").agg(F.count("*").alias("n"))
    start = F.sum("n").over(Window.partitionBy("shard").orderBy("part")) - F.col("n")
    offsets = counts.select("shard", "part", start.alias("start"))  # one row a shard and part
    place = F.row_number().over(Window.partitionBy("shard", "part").orderBy("doc_id", "size", "text_crc32", "row")) - 1
    return dealt.withColumn("place", place).join(F.broadcast(offsets), ["shard", "part"]).withColumn("slot", (F.col("start") + F.col("place")).cast("long"))
