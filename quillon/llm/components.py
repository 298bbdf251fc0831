"""Connected components of a distributed edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.llm import frames


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], int(row["h"] or 0)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b: long): the smallest node reachable.

    Each step takes the least neighbour of every node by a pre-aggregated
    minimum, never a list of neighbours, so a node with many edges costs a
    skewed join (which adaptive execution splits) and no large row.  Every
    step is written to the shared folder.  Self-loops, repeated edges and an
    empty table are allowed.
    """
    spark = edges.sparkSession
    now = frames.written(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while (state := _state(now)) != before and state[0]:
        before = state
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Minima are written, so that both sides of a join come straight from a shuffle and a node with many edges is split.
        least = frames.written(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least", 2 * state[0])
        large = frames.written(both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct(), "large", state[0])
        lower = frames.written(large.groupBy("a").agg(F.min("b").alias("m")), "least", state[0])
        pair = lambda x, y: F.struct(F.col(x).alias("a"), F.col(y).alias("b"))
        met = large.join(lower, "a").select("a", F.greatest("b", "m").alias("x"), "m")
        small = met.select(F.explode(F.array(pair("x", "m"), pair("a", "m"))).alias("e")).select("e.a", "e.b").filter("a <> b").distinct()
        old, now = [now, least, large, lower], frames.written(small, "edges", state[0])
        for table in old:
            frames.forget(spark, table)
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
