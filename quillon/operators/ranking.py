"""Ranks over a whole table without gathering it in one task."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def global_rank(df: DataFrame, *order: Column, name: str = "rank") -> DataFrame:
    """Adds the 1-based place of every row in ``order``.

    Rows are dealt to ranges and sorted there; a place is the row's place in
    its range after the counts of the ranges before it, and only those counts
    (one row a partition) meet in one place.  The sorted ranges are fixed by a
    checkpoint where the session has a folder for it, else by the cache, since
    a second sampling could draw other borders.
    """
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id() % (1 << 33)})
    placed = placed.checkpoint() if df.sparkSession.sparkContext.getCheckpointDir() else placed.persist()
    counts = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    before = counts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    return placed.join(F.broadcast(before), "_part").withColumn(name, (F.col("_before") + F.col("_at") + 1).cast("long")).drop("_part", "_at", "_before")  # one row a partition


def fixed(df: DataFrame) -> DataFrame:
    """``df`` computed once: as a compressed table in the checkpoint folder, else in the cache.  Its plan is then a scan, however often it is read."""
    folder = df.sparkSession.sparkContext.getCheckpointDir()
    if not folder:
        return df.persist()
    path = f"{folder}/fixed-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def group_places(df: DataFrame, by: Sequence[str], order: Sequence[str], keep: Sequence[Column | str], name: str = "idx") -> DataFrame:
    """(by, keep, name): the 0-based place of each row in its group, dealt to ranges as in :func:`global_rank`; rows without a group (null) are left out.

    Of the sorted ranges only ``keep`` is fixed, and what has to be added to a
    row's place in its range, one row for each range and group in it.
    """
    keys = [F.col(c) for c in (*by, *order)]
    ranges = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = fixed(ranges.select(*by, *keep, F.spark_partition_id().alias("_part"), (F.monotonically_increasing_id() % (1 << 33)).alias("_at")))
    counts = placed.groupBy("_part", *by).agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    earlier = Window.partitionBy(*by).orderBy("_part")
    more = fixed(counts.select("_part", *by, (F.sum("_n").over(earlier) - F.col("_n") - F.col("_first")).alias("_more")))
    return placed.join(F.broadcast(more), ["_part", *by]).withColumn(name, F.col("_at") + F.col("_more")).drop("_part", "_at", "_more")


def running_total(df: DataFrame, value: str, *order: Column, name: str = "total") -> DataFrame:
    """Adds the sum of ``value`` over all rows up to each one in ``order``, dealt as in :func:`global_rank`."""
    placed = df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    placed = placed.checkpoint() if df.sparkSession.sparkContext.getCheckpointDir() else placed.persist()
    sums = placed.groupBy("_part").agg(F.sum(value).alias("_sum"))
    before = sums.select("_part", (F.sum("_sum").over(Window.orderBy("_part")) - F.col("_sum")).alias("_before"))  # one row a partition
    upto = F.sum(value).over(Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return placed.withColumn(name, upto).join(F.broadcast(before), "_part").withColumn(name, F.col(name) + F.col("_before")).drop("_part", "_before")


def asof(left: DataFrame, right: DataFrame, by: Sequence[str], on: str, value: str, ties: Sequence[str] = ()) -> DataFrame:
    """Adds to each row of ``left`` the ``value`` of the last row of ``right`` at or before it (``on``) with the same ``by``.

    One window over both tables; of right rows at one time the last by
    ``ties``.  Keys are expected to have few rows each, as users or symbols do.
    """
    sides = [(left, 1), (right, 0)]
    columns = [c for c in left.columns if c != value]
    both = None
    for df, side in sides:
        own = [(F.col(c) if c in df.columns else F.lit(None).cast(left.schema[c].dataType)).alias(c) for c in columns]
        hit = F.col(value) if side == 0 else F.lit(None).cast(right.schema[value].dataType)
        rows = df.select(*own, hit.alias("_value"), F.lit(side).alias("_side"))
        both = rows if both is None else both.unionByName(rows)
    order = Window.partitionBy(*by).orderBy(on, "_side", *ties).rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn(value, F.last("_value", ignorenulls=True).over(order)).filter("_side = 1").drop("_side", "_value")
