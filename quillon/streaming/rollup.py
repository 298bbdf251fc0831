"""Streaming extension: the ledger's status roll-up kept up to date as events arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_counts(events: DataFrame, ts: str = "ts", kind: str = "event_type", value: str = "value", window: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts and sums of each kind in tumbling windows of event time; batch or stream.

    On a stream, rows later than ``late`` behind the newest are dropped and
    state of closed windows is freed.
    """
    events = events.withColumn(ts, F.col(ts).cast("timestamp"))
    if events.isStreaming:
        events = events.withWatermark(ts, late)
    out = events.groupBy(F.window(ts, window).alias("w"), kind).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
    return out.select(F.col("w.start").alias("window_start"), kind, "n", "total")


def sessions(events: DataFrame, user: str = "user_id", ts: str = "ts", gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """Runs of a user's events without a pause of ``gap``; batch or stream."""
    events = events.withColumn(ts, F.col(ts).cast("timestamp"))
    if events.isStreaming:
        events = events.withWatermark(ts, late)
    out = events.groupBy(F.session_window(ts, gap).alias("s"), user).agg(F.count("*").alias("n"))
    return out.select(user, F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "n")
