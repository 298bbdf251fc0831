"""Reductions: epochs, thresholds, cells, seeds, sweeps and caches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillon.functions.scalars import json_text
from quillon.functions.semantics import choose, finite, first_by, is_finite, non_empty
from quillon.operators.ranking import running_total

#: Validation metrics whose best epoch is the highest, and whose best is the lowest.
MAX_KEYS = ("val_accuracy", "val_macro_f1", "val_signal_rate", "val_ic", "val_directional_accuracy", "val_r2", "val_pearson", "val_profitable_accuracy")
MIN_KEYS = ("val_loss", "val_mae", "val_rmse")


def best_epochs(history: DataFrame, tests: DataFrame | None = None, key: str = "experiment_id") -> DataFrame:
    """(key, metric, value): best finite value over epochs of each known metric as ``best_<metric>``; test metrics win over equal names.

    ``history``: key, epoch, key name ``metric`` and value, long form.
    """
    known = history.filter(F.col("metric").isin(*MAX_KEYS, *MIN_KEYS) & is_finite(F.col("value")))
    best = known.groupBy(key, "metric").agg(F.max("value").alias("hi"), F.min("value").alias("lo"))
    best = best.select(key, F.concat(F.lit("best_"), "metric").alias("metric"), F.when(F.col("metric").isin(*MAX_KEYS), F.col("hi")).otherwise(F.col("lo")).alias("value"))
    if tests is None:
        return best
    tests = tests.filter(is_finite(F.col("value"))).select(key, "metric", "value")
    return tests.unionByName(best.join(tests.select(key, "metric"), [key, "metric"], "left_anti"))


def history_summary(history: DataFrame, key: str = "experiment_id", order: str = "epoch", loss: str = "val_loss", score: str = "val_macro_f1") -> DataFrame:
    """One row for each key: the epoch of least loss (without losses: of highest score; else the last) and the last epoch.

    ``history`` is wide.  Columns come back as best_<c> and final_<c>, with n_epochs.
    """
    metrics = [c for c in history.columns if c not in (key, order)]
    mine = Window.partitionBy(key)
    has_loss = F.max(is_finite(F.col(loss)).cast("int")).over(mine) == 1
    value = F.when(has_loss, finite(F.col(loss))).otherwise(-finite(F.col(score)))
    none = value.isNull() & (F.max(value.isNotNull().cast("int")).over(mine) == 0)
    rows = history.withColumn("_v", F.when(none, -F.col(order).cast("double")).otherwise(value)).withColumn("_n", F.count("*").over(mine))
    rows = rows.withColumn("_best", first_by([key], F.col("_v").asc_nulls_last(), F.col(order).asc())).withColumn("_last", first_by([key], F.col(order).desc()))
    pick = lambda flag, c: F.max(F.when(F.col(flag) == 1, F.col(c)))
    return rows.groupBy(key).agg(*[pick("_best", c).alias(f"best_{c}") for c in [order, *metrics]], *[pick("_last", c).alias(f"final_{c}") for c in metrics], F.max("_n").alias("n_epochs"))


def best_threshold(results: DataFrame, key: str, order: str, option: str = "option_return", total: str = "total_return", zero_dte: str = "zero_dte") -> DataFrame:
    """The first threshold of highest return; not finite sorts lowest.

    A 0DTE run any of whose rows has an option return is decided by option
    returns alone, another by total returns.
    """
    run = Window.partitionBy(key)
    by_option = F.bool_or(F.col(zero_dte)).over(run) & F.bool_or(F.col(option).isNotNull()).over(run)
    score = F.when(by_option, F.col(option)).otherwise(F.col(total))
    low = F.coalesce(finite(score), F.lit(float("-inf")))
    return results.withColumn("score", finite(score)).withColumn("_n", first_by([key], low.desc(), F.col(order).asc())).filter("_n = 1").drop("_n")


def pooled(trades: DataFrame, cell: Sequence[str], value: str = "pnl") -> DataFrame:
    """Count and mean of all trades of a cell, every seed together."""
    return trades.groupBy(*cell).agg(F.count(value).alias("n"), F.avg(value).alias("mean"))


def trimmed_means(trades: DataFrame, cell: Sequence[str], k: int, value: str = "pnl", seed: str = "seed", order: str = "trade_idx") -> DataFrame:
    """Per seed the mean without the k values largest by absolute size (of equals the later goes first); then the mean over seeds.

    A seed without more than k trades counts 0.  Only the first k that a task
    has of a seed are moved; then every trade is compared with its seed's k-th.
    """
    rows = trades.select(*cell, seed, F.struct(*cell, seed).alias("_group"), F.col(value).alias("_v"), F.abs(value).alias("_size"), F.col(order).alias("_at"))
    key = F.struct("_size", "_at")
    place = F.row_number().over(Window.partitionBy("_group").orderBy(F.col("_size").desc(), F.col("_at").desc()))
    cut = rows.select("_group", "_size", "_at").withColumn("_n", place).filter(F.col("_n") <= k).groupBy("_group").agg(F.min(key).alias("_cut"))
    below = F.coalesce(key < F.col("_cut"), F.lit(True))
    kept, equal = F.when(below, F.col("_v")), F.when(key == F.col("_cut"), F.col("_v"))
    sums = rows.join(F.broadcast(cut), "_group", "left").groupBy(*cell, seed).agg(F.sum(kept).alias("_sum"), F.count(kept).alias("_kept"), F.count_if(~below).alias("_top"), F.avg(equal).alias("_equal"))  # one row a seed
    over = F.when((F.col("_top") > k) & F.col("_equal").isNotNull(), F.col("_top") - k).otherwise(0)  # of one size and place, where places repeat
    total = F.coalesce("_sum", F.lit(0.0)) + F.when(over > 0, over * F.col("_equal")).otherwise(0.0)
    each = sums.withColumn("trimmed", F.coalesce(total / F.nullif(F.col("_kept") + over, F.lit(0)), F.lit(0.0)))
    return each.groupBy(*cell).agg(F.avg("trimmed").alias("trimmed_mean"), F.count("*").alias("n_seeds"))


def rollup(children: DataFrame, sweep: str = "sweep_id", name: str = "sweep_name") -> DataFrame:
    """One aggregate for each sweep: status, duration, counts, and a fingerprint.

    completed: some child completed and none failed; partial: some of both;
    failed: some failed, none completed; else unknown.  The fingerprint is
    that of the canonical JSON of the sweep's name and its children's sorted
    fingerprints (empty ones left out).
    """
    ok, bad = F.count_if(F.col("status") == "completed"), F.count_if(F.col("status") == "failed")
    children_json = F.array_join(F.transform(F.array_sort(F.collect_list(non_empty(F.col("fingerprint")))), lambda x: json_text(x)), ", ")
    return children.groupBy(sweep, name).agg(
        F.count("*").alias("n_children"),
        ok.alias("n_completed"),
        bad.alias("n_failed"),
        F.sum("duration_seconds").alias("duration_seconds"),
        choose(((ok > 0) & (bad == 0), "completed"), (ok > 0, "partial"), (bad > 0, "failed"), otherwise="unknown").alias("status"),
        F.sha2(F.concat(F.lit('{"children": ['), children_json, F.lit('], "sweep_name": '), json_text(F.col(name)), F.lit("}")), 256).alias("fingerprint"),
    )


def invariants(rows: DataFrame, cell: Sequence[str], digest: str = "sha") -> DataFrame:
    """For each cell: rows, distinct digests, and whether all are equal, all differ, or any is missing."""
    n, d, filled = F.count("*"), F.count_distinct(digest), F.count(digest)
    return rows.groupBy(*cell).agg(n.alias("n_rows"), d.alias("n_distinct"), ((d == 1) & (filled == n)).alias("identical"), ((d == n) & (filled == n)).alias("all_distinct"), (filled == n).alias("populated"))


def collisions(rows: DataFrame, digest: str, member: str) -> DataFrame:
    """Digests that several members share, with the sorted members."""
    return rows.filter(F.col(digest).isNotNull()).groupBy(digest).agg(F.array_sort(F.collect_set(member)).alias("members")).filter(F.size("members") > 1)


def representatives(rows: DataFrame, cell: Sequence[str], digest: str, order: str) -> DataFrame:
    """All rows of a cell, but one only where all its digests are equal: copies are no further evidence."""
    mine = Window.partitionBy(*cell)
    same = (F.min(digest).over(mine) == F.max(digest).over(mine)) & (F.count(digest).over(mine) == F.count("*").over(mine))
    return rows.withColumn("_same", F.coalesce(same, F.lit(False))).withColumn("_n", first_by(cell, F.col(order).asc())).filter("NOT _same OR _n = 1").drop("_same", "_n")


def equal_weight(cells: DataFrame, by: Sequence[str], value: str = "mean", n: str = "n", least: int = 10) -> DataFrame:
    """Mean over cells of equal weight, without those of fewer than ``least`` rows or no finite value."""
    use = F.when((F.col(n) >= least) & is_finite(F.col(value)), F.col(value))
    return cells.groupBy(*by).agg(F.avg(use).alias("mean"), F.count(use).alias("n_cells"))


def divergence(records: DataFrame) -> DataFrame:
    """Names with more than one configuration hash, and (name, fingerprint) with more than one provenance hash; completed single runs only."""
    runs = records.filter((F.col("status") == "completed") & ~F.coalesce(F.col("record_type").isin("sweep_aggregate", "sweep_failure"), F.lit(False)))
    config = runs.groupBy("name").agg(F.count_distinct(non_empty(F.col("fingerprint"))).alias("n")).select("name", F.lit("").alias("fingerprint"), F.lit("config").alias("kind"), "n")
    origin = runs.filter(non_empty(F.col("fingerprint")).isNotNull()).groupBy("name", "fingerprint").agg(F.count_distinct(non_empty(F.col("provenance_hash"))).alias("n")).select("name", "fingerprint", F.lit("provenance").alias("kind"), "n")
    return config.unionByName(origin).filter("n > 1")


def seed_statistics(rows: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Mean, sample and population standard deviation over seeds."""
    v = finite(F.col(value))
    return rows.groupBy(*by).agg(F.count(v).alias("n"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std_sample"), F.stddev_pop(v).alias("std_population"))


def class_profile(predictions: DataFrame, by: Sequence[str], classes: Sequence[int], predicted: str = "prediction", confidence: str = "confidence") -> DataFrame:
    """Histogram of predicted classes and quartiles of confidence."""
    counts = [F.count_if(F.col(predicted) == c).alias(f"n_{c}") for c in classes]
    return predictions.groupBy(*by).agg(F.count("*").alias("n"), *counts, *[F.percentile(confidence, q).alias(f"q{int(q * 100)}") for q in (0.25, 0.5, 0.75)])


def passing(cells: DataFrame, condition: Column, least: int) -> DataFrame:
    """How many cells satisfy a condition, and whether that is enough."""
    n = F.count_if(F.coalesce(condition, F.lit(False)))
    return cells.agg(n.alias("n_passing"), F.count("*").alias("n_cells"), (n >= least).alias("ok"))


def strictly_decreasing(rows: DataFrame, by: Sequence[str], order: str, value: str) -> DataFrame:
    """Whether a value falls at every step along ``order``; a missing value breaks the fall."""
    before = F.lag(value).over(Window.partitionBy(*by).orderBy(order))
    first = F.row_number().over(Window.partitionBy(*by).orderBy(order)) == 1
    step = F.when(first, is_finite(F.col(value))).otherwise(F.coalesce((F.col(value) < before) & is_finite(F.col(value)), F.lit(False)))
    return rows.withColumn("_ok", step).groupBy(*by).agg(F.bool_and("_ok").alias("decays"), F.count("*").alias("n"))


def baseline_ratio(rows: DataFrame, by: Sequence[str], model: str, value: str, numerator: str, denominator: str, floor: float = 1e-6) -> DataFrame:
    """One model's value over another's in each cell; null where the other's is not above ``floor``."""
    pick = lambda m: F.max(F.when(F.col(model) == m, finite(F.col(value))))
    wide = rows.groupBy(*by).agg(pick(numerator).alias("numerator"), pick(denominator).alias("denominator"))
    return wide.withColumn("ratio", F.when(F.col("denominator") > floor, F.col("numerator") / F.col("denominator")))


def evictions(cache: DataFrame, budget: int | None, max_age: float | None = None, now: float = 0.0, partitions: Sequence[str] = ()) -> DataFrame:
    """Cache entries with ``evict``: of the unpinned ones older than ``max_age``, the oldest (mtime, then key) while the total is over budget.

    Without ``max_age`` all unpinned ones are candidates, without ``budget``
    all candidates go.  Pinned entries stay and do not count.  The running
    total is taken over ranges of the whole cache, or within ``partitions``.
    """
    free = F.when(~F.col("pinned"), F.col("size_bytes")).otherwise(0).cast("long")
    rows = cache.withColumn("_free", free)
    if partitions:
        mine = Window.partitionBy(*partitions)
        upto = F.sum("_free").over(mine.orderBy("mtime", "cache_key").rowsBetween(Window.unboundedPreceding, 0))
        rows = rows.withColumns({"_before": upto - F.col("_free"), "_total": F.sum("_free").over(mine)})
    else:
        totals = rows.agg(F.sum("_free").alias("_total"))
        rows = running_total(rows, "_free", F.col("mtime"), F.col("cache_key"), name="_upto").crossJoin(F.broadcast(totals))  # one row
        rows = rows.withColumn("_before", F.col("_upto") - F.col("_free"))
    over = F.lit(True) if budget is None else F.col("_total") - F.col("_before") > budget
    old = F.lit(True) if max_age is None else F.lit(now) - F.col("mtime") > max_age
    return rows.withColumn("evict", ~F.col("pinned") & over & old).select(*cache.columns, "evict")


def cache_size(entries: DataFrame) -> DataFrame:
    """Entries of a cache, their bytes, and whether none is empty."""
    return entries.agg(F.count("*").alias("n"), F.sum("size_bytes").alias("total_bytes"), F.bool_and(F.col("size_bytes") > 0).alias("complete"))


def largest(entries: DataFrame, n: int, by: str = "size_bytes") -> DataFrame:
    """The ``n`` largest entries; of equal ones the lesser key."""
    return entries.orderBy(F.desc(by), "cache_key").limit(n)


def approximate(rows: DataFrame, by: Sequence[str], distinct: Sequence[str] = (), quantiles: dict[str, Sequence[float]] | None = None, error: float = 0.05, accuracy: int = 10_000) -> DataFrame:
    """Extension: distinct counts within a relative deviation and percentiles within 1 / ``accuracy`` of the rank, without sorting.

    Columns n, n_<column> and <column>_q (an array).
    """
    counts = [F.approx_count_distinct(c, error).alias(f"n_{c}") for c in distinct]
    ranks = [F.percentile_approx(c, list(q), accuracy).alias(f"{c}_q") for c, q in (quantiles or {}).items()]
    return rows.groupBy(*by).agg(F.count("*").alias("n"), *counts, *ranks)
