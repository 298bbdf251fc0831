"""Whole analyses: from per-trade outcomes to verdicts, composed of the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.functions.semantics import ge, gt
from quillon.operators import gates, records, reduce, stats


def analyze_cells(values: DataFrame, trades: DataFrame, cell: Sequence[str], control: Column, invariant: Column | None = None, drop: int = 5, replicates: int = stats.REPLICATES) -> DataFrame:
    """Many-seed analysis of each cell.

    ``values`` (cell, idx, value) are pooled and resampled; ``trades`` (cell,
    seed, trade_idx, pnl) give the mean without each seed's ``drop`` largest.
    Returns mean, lo, hi, trimmed_mean, verdict and exit_code.
    """
    ci = stats.enough_data(stats.bootstrap_mean(values, cell, replicates))
    rows = ci.join(reduce.trimmed_means(trades, cell, drop), list(cell))
    verdict = gates.verdict_seeds(F.col("mean"), F.col("lo"), F.col("trimmed_mean"), control, F.lit(True) if invariant is None else invariant)
    return rows.withColumn("verdict", verdict).withColumn("exit_code", gates.exit_code(F.col("verdict")))


def complete(expected: DataFrame, actual: DataFrame, on: Sequence[str]) -> DataFrame:
    """The actual rows, or an error that names a missing cell."""
    gaps = records.expected_missing(expected, actual, on).agg(F.count("*").alias("n"), F.min(F.concat_ws("/", *on)).alias("first"))
    guard = F.when(F.col("n") > 0, F.raise_error(F.concat_ws(" ", F.col("n").cast("string"), F.lit("cells are missing, first"), "first"))).otherwise(F.lit(True))
    return actual.crossJoin(gaps).filter(guard).drop("n", "first")  # one row


def analyze_horizons(rows: DataFrame, thresholds: DataFrame, invariant: DataFrame, numerator: str, denominator: str, ratio_floor: float = 0.8, control_floor: float = -0.005, arms_needed: int = 3, cells_needed: int = 4, controls_needed: int = 2) -> DataFrame:
    """Horizon analysis, one row: arms whose correlation falls with the horizon, cells where one model reaches a share of
    another's, arms whose mean over thresholds clears the control floor, and the verdict.

    ``rows``: model, ret, horizon, ic.  ``thresholds``: model, ret, horizon,
    threshold, n, mean.  ``invariant``: ok (one row).  Controls are looked at
    on the shortest horizon.
    """
    decays = reduce.strictly_decreasing(rows, ["model", "ret"], "horizon", "ic").agg(F.count_if("decays").alias("arms"))
    share = reduce.baseline_ratio(rows, ["ret", "horizon"], "model", "ic", numerator, denominator)
    cells = share.agg(F.count_if(ge(F.col("ratio"), F.lit(ratio_floor))).alias("cells"))
    short = thresholds.agg(F.min("horizon").alias("horizon"))
    means = reduce.equal_weight(thresholds.join(short, "horizon", "left_semi"), ["model", "ret"])
    controls = means.agg(F.count_if(gt(F.col("mean"), F.lit(control_floor))).alias("controls"))
    one = decays.crossJoin(cells).crossJoin(controls).crossJoin(invariant.select("ok"))  # single rows
    verdict = gates.verdict_horizons(F.col("arms") >= arms_needed, F.col("cells") >= cells_needed, F.col("controls") >= controls_needed, F.col("ok"), F.col("arms"))
    return one.withColumn("verdict", verdict).withColumn("exit_code", gates.exit_code(F.col("verdict")))


def analyze_points(values: DataFrame, thresholds: DataFrame, correlations: DataFrame, cell: Sequence[str], ic_floor: float = 0.05, margin: float = 0.01, replicates: int = stats.REPLICATES, invariant: DataFrame | None = None) -> DataFrame:
    """Point-return analysis of each cell: interval of the pooled mean, mean over thresholds, interval of per-seed
    correlations (plain bootstrap), and the verdict; an interval within ``margin`` of 0 is borderline.

    ``invariant`` (cell, ok): a cell that it does not hold or does not name is aborted.
    """
    ci = stats.enough_data(stats.bootstrap_mean(values, cell, replicates)).select(*cell, "mean", "lo", "hi")
    means = reduce.equal_weight(thresholds, cell).select(*cell, F.col("mean").alias("mean_thresholds"))
    ics = stats.bootstrap_mean(correlations, cell, replicates, length=1).select(*cell, F.col("lo").alias("ic_lo"))
    rows = ci.join(means, list(cell), "left").join(ics, list(cell), "left")
    if invariant is None:
        rows = rows.withColumn("ok", F.lit(True))
    else:
        rows = rows.join(invariant.groupBy(*cell).agg(F.bool_and("ok").alias("ok")), list(cell), "left")
    close = (F.abs("lo") <= margin) & (F.abs("hi") <= margin)
    verdict = gates.verdict_points(gt(F.col("lo"), F.lit(0.0)), gt(F.col("mean_thresholds"), F.lit(0.0)), gt(F.col("ic_lo"), F.lit(ic_floor)), F.col("ok"), close)
    return rows.withColumn("verdict", verdict).drop("ok").withColumn("exit_code", gates.exit_code(F.col("verdict")))


def analyze_precision(predictions: DataFrame, by: Sequence[str], positive: int, floor: float, spread: float, least_seeds: int = 3, replicates: int = stats.REPLICATES, seed: str = "seed") -> DataFrame:
    """Multi-seed precision of a class: mean, spread, plain bootstrap over seeds, and the verdict."""
    each = stats.precision(predictions, [*by, seed], positive)
    n = reduce.seed_statistics(each, by, "precision")
    from pyspark.sql import Window

    place = (F.row_number().over(Window.partitionBy(*by).orderBy(seed)) - 1).cast("long")
    ci = stats.bootstrap_mean(each.select(*by, place.alias("idx"), F.col("precision").alias("value")), by, replicates, length=1).select(*by, "lo", "hi")
    distinct = each.groupBy(*by).agg((F.count_distinct("n_hit", "n_predicted") > 1).alias("distinct_ok"))
    rows = n.join(ci, list(by)).join(distinct, list(by))
    return rows.withColumn("verdict", gates.verdict_precision(F.col("mean"), F.col("std_sample"), F.col("lo"), F.col("n"), F.col("distinct_ok"), floor, spread, least_seeds))


def compare_precision(pairs: DataFrame, by: Sequence[str], first: str, second: str) -> DataFrame:
    """Paired test of two models' correctness flags, and which one is better."""
    out = stats.mcnemar(pairs, by, first, second)
    n = F.col("a") + F.col("b") + F.col("c") + F.col("d")
    return out.withColumn("verdict", gates.verdict_paired((F.col("a") + F.col("b")) / n, (F.col("a") + F.col("c")) / n, F.col("p_two_sided")))


