"""Gates and verdicts: checks as columns, and the state machines that read them.

Every threshold is a parameter; a check on a missing number fails or is
skipped as its docstring says, and NaN satisfies nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.functions.semantics import choose, finite, ge, gt, is_finite, lt


def floor_check(value: Column, floor: Column | float) -> Column:
    """pass at or above the floor, fail below, skip when the value is null."""
    return choose((finite(value).isNull(), "skip"), (ge(value, F.lit(floor) if isinstance(floor, float) else floor), "pass"), otherwise="fail")


def prior_check(value: Column, prior: Column, least: float) -> Column:
    """Compare with the best earlier value: at least ``least`` times it.

    A ratio of 0 or less turns the check off.  A prior of 0 is no baseline and
    passes any value; against a negative prior the value itself must not be
    lower.
    """
    if least <= 0:
        return F.lit("skip")
    return choose(
        (finite(value).isNull() | finite(prior).isNull(), "skip"),
        ((prior == 0) | ((prior < 0) & ge(value, prior)), "pass"),
        (prior < 0, "fail"),
        (ge(F.try_divide(value, prior), F.lit(least)), "pass"),
        otherwise="fail",
    )


def cost_check(rmse: Column, mae: Column, breakeven: float) -> Column:
    """Warn when predictions are too small to trade: their magnitude (rmse; mae where that is 0 or missing) is below break-even.

    Skip without either, and where break-even is 0 or less.
    """
    if breakeven <= 0:
        return F.lit("skip")
    magnitude = F.coalesce(F.nullif(finite(rmse), F.lit(0.0)), finite(mae))
    return choose((magnitude.isNull(), "skip"), (ge(magnitude, F.lit(breakeven)), "pass"), otherwise="warn")


def sign_flip_check(ic: Column, floor: float, accuracy: Column, p: Column, alpha: float = 0.05, primary: Column | str = "ic") -> Column:
    """Warn when a good rank correlation comes with a directional accuracy significantly below a coin.

    Skip without an accuracy, when the ``primary`` metric's name does not end
    in "ic", or when the correlation is missing or below its floor (the floor
    check's case).
    """
    primary = F.lit(primary) if isinstance(primary, str) else primary
    skip = finite(accuracy).isNull() | ~F.coalesce(primary.endswith("ic"), F.lit(False)) | ~ge(ic, F.lit(floor))
    return choose((skip, "skip"), (lt(accuracy, F.lit(0.5)) & lt(p, F.lit(alpha)), "warn"), otherwise="pass")


def roll_up(checks: DataFrame, key: Sequence[str], on_regression: str = "warn", record_only: bool = False) -> DataFrame:
    """One status for each key from (key, check, status) rows, with the failed and warned checks named.

    Any failure gives abort or warn as ``on_regression`` says, else any warning
    warns, else pass; ``record_only`` passes whatever was found.
    """
    fail, warn = F.bool_or(F.col("status") == "fail"), F.bool_or(F.col("status") == "warn")
    status = F.lit("pass") if record_only else choose((fail, "abort" if on_regression == "abort" else "warn"), (warn, "warn"), otherwise="pass")
    named = lambda s: F.array_join(F.array_sort(F.collect_list(F.when(F.col("status") == s, F.col("check")))), ",")
    return checks.groupBy(*key).agg(status.alias("status"), F.concat_ws("; ", F.concat(F.lit("fail: "), F.nullif(named("fail"), F.lit(""))), F.concat(F.lit("warn: "), F.nullif(named("warn"), F.lit("")))).alias("summary"))


def disposition(failed: Column, policy: str) -> Column:
    """What a failed gate does under a policy: warn, abort or record_only."""
    if policy not in ("warn", "abort", "record_only"):
        raise ValueError(f"not a policy: {policy!r}")
    return F.when(failed & F.lit(policy != "record_only"), policy).otherwise("pass")


def _no(c: Column) -> Column:
    return ~F.coalesce(c, F.lit(False))


def _all(*cs: Column) -> Column:
    out = F.lit(True)
    for c in cs:
        out = out & F.coalesce(c, F.lit(False))
    return out


def exit_code(verdict: Column) -> Column:
    """0 GO, 2 ABORT, 3 INCOMPLETE (cells of the sweep are missing), else 1."""
    return choose((verdict == "GO", 0), (verdict == "ABORT", 2), (verdict == "INCOMPLETE", 3), otherwise=1)


def verdict_seeds(mean: Column, ci_low: Column, trimmed: Column, control_ok: Column, invariant_ok: Column, mean_floor: float = 0.01, control_floor: float = -0.005) -> Column:
    """Many-seed verdict: ABORT without the invariant; GO when mean, interval, trimmed mean and control hold.

    INDETERMINATE when the mean lies strictly between 0 and its floor, the
    interval reaches 0, and the trimmed mean lies strictly between the control
    floor and 0; else REFUTE.
    """
    go = _all(ge(mean, F.lit(mean_floor)), gt(ci_low, F.lit(0.0)), gt(trimmed, F.lit(0.0)), control_ok)
    borderline = _all(gt(mean, F.lit(0.0)), lt(mean, F.lit(mean_floor)), is_finite(ci_low) & (ci_low <= 0), gt(trimmed, F.lit(control_floor)), lt(trimmed, F.lit(0.0)))
    return choose((_no(invariant_ok), "ABORT"), (go, "GO"), (borderline, "INDETERMINATE"), otherwise="REFUTE")


def verdict_horizons(decay_ok: Column, baseline_ok: Column, control_ok: Column, invariant_ok: Column, arms: Column, refute_below: int = 2) -> Column:
    """Horizon verdict: with the invariant, GO when all three hold, INDETERMINATE at exactly ``refute_below`` decaying arms."""
    return choose((_no(invariant_ok), "ABORT"), (_all(decay_ok, baseline_ok, control_ok), "GO"), (arms < refute_below, "REFUTE"), (arms == refute_below, "INDETERMINATE"), otherwise="REFUTE")


def verdict_points(ci_ok: Column, mean_ok: Column, ic_ok: Column, invariant_ok: Column, borderline: Column) -> Column:
    """Point-return verdict: a failed interval that is borderline is INDETERMINATE when the mean over thresholds holds."""
    return choose((_no(invariant_ok), "ABORT"), (_all(ci_ok, mean_ok, ic_ok), "GO"), (_all(~ci_ok, borderline, mean_ok), "INDETERMINATE"), otherwise="REFUTE")


def verdict_precision(mean: Column, std: Column, ci_low: Column, n_seeds: Column, distinct_ok: Column, floor: float, spread: float, least_seeds: int) -> Column:
    """Multi-seed precision: ABORT_INVARIANT, INSUFFICIENT, GO, UNSTABLE, WEAK or REFUTE."""
    return choose(
        (_no(distinct_ok), "ABORT_INVARIANT"),
        (n_seeds < least_seeds, "INSUFFICIENT"),
        (_all(ge(mean, F.lit(floor)), gt(ci_low, F.lit(floor)), is_finite(std) & (std <= spread)), "GO"),
        (_all(ge(mean, F.lit(floor)), gt(std, F.lit(spread))), "UNSTABLE"),
        (ge(mean, F.lit(floor)), "WEAK"),
        otherwise="REFUTE",
    )


def verdict_paired(first: Column, second: Column, p: Column, alpha: float = 0.05) -> Column:
    """Which of two paired precisions is better, if the difference is significant."""
    return choose((~(is_finite(first) & is_finite(second) & is_finite(p)), "UNDEFINED"), (ge(p, F.lit(alpha)), "NO_DIFFERENCE"), (first > second, "FIRST_BETTER"), (first < second, "SECOND_BETTER"), otherwise="NO_DIFFERENCE")


def gate_table(rows: DataFrame, key: Sequence[str], gates: dict[str, Column]) -> DataFrame:
    """(key, check, status): named boolean conditions as pass or fail rows; null fails."""
    each = F.array(*[F.struct(F.lit(n).alias("check"), F.when(F.coalesce(c, F.lit(False)), "pass").otherwise("fail").alias("status")) for n, c in gates.items()])
    return rows.select(*key, F.inline(each))


def count_verdict(checks: DataFrame, key: Sequence[str], outcomes: Sequence[tuple[str, Sequence[str]]], otherwise: str) -> DataFrame:
    """A verdict for each key: the first outcome all of whose named checks pass (architecture gates)."""
    passed = checks.groupBy(*key).agg(F.collect_set(F.when(F.col("status") == "pass", F.col("check"))).alias("passed"), F.count_if(F.col("status") == "pass").alias("n_pass"), F.count("*").alias("n_checks"))
    has = lambda names: F.size(F.array_except(F.array(*[F.lit(n) for n in names]), F.col("passed"))) == 0
    return passed.withColumn("verdict", choose(*[(has(names), name) for name, names in outcomes], otherwise=otherwise)).drop("passed")


def stale_inputs(signals: DataFrame, sweep: DataFrame) -> DataFrame:
    """Signals whose metadata belong to another sweep, or were written before their run began."""
    joined = signals.join(sweep.select("experiment_id", F.col("sweep_id").alias("own_sweep"), "started_at"), "experiment_id", "left")
    wrong = ~F.col("sweep_id").eqNullSafe(F.col("own_sweep"))
    return joined.withColumn("reason", choose((F.col("own_sweep").isNull(), "unknown run"), (wrong, "other sweep"), (F.col("written_at") < F.col("started_at"), "older than run"))).filter("reason IS NOT NULL")
