"""Many-seed judgement of an architecture: sixteen gates over an arm's seeds and one of seven outcomes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillon.functions.semantics import choose, ge, gt, is_finite, lt
from quillon.operators import gates, stats

# Bounds registered before the runs.
H10_FLOOR, H10_LOW_FLOOR, H10_PARTIAL, H10_CLEAR = 0.30, 0.10, 0.3247, 0.3747
H60_FLOOR, H300_FLOOR, H10_SPREAD = 0.10, 0.05, 0.040
AGREEMENT_LOW, AGREEMENT_HIGH, AGREEMENT_SPREAD = 0.4, 0.9, 0.05
DISTINCT_PREDICTIONS = 4

# Names of the gates.
INVARIANTS = ["H3.a_compat_populated", "H3.b_compat_identical", "H3.c_eph_populated", "H3.d_eph_identical", "H3.e_mch_populated_identical"]
EMITTED, IN_BAND, SPREAD_OUT = "H4.a_emitted", "H4.b_mean_band", "H4.c_std_min"


def seed_summary(seeds: DataFrame, arm: Sequence[str], replicates: int = stats.REPLICATES) -> DataFrame:
    """One row an arm from (arm, seed, h10, h60, h300, compat, provenance_hash, model_hash, prediction_sha, agreement_mean, agreement_std).

    Means of correlations (a missing one makes the mean null), the sample
    deviation of h10 (0 for one seed) and the low end of its plain bootstrap
    interval; how many seeds have each identity and how many identities there
    are.  Seeds are taken in order, equal seeds by their values.
    """
    whole = lambda c: F.when(F.count(c) == F.count("*"), F.avg(c)).alias(c)
    inside = ge(F.col("agreement_mean"), F.lit(AGREEMENT_LOW)) & (F.col("agreement_mean") <= AGREEMENT_HIGH) & is_finite(F.col("agreement_mean"))
    identities = [x for c in ("compat", "provenance_hash", "model_hash") for x in (F.count(c).alias(f"has_{c}"), F.count_distinct(c).alias(f"n_{c}"))]
    out = seeds.groupBy(*arm).agg(
        F.count("*").alias("n_seeds"), whole("h10"), whole("h60"), whole("h300"), F.when(F.count("*") > 1, F.stddev_samp("h10")).otherwise(0.0).alias("h10_std"), *identities,
        F.count_distinct("prediction_sha").alias("n_predictions"), F.count("agreement_mean").alias("has_agreement"),
        F.count_if(inside).alias("in_band"), F.count_if(gt(F.col("agreement_std"), F.lit(AGREEMENT_SPREAD))).alias("spread_out"),
    )
    place = (F.row_number().over(Window.partitionBy(*arm).orderBy("seed", "h10", "prediction_sha")) - 1).cast("long")  # a few seeds an arm
    low = stats.bootstrap_mean(seeds.select(*arm, place.alias("idx"), F.col("h10").alias("value")), arm, replicates, length=1)
    return out.join(low.select(*arm, F.col("lo").alias("h10_low")), list(arm))


def seed_gates(summary: DataFrame, arm: Sequence[str]) -> DataFrame:
    """(arm, check, status) of the sixteen gates; the two on agreement values are left out where a seed has none."""
    c, n = F.col, F.col("n_seeds")
    one = lambda name: (c(f"has_{name}") == n) & (c(f"n_{name}") == 1)
    checks = {
        "H1.a_floor": gt(c("h10"), F.lit(H10_FLOOR)),
        "H1.b_ci_lower": gt(c("h10_low"), F.lit(H10_LOW_FLOOR)),
        "H1.c_partial_lift": gt(c("h10"), F.lit(H10_PARTIAL)),
        "H1.d_clear_lift": gt(c("h10"), F.lit(H10_CLEAR)),
        "H2.a_h60": gt(c("h60"), F.lit(H60_FLOOR)),
        "H2.b_h300": gt(c("h300"), F.lit(H300_FLOOR)),
        "H2.c_sigma_ceiling": lt(c("h10_std"), F.lit(H10_SPREAD)),
        **dict(zip(INVARIANTS, (c("has_compat") == n, one("compat"), c("has_provenance_hash") == n, one("provenance_hash"), one("model_hash")), strict=True)),
        "H3.f_pred_divergence": c("n_predictions") >= DISTINCT_PREDICTIONS,
        EMITTED: c("has_agreement") == n,
        IN_BAND: c("in_band") == n,
        SPREAD_OUT: c("spread_out") == n,
    }
    given = ~F.col("check").isin(IN_BAND, SPREAD_OUT) | F.col("emitted")
    table = gates.gate_table(summary.withColumn("emitted", c("has_agreement") == n), [*arm, "emitted"], checks)
    return table.filter(given).drop("emitted")


def outcomes(checks: DataFrame, arm: Sequence[str]) -> DataFrame:
    """The outcome of each arm: broken invariants come first, then the floors, the spread of the seeds, and how far the lift reaches."""
    passed = checks.groupBy(*arm).agg(F.collect_set(F.when(F.col("status") == "pass", F.col("check"))).alias("passed"), F.count_if(F.col("status") == "pass").alias("n_pass"), F.count("*").alias("n_checks"))
    has = lambda *names: F.size(F.array_except(F.array(*[F.lit(x) for x in names]), F.col("passed"))) == 0
    horizons = has("H2.a_h60", "H2.b_h300")
    sound = horizons & has(IN_BAND, SPREAD_OUT)
    verdict = choose(
        (~has(*INVARIANTS, EMITTED), "ABORT"),
        (~has("H1.a_floor", "H1.b_ci_lower"), "REFUTE"),
        (~has("H2.c_sigma_ceiling"), "INDETERMINATE-DOWNGRADED-NEED-N10"),
        (sound & has("H1.d_clear_lift"), "GO-CLEAR-LIFT"),
        (sound & has("H1.c_partial_lift"), "GO-COMPETITIVE"),
        (horizons & ~has("H1.c_partial_lift"), "PARTIAL-LIFT"),
        otherwise="INDETERMINATE",
    )
    return passed.withColumn("verdict", verdict).drop("passed")


def analyze_architecture(seeds: DataFrame, arm: Sequence[str], replicates: int = stats.REPLICATES) -> DataFrame:
    """Outcome of each arm (n_pass, n_checks, verdict) from its seeds; see :func:`seed_summary` for the columns."""
    return outcomes(seed_gates(seed_summary(seeds, arm, replicates), arm), arm)
