"""Seed gates and outcomes, paired precision by published figures, postconditions, artifacts and record parts."""

import json

import pytest

from quillon.operators import records, reduce, scheduling, stats, validation
from quillon.plans import analyzers, architecture
from quillon.sources import sinks

COLUMNS = "arm string, seed int, h10 double, h60 double, h300 double, compat string, provenance_hash string, model_hash string, prediction_sha string, agreement_mean double, agreement_std double"


def arm(name, h10=0.40, h60=0.2, h300=0.1, spread=0.01, compat="c", agreement=0.6, predictions=5, agreement_std=0.2):
    return [(name, i, h10 + spread * (i - 2), h60, h300, compat if compat != "own" else str(i), "p", "m", str(i % predictions), agreement, agreement_std) for i in range(5)]


CASES = {
    "clear": (dict(), "GO-CLEAR-LIFT", 16),
    "competitive": (dict(h10=0.35), "GO-COMPETITIVE", 15),
    "partial": (dict(h10=0.31, agreement=0.95), "PARTIAL-LIFT", 13),
    "spread": (dict(spread=0.05), "INDETERMINATE-DOWNGRADED-NEED-N10", 15),
    "floor": (dict(h10=0.2), "REFUTE", 13),
    "own_identity": (dict(compat="own"), "ABORT", 15),
    "no_identity": (dict(compat=None), "ABORT", 14),
    "silent": (dict(agreement=None), "ABORT", 13),
    "horizon": (dict(h60=0.05), "INDETERMINATE", 15),
    "band": (dict(agreement=0.3), "INDETERMINATE", 15),
    "few_predictions": (dict(predictions=3), "GO-CLEAR-LIFT", 15),
    "no_h300": (dict(h300=None), "INDETERMINATE", 15),
}


def test_outcomes(spark):
    seeds = spark.createDataFrame([r for name, (changes, _, _) in CASES.items() for r in arm(name, **changes)], COLUMNS)
    out = {r["arm"]: r for r in architecture.analyze_architecture(seeds, ["arm"], 200).collect()}
    assert {k: (r["verdict"], r["n_pass"]) for k, r in out.items()} == {k: (v, n) for k, (_, v, n) in CASES.items()}
    assert {k for k, r in out.items() if r["n_checks"] != 16} == {"silent"}
    assert architecture.analyze_architecture(seeds.limit(0), ["arm"], 200).count() == 0


def test_low_end_refutes(spark):
    rows = [("a", i, v, 0.2, 0.1, "c", "p", "m", str(i), 0.6, 0.2) for i, v in enumerate([0.9, 0.9, -0.3, -0.3, 0.6])]
    gates = {r["check"]: r["status"] for r in architecture.seed_gates(architecture.seed_summary(spark.createDataFrame(rows, COLUMNS), ["arm"], 2000), ["arm"]).collect()}
    assert len(gates) == 16 and gates["H1.a_floor"] == "pass" and gates["H1.b_ci_lower"] == "fail" and gates["H2.c_sigma_ceiling"] == "fail"


def test_published_paired_precision(spark):
    cells = [(True, True)] * 1077 + [(True, False)] * 538 + [(False, True)] * 381 + [(False, False)] * 15484
    r = stats.mcnemar(spark.createDataFrame([("all", *c) for c in cells], "g string, x boolean, y boolean"), ["g"], "x", "y").first()
    assert (r["a"], r["b"], r["c"], r["d"]) == (1077, 538, 381, 15484)
    assert r["chi2"] == pytest.approx(26.48095756256801) and r["p_two_sided"] == pytest.approx(2.6614880087541583e-07) and r["p_one_sided"] == pytest.approx(1.248135592415494e-07)
    made = spark.createDataFrame([("first", 1458, 6635), ("second", 1615, 6006)], "name string, k long, n long")
    lo, hi = stats.wilson(made["k"], made["n"])
    got = {r["name"]: (r["lo"], r["hi"]) for r in made.select("name", lo.alias("lo"), hi.alias("hi")).collect()}
    assert got["first"] == pytest.approx((0.20994418099733297, 0.2298677164446895)) and got["second"] == pytest.approx((0.2578346795208422, 0.2802562969182048))


def test_postconditions(spark):
    results = spark.createDataFrame([("r", "a", "completed", None), ("r", "b", "completed", "slow"), ("r", "c", "failed", "broke"), ("r", "d", "skipped", None), ("r", "e", "completed", None)], "run_id string, stage string, status string, error_message string")
    broken = spark.createDataFrame([("r", "b", "y"), ("r", "b", "x"), ("r", "c", "x"), ("r", "d", "x"), ("r", "e", None)], "run_id string, stage string, violation string")
    out = {r["stage"]: r for r in scheduling.postconditions(results, broken).collect()}
    assert {k: r["status"] for k, r in out.items()} == {"a": "completed", "b": "failed", "c": "failed", "d": "skipped", "e": "completed"}
    assert out["b"]["error_message"] == "slow\noutputs are not as promised (2): x; y" and out["b"]["output_validation_errors"] == ["x", "y"]
    assert out["c"]["error_message"] == "broke" and out["c"]["output_validation_errors"] is None


def test_model_table(spark):
    models = validation.model_table(spark)
    assert models.count() == 11
    runs = spark.createDataFrame([("1", "deeplob", 39, 20, "x"), ("2", "deeplob", 99, 19, "x"), ("3", "tlob", 5, 3, "x"), ("4", "gru", 1, 1, "x"), ("5", "new", 1, 1, "x"), ("6", "new", 0, 1, "x"), ("7", "gru", 0, 0, "x")], "run_id string, model string, n_features int, sequence_length int, source string")
    got = sorted((r["context"], r["severity"], r["rule"]) for r in validation.input_contracts(runs, models).collect())
    assert got == [("1", "error", "min_features"), ("2", "error", "max_features"), ("2", "error", "sequence"), ("3", "error", "sequence"), ("5", "warn", "model"), ("6", "error", "positive"), ("7", "error", "min_features"), ("7", "error", "sequence")]


def test_artifacts_by_name(spark):
    files = spark.createDataFrame([("x/test_metrics_ci_v1.json", '{"n": 3}'), ("y/test_metrics_ci_v1.json", "[1]"), ("z/pairwise_compare_v1.json", "{"), ("z/feature_importance_v1.json", None), ("z/other.json", "{}")], "path string, text string")
    out = {r["path"]: (r["kind"], r["valid"]) for r in sinks.route_artifacts(files).collect()}
    assert out == {"x/test_metrics_ci_v1.json": ("test_metrics_ci", True), "y/test_metrics_ci_v1.json": ("test_metrics_ci", False), "z/pairwise_compare_v1.json": ("pairwise_compare", False), "z/feature_importance_v1.json": ("feature_importance", False)}
    from pyspark.sql import functions as F

    strict = sinks.route_artifacts(files, {"test_metrics_ci": lambda text: F.get_json_object(text, "$.n") > 5})
    assert [r["valid"] for r in strict.filter("path LIKE 'x/%'").collect()] == [False]


def test_record_parts(spark):
    one = lambda **commits: json.dumps({"producer_commits": commits})
    rows = spark.createDataFrame([("a", one(x="a" * 40, y="unresolved", z="same", w=None)), ("b", one(x="b" * 40, y="v2", z="same")), ("c", None)], "experiment_id string, provenance string")
    assert [tuple(r) for r in records.commit_changes(rows, "a", "b").collect()] == [("x", "a" * 12 + "...", "b" * 12 + "..."), ("y", "unresolved", "v2")]
    assert [r["b"] for r in records.commit_changes(rows, "a", "c").collect()] == ["(none)"] * 3
    full = rows.selectExpr("experiment_id", *[f"'x' AS {c}" for c in records.BUILT_FIELDS[1:]], "1 AS notes")
    assert tuple(records.built(full).columns) == records.BUILT_FIELDS and len(records.BUILT_FIELDS) == 20
    places = spark.sql("SELECT map('test_ic', 'bad') AS a, map('test_ic', '0.5') AS b, map('test_ic', '0.7') AS c, map('other', '1') AS d")
    ic = places.select(records.metric_from("test_ic", places.a, places.b, places.c).alias("x"), records.metric_from("test_ic", places.d).alias("y"), records.metric_from("test_ic", places.d, missing=float("nan")).alias("z")).first()
    assert ic["x"] == 0.5 and ic["y"] is None and ic["z"] != ic["z"]


def test_approximate(spark):
    rows = spark.range(10_000).selectExpr("id % 2 AS g", "id % 100 AS v", "id AS w")
    for r in reduce.approximate(rows, ["g"], ["v"], {"w": [0.5]}, error=0.02).collect():
        assert r["n"] == 5000 and abs(r["n_v"] - 50) <= 3 and abs(r["w_q"][0] - 5000) <= 5


def test_points_without_invariant_abort(spark):
    values = spark.createDataFrame([(c, i, 0.5) for c in "abc" for i in range(20)], "cell string, idx long, value double")
    thresholds = spark.createDataFrame([(c, 20, 0.5) for c in "abc"], "cell string, n long, mean double")
    ok = spark.createDataFrame([("a", True), ("b", False)], "cell string, ok boolean")
    out = analyzers.analyze_points(values, thresholds, values, ["cell"], replicates=50, invariant=ok)
    assert {r["cell"]: r["verdict"] for r in out.collect()} == {"a": "GO", "b": "ABORT", "c": "ABORT"}
