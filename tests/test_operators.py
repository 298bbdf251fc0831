import hashlib
import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillon.operators import gates, grid, identity, ranking, records, reduce, scheduling, stats, validation
from quillon.plans import analyzers


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_compare_edges(spark):
    df = spark.createDataFrame([("a", 0, 1.0), ("b", 1, None), ("c", 2, float("nan")), ("d", 3, 1.0), ("e", 4, 2.0)], "experiment_id string, ordinal long, m double")
    assert [r[0] for r in records.compare(df, ["m"], "m").collect()] == ["e", "a", "d", "b", "c"]
    assert [r[0] for r in records.compare(df, ["m"], "m", ascending=True).collect()] == ["a", "d", "e", "b", "c"]
    assert records.compare(df.limit(0), ["m"], "m", k=3).count() == 0
    with pytest.raises(ValueError):
        records.compare(df, ["x.m", "y.m"], "x.m")
    with pytest.raises(ValueError):
        records.compare(df, ["m"], "n")


def test_global_rank(spark):
    df = spark.range(0, 5000, 1, 7).select((F.col("id") * 7919 % 5000).alias("v"), "id")
    assert [r["rank"] for r in ranking.global_rank(df, F.col("v").asc()).orderBy("v").collect()] == list(range(1, 5001))
    assert ranking.global_rank(df.limit(0), F.col("v").asc()).count() == 0


def test_filter_truthiness(spark):
    df = spark.createDataFrame([("", None, ["x"]), ("f" * 64, 0.5, [])], "fingerprint string, f1 double, tags array<string>")
    assert records.filter_records(df, records.RecordFilter(fingerprint="")).count() == 1
    assert records.filter_records(df, records.RecordFilter(floors={"f1": 0.1})).count() == 1
    assert records.filter_records(df, records.RecordFilter(floors={"absent": 0.1})).count() == 0
    assert records.filter_records(df, records.RecordFilter(tags=["x"])).count() == 1
    with pytest.raises(ValueError):
        records.filter_records(df, records.RecordFilter(fingerprint="zz"))


def test_prior_best_wildcards(spark):
    df = spark.createDataFrame([(0, "a", None, 1.0), (1, "a", 10, 3.0), (2, "a", None, 3.0)], "ordinal long, model string, h int, m double")
    assert rows(records.prior_best(df, "m", {"model": "a", "h": ""}), "ordinal", "n_matches") == [(1, 3)]
    assert records.prior_best(df, "m", {"model": "", "h": None}).count() == records.prior_best(df, "m", {"model": "", "h": 0}).count() == 0
    typed = df.withColumn("record_type", F.when(F.col("ordinal") == 1, "backtest"))
    assert rows(records.prior_best(typed, "m", {"model": "a", "h": ""}), "ordinal", "n_matches") == [(2, 2)]
    assert rows(records.prior_best(df.withColumn("m", F.lit(float("nan"))), "m", {"model": "a"}), "ordinal", "n_matches") == [(None, 3)]
    assert records.prior_best(df, "m", {"model": "", "h": ""}).count() == 0


def test_new_only_failure_first(spark):
    old = spark.createDataFrame([(0, "f", "sweep_failure"), (1, "f", "training"), (2, "g", "sweep_failure")], "ordinal long, fingerprint string, record_type string")
    new = spark.createDataFrame([("f",), ("g",), ("h",)], "fingerprint string")
    assert rows(records.new_only(new, old), "fingerprint") == [("g",), ("h",)]
    assert rows(records.new_only(new, old, first_match_compat=True), "fingerprint") == [("f",), ("g",), ("h",)]


def test_diff_and_overlay(spark):
    a = spark.createDataFrame([("x", "1"), ("y", "a"), ("z", None)], "path string, value string")
    b = spark.createDataFrame([("x", "3"), ("y", "a"), ("w", "2")], "path string, value string")
    assert rows(records.diff_maps(a, b).fillna("-", ["a", "b"]), "path", "a", "b") == [("w", "-", "2"), ("x", "1", "3"), ("z", "-", "-")]
    ledger = spark.createDataFrame([("f1", "r1"), ("f2", "r2")], "fingerprint string, name string")
    verdicts = spark.createDataFrame([("f1", 0, "GO"), ("f1", 1, "REFUTE"), ("f9", 2, "GO"), (None, 3, "GO")], "fingerprint string, ordinal long, verdict string")
    out = records.overlay(ledger, verdicts, ["verdict"]).fillna("-")
    assert rows(out, "fingerprint", "name", "verdict", "source") == [("f1", "r1", "REFUTE", "ledger"), ("f2", "r2", "-", "ledger"), ("f9", "-", "GO", "discovery")]


def test_reductions(spark):
    h = spark.createDataFrame([(1, 0, float("nan"), 0.2), (1, 1, None, 0.9), (2, 0, 3.0, 0.1), (2, 1, 1.0, 0.2), (2, 2, 1.0, 0.3)], "experiment_id long, epoch long, val_loss double, val_macro_f1 double")
    assert rows(reduce.history_summary(h), "experiment_id", "best_epoch", "n_epochs") == [(1, 1, 2), (2, 1, 3)]
    t = spark.createDataFrame([("c", 0, i, float(v)) for i, v in enumerate([1, -9, 2])] + [("c", 1, 0, 5.0)], "cell string, seed int, trade_idx long, pnl double")
    assert rows(reduce.trimmed_means(t, ["cell"], 1), "cell", "trimmed_mean") == [("c", 0.75)]
    cache = spark.createDataFrame([("a", 1.0, 10, True), ("b", 2.0, 10, False), ("c", 2.0, 10, False), ("d", 3.0, 10, False)], "cache_key string, mtime double, size_bytes long, pinned boolean")
    gone = lambda *a: rows(reduce.evictions(cache, *a).filter("evict"), "cache_key")
    assert gone(20) == [("b",)] and gone(10) == [("b",), ("c",)] and gone(30) == []  # the pinned entry does not count
    assert gone(10, 7.5, 10.0) == [("b",), ("c",)] and gone(0, 7.5, 10.0) == [("b",), ("c",)] and gone(30, 7.5, 10.0) == []
    assert gone(None, 7.5, 10.0) == [("b",), ("c",)]
    assert rows(reduce.evictions(cache.withColumn("p", F.lit(1)), 10, partitions=["p"]).filter("evict"), "cache_key") == [("b",), ("c",)]
    runs = spark.createDataFrame([("r", 0, True, None, 9.0), ("r", 1, True, 2.0, 1.0), ("s", 0, True, None, 1.0), ("s", 1, True, None, 3.0), ("t", 0, False, 9.0, 1.0), ("t", 1, False, 1.0, 2.0)], "run string, o int, zero_dte boolean, option_return double, total_return double")
    assert rows(reduce.best_threshold(runs, "run", "o"), "run", "o", "score") == [("r", 1, 2.0), ("s", 1, 3.0), ("t", 1, 2.0)]
    kids = spark.createDataFrame([("a", "A", "completed", "f2"), ("a", "A", "partial", "f1"), ("b", "B", "failed", ""), ("b", "B", "partial", None), ("c", "C", "partial", "f3"), ("d", "D", "failed", "x"), ("d", "D", "completed", "x")], "sweep_id string, sweep_name string, status string, fingerprint string").withColumn("duration_seconds", F.lit(1.0))
    made = {r["sweep_id"]: (r["status"], r["fingerprint"]) for r in reduce.rollup(kids).collect()}
    digest = lambda name, *kids: hashlib.sha256(json.dumps({"children": sorted(kids), "sweep_name": name}, sort_keys=True).encode()).hexdigest()
    assert made == {"a": ("completed", digest("A", "f1", "f2")), "b": ("failed", digest("B")), "c": ("unknown", digest("C", "f3")), "d": ("partial", digest("D", "x", "x"))}


def test_bootstrap_contract(spark):
    few = spark.createDataFrame([("a", 0, 1.0), ("a", 1, 3.0)], "cell string, idx long, value double")
    assert rows(stats.bootstrap_mean(few, ["cell"], 10), "mean", "lo", "hi") == [(2.0, 2.0, 2.0)]
    many = spark.createDataFrame([("a", i, float(i % 7)) for i in range(60)], "cell string, idx long, value double")
    r = stats.bootstrap_mean(many, ["cell"], 200).first()
    assert r["lo"] <= r["mean"] <= r["hi"] and r["lo"] < r["hi"]
    assert r == stats.bootstrap_mean(many.repartition(3), ["cell"], 200).first()


def test_bootstrap_by_hand(spark, monkeypatch):
    """Block means by running sums equal means over the drawn places, over several chunks, with a cut last block and bad values."""
    monkeypatch.setattr(stats, "CHUNK", 16)
    for n, bad in ((50, None), (7, None), (40, 11)):
        values = [(-1.5) ** (i % 5) + i / 10 for i in range(n)]
        if bad is not None:
            values[bad] = float("nan")
        df = spark.createDataFrame([("a", "b", i, v) for i, v in enumerate(values)], "x string, y string, idx long, value double").repartition(3)
        got = {r["rep"]: r["m"] for r in stats._resampled_means(df, ["x", "y"], 30, 42, None).collect()}
        size = round(n ** (1 / 3) + 0.499999)
        size = max(1, n // 5) if n // size < 5 else size
        for rep in range(30):
            places = []
            for block in range(-(-n // size)):
                start = int(hashlib.md5(f"42|a/b|{rep}|{block}".encode()).hexdigest()[:8], 16) % (n - size + 1)
                places += range(start, start + size)
            drawn = [values[p] for p in places[:n]]
            want = None if any(v != v for v in drawn) else sum(drawn) / n
            assert (got[rep] is None) == (want is None) and (want is None or abs(got[rep] - want) < 1e-9)


def test_published_pair_of_precisions(spark):
    """A published paired test."""
    two, one = stats.mcnemar_p(538, 381)
    assert math.isclose(two, 2.6614880087541583e-07, rel_tol=1e-6) and math.isclose(one, 1.248135592415494e-07, rel_tol=1e-6)


def test_collision_free_hashes(spark):
    row = spark.range(1)
    h = lambda *xs: row.select(identity.all_or_nothing_hash(*[F.lit(x) for x in xs])).first()[0]
    assert h("a|b", "c") != h("a", "b|c") and h("a", "b") == hashlib.sha256(b'["a","b"]').hexdigest()
    flat = spark.createDataFrame([("u", "p", "1\nq=2", "str"), ("v", "p", "1", "str"), ("v", "q", "2", "str"), ("w", "p", "1", "int"), ("w", "q", "2", "str")], "k string, path string, value string, value_type string")
    assert len({r["fingerprint"] for r in identity.fingerprints(flat, "k").collect()}) == 3
    untyped = identity.fingerprints(flat.drop("value_type"), "k").collect()
    assert len({r["fingerprint"] for r in untyped}) == 2
    assert records.leaves('{"a": {"b": [1, {"c": 2}], "d": {}}, "e": null}') == [("a.b", '[1, {"c": 2}]'), ("a.d", "{}"), ("e", "null")]
    assert records.leaves("[1]") == records.leaves("x") == records.leaves(None) == records.leaves("[" * 10**5) == []


def test_gate_checks(spark):
    """The reference's rules for cost and for the sign of a good correlation."""
    v = lambda x: F.lit(x).cast("double")
    one = lambda c: spark.range(1).select(c.alias("c")).first()["c"]
    for rmse, mae, least, want in ((5.0, None, 4.0, "pass"), (3.0, 9.0, 4.0, "warn"), (0.0, 9.0, 4.0, "pass"), (None, 4.0, 4.0, "pass"), (None, None, 4.0, "skip"), (1.0, 1.0, 0.0, "skip")):
        assert one(gates.cost_check(v(rmse), v(mae), least)) == want
    for ic, da, p, primary, want in ((0.2, 0.4, 0.01, "test_ic", "warn"), (0.2, 0.4, 0.2, "test_ic", "pass"), (0.05, 0.4, 0.01, "test_ic", "skip"), (0.2, 0.4, 0.01, "f1", "skip"), (0.2, None, 0.01, "test_ic", "skip"), (None, 0.4, 0.01, "test_ic", "skip")):
        assert one(gates.sign_flip_check(v(ic), 0.1, v(da), v(p), primary=primary)) == want


def test_asof(spark):
    left = spark.createDataFrame([("u", 5, "p"), ("u", 1, "q"), ("w", 9, "r")], "k string, t long, id string")
    right = spark.createDataFrame([("u", 2, 20), ("u", 5, 50), ("u", 7, 70)], "k string, t long, v long")
    assert rows(ranking.asof(left, right, ["k"], "t", "v"), "id", "v") == [("p", 50), ("q", None), ("r", None)]


def test_statistics(spark):
    assert stats.mcnemar_p(0, 0) == (1.0, 1.0)
    assert math.isclose(stats.mcnemar_p(10, 2)[0], 2 * sum(math.comb(12, k) for k in (10, 11, 12)) / 2**12)
    assert math.isclose(stats.binomial_tail(538, 919), 1.2e-7, rel_tol=0.5)
    known = spark.createDataFrame([(1615, 2616)], "k long, n long")
    lo, hi = stats.wilson(F.col("k"), F.col("n"))
    assert [round(x, 3) for x in known.select(lo, hi).first()] == [0.599, 0.636]
    p = spark.createDataFrame([("a", 0.01), ("b", 0.04), ("c", 0.03), ("d", 0.005)], "t string, p double")
    assert {r["t"]: round(r["q"], 6) for r in stats.adjust(p).collect()} == {"a": 0.02, "b": 0.04, "c": 0.04, "d": 0.02}
    x = spark.createDataFrame([("g", 1.0, 1.0), ("g", 2.0, 4.0), ("g", 2.0, 9.0), ("g", 5.0, None)], "g string, x double, y double")
    assert round(stats.spearman(x, ["g"], "x", "y").first()["ic"], 6) == round(1.5 / math.sqrt(3), 6)
    bad = spark.createDataFrame([("a", 0, 1.0, 1.0), ("a", 1, 1.0, float("nan")), ("b", 0, 1.0, 1.0), ("b", 1, 1.0, 1.0)], "treatment string, sample_idx long, label double, pred double")
    with pytest.raises(Exception, match="not finite"):
        stats.paired_mask(bad).collect()
    d = spark.range(1).select(stats.deflated_p(F.lit(40), F.lit(100), F.lit(0.0)).alias("p")).first()["p"]
    assert abs(d - stats.normal_tail(2.0)) < 1e-6


@pytest.mark.parametrize(
    "mean,lo,trim,control,invariant,want",
    [(0.01, 0.001, 0.001, True, True, "GO"), (0.01, 0.001, 0.001, True, False, "ABORT"), (0.01, 0.001, 0.001, True, None, "ABORT"), (0.005, 0.0, -0.001, False, True, "INDETERMINATE"), (0.005, 0.0, 0.0, True, True, "REFUTE"), (0.005, 0.0, -0.005, True, True, "REFUTE"), (float("nan"), 0.1, 0.1, True, True, "REFUTE"), (0.0, -1.0, -0.001, True, True, "REFUTE")],
)
def test_verdict_seeds(spark, mean, lo, trim, control, invariant, want):
    c = [F.lit(x) for x in (mean, lo, trim)]
    v = gates.verdict_seeds(*c, F.lit(control), F.lit(invariant).cast("boolean"))
    r = spark.range(1).select(v.alias("v"), gates.exit_code(v).alias("x")).first()
    assert r["v"] == want and r["x"] == {"GO": 0, "ABORT": 2}.get(want, 1)


def test_prior_check(spark):
    cases = [(1.0, 1.0, 0.9, "pass"), (0.5, 1.0, 0.9, "fail"), (0.0, 0.0, 0.9, "pass"), (-1.0, 0.0, 0.9, "pass"), (-0.5, -1.0, 0.9, "pass"), (-2.0, -1.0, 0.9, "fail"), (None, 1.0, 0.9, "skip"), (1.0, 1.0, 0.0, "skip")]
    for value, prior, least, want in cases:
        c = gates.prior_check(F.lit(value).cast("double"), F.lit(prior), least)
        assert spark.range(1).select(c.alias("c")).first()["c"] == want


def test_gate_tables(spark):
    checks = spark.createDataFrame([("r", "a", "pass"), ("r", "b", "fail"), ("s", "a", "warn"), ("s", "b", "pass"), ("t", "a", "skip")], "k string, check string, status string")
    assert rows(gates.roll_up(checks, ["k"], "abort"), "k", "status") == [("r", "abort"), ("s", "warn"), ("t", "pass")]
    assert rows(gates.roll_up(checks, ["k"], record_only=True), "k", "status") == [("r", "pass"), ("s", "pass"), ("t", "pass")]
    assert rows(gates.count_verdict(checks, ["k"], [("BOTH", ["a", "b"]), ("A", ["a"])], "NONE"), "k", "verdict") == [("r", "A"), ("s", "NONE"), ("t", "NONE")]


def test_identity(spark):
    doc = {"b": [1, 2.5], "a": {"name": "x", "n": float("inf")}}
    want = hashlib.sha256(json.dumps({"a": {"n": None, "name": "x"}, "b": [1, 2.5]}, sort_keys=True).encode()).hexdigest()
    assert identity.content_hash(doc) == want
    assert identity.strip_keys({"a": {"name": 1}, "b": 2, "tags": [1]}) == {"b": 2}
    df = spark.createDataFrame([(json.dumps({"k": 1, "a": 2}),), ("no json",), (None,)], "t string")
    assert [r[0] for r in df.select(identity.canonical_hash(F.col("t"))).collect()] == [identity.content_hash({"a": 2, "k": 1}), None, None]
    one = spark.range(1)
    indices = F.array(*[F.lit(i) for i in (3, 1, 3)])
    assert one.select(identity.set_hash(indices, F.lit(9), F.lit("1.0"))).first()[0] == identity.content_hash({"feature_indices": [1, 3], "source_feature_count": 9, "contract_version": "1.0"})
    assert one.select(identity.all_or_nothing_hash(F.lit("a"), F.lit(""))).first()[0] is None
    manifest = spark.createDataFrame([("k", "a", "h1", 1), ("k", "b", "h2", 2), ("l", "a", "h1", 1)], "cache_key string, path string, sha256 string, size_bytes long")
    found = spark.createDataFrame([("k", "a", "h1", 1), ("l", "a", "h1", 1)], "cache_key string, path string, sha256 string, size_bytes long")
    assert rows(identity.verify_tree(manifest, found), "cache_key", "intact") == [("k", False), ("l", True)]
    have = spark.createDataFrame([("s", "h"), ("u_v2", "h")], "name string, content_hash string")
    new = spark.createDataFrame([("s", "h"), ("u_v2", "x"), ("n", "y")], "name string, content_hash string")
    assert rows(identity.plan_writes(new, have).fillna("-"), "name", "action", "suggested") == [("n", "write", "-"), ("s", "unchanged", "-"), ("u_v2", "refuse", "u_v3")]


def test_selections(spark):
    catalog = spark.createDataFrame([("core", [3, 1, 3])], "name string, feature_indices array<int>")
    runs = spark.createDataFrame([("a", "core", None, None), ("b", None, None, [2, 2, 0])], "run string, set_name string, preset string, indices array<int>")
    assert rows(identity.resolve_selections(runs, catalog), "run", "resolved") == [("a", [1, 3]), ("b", [0, 2])]
    both = spark.createDataFrame([("c", "core", None, [1])], "run string, set_name string, preset string, indices array<int>")
    with pytest.raises(Exception, match="more than one"):
        identity.resolve_selections(both, catalog).collect()


def test_grid(spark):
    schema = "axis string, axis_pos int, label string, value_pos long, overrides map<string,string>"
    axes = spark.createDataFrame([("a", 0, "x", 0, {"k": "1"}), ("a", 0, "y", 1, {"k": "2"}), ("b", 1, "z", 0, {"k": "9", "m": "3"})], schema)
    out = {r["name"]: (r["point"], r["axis_values"], r["overrides"]) for r in grid.expand(axes, "s").collect()}
    assert out == {"s__x_z": (0, {"a": "x", "b": "z"}, {"k": "9", "m": "3"}), "s__y_z": (1, {"a": "y", "b": "z"}, {"k": "9", "m": "3"})}
    assert grid.expand(axes.limit(0), "s").collect()[0]["name"] == "s"
    assert rows(grid.findings(axes), "rule") == [("shared_key",)]
    assert rows(grid.findings(axes.limit(0)), "rule") == [("no_axes",)]
    existing = spark.createDataFrame([("a.b", "1"), ("c", "2")], "path string, value string")
    wanted = spark.createDataFrame([("a.b", "1"), ("c", "3"), ("c.d", "4"), ("e", "5"), ("typo", "6")], "path string, value string")
    known = spark.createDataFrame([("a.b",), ("c",), ("c.d",), ("e",)], "path string")
    assert rows(grid.apply_overrides(existing, wanted, known), "path", "status") == [("a.b", "same"), ("c", "applied"), ("c.d", "conflict"), ("e", "added"), ("typo", "unknown")]
    assert grid.inherit({"a": {"_base": "b", "x": {"p": 1}}, "b": {"x": {"p": 0, "q": 2}}}, "a") == {"x": {"p": 1, "q": 2}}
    with pytest.raises(ValueError):
        grid.inherit({"a": {"_base": "a"}}, "a")
    assert grid.set_path({}, "a.b", 1) == {"a": {"b": 1}} and grid.get_path({"a": {"b": 1}}, "a.c") is None
    with pytest.raises(ValueError):
        grid.set_path({"a": 1}, "a.b", 1, strict=True)


def test_validation(spark):
    declared = spark.createDataFrame([("c", "a"), ("c", "x"), ("d", "b")], "config_id string, key string")
    required = spark.createDataFrame([("a",), ("b",)], "key string")
    assert rows(validation.required_keys(declared, required), "context", "message") == [("c", "missing key b"), ("d", "missing key a")]
    assert rows(validation.unknown_keys(declared, required), "message") == [("unknown key x",)]
    left = spark.createDataFrame([("levels", "10")], "path string, value string")
    right = spark.createDataFrame([("n_levels", "12")], "path string, value string")
    pairs = spark.createDataFrame([("levels", "n_levels")], "path_a string, path_b string")
    assert validation.counts(validation.consistent(left, right, pairs)).first()["errors"] == 1
    labels = spark.createDataFrame([("s", 10), ("s", None)], "label_sha string, horizon int")
    assert validation.paired_labels(labels).first()["paired"] is False


def test_scheduling(spark):
    log = spark.createDataFrame([("a", 1, "failed", "oom"), ("a", 2, "success", None), ("b", 1, "failed", "assertion"), ("b", 2, "success", None), ("c", 1, "failed", "oom")], "task_id string, attempt int, status string, error_kind string")
    assert rows(scheduling.outcomes(log, "retry", 2), "task_id", "status") == [("a", "success"), ("b", "failed"), ("c", "pending")]
    assert rows(scheduling.outcomes(log, "continue"), "task_id", "status") == [("a", "failed"), ("b", "failed"), ("c", "failed")]
    tasks = spark.createDataFrame([(0, "success"), (1, "failed"), (2, "success")], "grid_index int, status string")
    assert rows(scheduling.after_abort(tasks), "grid_index", "status") == [(0, "success"), (1, "failed"), (2, "cancelled")]
    assert scheduling.cpu_slice(3, 8) == 1


def test_analyzers(spark):
    values = spark.createDataFrame([("c", i, 0.02 + 0.001 * (i % 3)) for i in range(50)], "cell string, idx long, value double")
    trades = spark.createDataFrame([("c", s, i, 0.02) for s in range(2) for i in range(20)], "cell string, seed int, trade_idx long, pnl double")
    assert analyzers.analyze_cells(values, trades, ["cell"], F.lit(True), replicates=50).first()["verdict"] == "GO"
    ics = spark.createDataFrame([(m, r, h, 0.5 / h * (1.0 if m == "deep" else 0.9)) for m in ("deep", "ridge") for r in ("p", "q") for h in (1, 2, 4)], "model string, ret string, horizon int, ic double")
    cells = ics.withColumns({"threshold": F.lit("t"), "n": F.lit(50), "mean": F.lit(0.01)})
    ok = spark.createDataFrame([(True,)], "ok boolean")
    out = analyzers.analyze_horizons(ics, cells, ok, "ridge", "deep").first()
    assert (out["arms"], out["cells"], out["controls"], out["verdict"]) == (4, 6, 4, "GO")
    thresholds = spark.createDataFrame([("c", "t1", 30, 0.02), ("c", "t2", 3, 9.0)], "cell string, threshold string, n long, mean double")
    corr = spark.createDataFrame([("c", i, 0.1 + 0.01 * i) for i in range(6)], "cell string, idx long, value double")
    assert analyzers.analyze_points(values, thresholds, corr, ["cell"], replicates=50).first()["verdict"] == "GO"
    pred = spark.createDataFrame([("m", s, int((i + s) % 5 > 0), 1) for s in range(4) for i in range(40 + s)], "model string, seed int, prediction int, label int")
    assert analyzers.analyze_precision(pred, ["model"], 1, 0.9, 0.1, replicates=20).first()["verdict"] == "GO"
    with pytest.raises(Exception, match="missing"):
        analyzers.complete(spark.range(3), spark.range(2), ["id"]).collect()


def broadcast_draws(df):
    """Runs a query; the explosions of sequences below a broadcast in the plan that ran."""
    df.collect()
    depth, found = None, []
    for line in df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].split("\n"):
        at = len(line) - len(line.lstrip(" +-:"))
        depth = None if depth is not None and at <= depth else depth
        if "BroadcastExchange" in line and depth is None:
            depth = at
        if depth is not None and "Generate explode(sequence" in line:
            found.append(line)
    return found


def test_draws_are_never_broadcast(spark):
    """A few rows of a plan become many draws, which must not go through the driver."""
    values = spark.range(0, 20_000, 1, 4).select(F.lit("a").alias("cell"), F.col("id").alias("idx"), (F.col("id") % 11 - 4.5).alias("value"))
    signals = values.select("idx", (F.col("value") * 2 + F.col("idx") % 3).alias("label"), F.explode(F.array(F.lit("x"), F.lit("y"))).alias("treatment"))
    signals = signals.select("treatment", F.col("idx").alias("sample_idx"), "label", (F.col("label") + (F.col("idx") % 5) * (F.col("treatment") == "x").cast("int")).alias("pred"))
    assert not broadcast_draws(stats.bootstrap_mean(values, ["cell"], 50))
    assert not broadcast_draws(stats.bootstrap_ratio(values, ["cell"], F.lit(2.0), 5))
    assert not broadcast_draws(stats.compare_pairs(signals, replicates=5))


def test_packed_draws(spark):
    """Hashes in bulk equal hashlib's over widths of numbers and texts of one and two MD5 blocks; packed places come back."""
    from quillon.operators import draws

    for prefix in (b"42|A/F|0|", b"x" * 53, b"y" * 70):
        want = [int(hashlib.md5(prefix + str(k).encode()).hexdigest()[:8], 16) for k in range(95, 10_300)]
        assert draws.heads(prefix, 95, 10_299).tolist() == want
        assert draws.heads(prefix, 95, 104).tolist() == want[:10]
    for places in ([0, 0, 3, 255], [5, 70_000, 70_000], [9]):
        assert draws.decode(draws.encode(np.array(places, np.uint32))).tolist() == places


def most_rows(df):
    """Runs a query; the most rows that one operator of the plan that ran has made."""
    df.collect()

    def walk(node):
        inner = getattr(node, "finalPhysicalPlan" if node.nodeName().startswith("AdaptiveSparkPlan") else "plan", None) if "Adaptive" in node.nodeName() or "QueryStage" in node.nodeName() else None
        if inner:
            yield from walk(inner())
        made = node.metrics().get("numOutputRows")
        if made.isDefined():
            yield made.get().value()
        for k in range(node.children().size()):
            yield from walk(node.children().apply(k))

    return max(walk(df._jdf.queryExecution().executedPlan()))


def test_draws_are_not_rows(spark):
    """A plain bootstrap draws every value in every replicate; no operator makes a row a draw."""
    values = spark.range(0, 20_000, 1, 4).select(F.lit("a").alias("cell"), F.col("id").alias("idx"), (F.col("id") % 11 - 4.5).alias("value"))
    assert 20_000 <= most_rows(stats.bootstrap_ratio(values, ["cell"], F.lit(2.0), 40)) < 40 * 20_000 / 10
    trades = values.select("cell", F.lit(1).alias("seed"), F.col("value").alias("pnl"), F.col("idx").alias("trade_idx"))
    cells = analyzers.analyze_cells(values, trades, ["cell"], F.lit(False), replicates=400)
    assert 20_000 <= most_rows(cells) < 400 * (20_000 // 28) / 4


def test_copies_drawn_are_weights(spark):
    """Ranks by weights equal ranks over the rows that are drawn, with ties and values that are not finite; copies are not joined one by one."""
    n, nan = 4000, float("nan")
    values = spark.range(0, n, 1, 3).select(F.col("id").alias("sample_idx"), (F.col("id") * 7919 % 101).cast("double").alias("label"), F.explode(F.array(F.lit("x"), F.lit("y"), F.lit("z"))).alias("treatment"))
    noise = F.when(F.col("treatment") == "z", 0.5).when(F.col("sample_idx") == 77, nan).otherwise((F.col("sample_idx") * 31 % 17) * F.length("treatment") + F.col("label") * (F.col("treatment") == "x").cast("int"))
    signals = values.withColumn("pred", noise).select("treatment", "sample_idx", "label", "pred")
    drawn = stats._places(signals.select(F.lit("all").alias("cell"), F.col("sample_idx").alias("idx")).distinct(), ["cell"], 6, 42, None).select("rep", F.col("idx").alias("sample_idx"))
    varied = signals.filter("treatment <> 'z'")  # of equal values alone Spark's corr makes an error, the resamples null
    want = stats.spearman(drawn.join(varied, "sample_idx"), ["rep", "treatment"], "pred", "label").collect()
    weights = drawn.groupBy("rep", "sample_idx").agg(F.count("*").alias("w"))
    got = {(r["rep"], r["treatment"]): r["ic"] for r in stats.drawn_spearman(signals, weights, "treatment", "sample_idx", "pred", "label").collect()}
    assert len(got) == 18 and len(want) == 12 and {got[rep, "z"] for rep in range(6)} == {None}
    assert all(abs(got[r["rep"], r["treatment"]] - r["ic"]) < 1e-12 for r in want)
    assert most_rows(stats.compare_pairs(varied, replicates=20)) < 20 * n * 2 * 0.7


def test_resampled_ranks(monkeypatch):
    """Correlations of many replicates at once equal ranks over the rows drawn, with ties across parts and pieces, left-out rows, other labels and one value only."""
    import pandas as pd
    import pyarrow as pa

    from quillon.operators import draws, resampled

    rng, n, replicates = np.random.default_rng(3), 700, 10
    label = rng.integers(0, 90, n).astype(float)
    own = rng.normal(size=n)
    groups = [(label, rng.integers(0, 5, n) + label / 50, np.arange(n)), (label, rng.normal(size=n), np.arange(n)), (own, own + rng.normal(size=n), np.arange(n)), (label, np.full(n, 0.5), np.arange(n)), (label, label % 7, np.arange(40, n))]
    for length, at_once, most in ((9, 256, 3), (1, 1 << 16, 64), (n, 512, 2)):
        monkeypatch.setattr(resampled, "_AT_ONCE", at_once)
        monkeypatch.setattr(resampled, "_MOST", most)
        blocks, rows = -(-n // length), []
        for t, (y, x, keep) in enumerate(groups):
            by_y = keep[np.lexsort((keep, y[keep]))]
            by_x = np.argsort(x[by_y], kind="stable")
            for kind, idx, v in ((0, by_y, y[by_y]), (1, by_x, x[by_y][by_x])):
                at = np.arange(len(idx))
                batch = pa.record_batch([np.full(len(idx), t, np.int32), np.full(len(idx), kind, np.int32), at // 100, idx.astype(np.int32), v], names=["t", "kind", "chunk", "idx", "v"])
                rows += [r for b in resampled.pack_order([batch.slice(0, 250), batch.slice(250)]) for r in b.to_pylist()]
        got = {}
        for share in range(3):
            made = resampled.correlations(n, length, blocks, "42|all", replicates, 3)([pa.RecordBatch.from_pylist([r | {"task": share} for r in rows])])
            got |= {(r["t"], r["rep"]): r["ic"] for b in made for r in b.to_pylist()}
        assert len(got) == len(groups) * replicates
        for rep in range(replicates):
            starts = draws.heads(f"42|all|{rep}|".encode(), 0, blocks - 1).astype(int) % (n - length + 1)
            drawn = (starts[:, None] + np.arange(length)).reshape(-1)[:n]
            for t, (y, x, keep) in enumerate(groups):
                some = drawn[np.isin(drawn, keep)]
                want = pd.Series(x[some]).rank().corr(pd.Series(y[some]).rank()) if t != 3 else None
                assert got[t, rep] is None if want is None else abs(got[t, rep] - want) < 1e-12


def test_compare_pairs_whole_job(spark, sf_dir):
    """The registered query makes all replicates of the operator and has delta, q and significance; samples that a mask left out are no gaps; packed orders equal merged weights."""
    from quillon.plans.catalog import ORACLES, QUERIES

    rows = QUERIES["compare_pairs"](spark, sf_dir).collect()
    assert "range(10000)" in ORACLES["compare_pairs"] and stats.REPLICATES == 10_000
    assert len(rows) == 6 and all(set(r.asDict()) == {"treatment_a", "treatment_b", "delta", "lo", "hi", "p", "q", "significant"} for r in rows)
    counts = [r["p"] * 10_001 / 2 for r in rows]
    assert all(abs(c - round(c)) < 1e-2 for c in counts) and min(r["p"] for r in rows) < 2 / 21
    signals = spark.range(0, 300, 1, 3).select(F.col("id").alias("sample_idx"), (F.col("id") * 7919 % 101).cast("double").alias("label"), F.explode(F.array(F.lit("x"), F.lit("y"))).alias("treatment"))
    signals = signals.withColumn("pred", F.col("label") + F.col("sample_idx") * 31 % 17 * F.when(F.col("treatment") == "x", 9).otherwise(2))
    want = stats.compare_pairs(signals, replicates=40).first()
    assert stats.compare_pairs(signals.withColumn("sample_idx", F.col("sample_idx") * 3 + 5), replicates=40).first() == want
    whole, stats.WHOLE = stats.WHOLE, 0
    try:
        merged = stats.compare_pairs(signals, replicates=40).first()
    finally:
        stats.WHOLE = whole
    assert all(merged[c] == want[c] or abs(merged[c] - want[c]) < 1e-12 for c in ("delta", "lo", "hi", "p", "q")) and want["lo"] < want["hi"]


def exchanges(df):
    """Runs a query; the rows that each exchange of the plan that ran has written."""
    df.collect()

    def walk(node):
        inner = getattr(node, "finalPhysicalPlan" if node.nodeName().startswith("AdaptiveSparkPlan") else "plan", None) if "Adaptive" in node.nodeName() or "QueryStage" in node.nodeName() else None
        if inner:
            yield from walk(inner())
        if node.nodeName() in ("Exchange", "BroadcastExchange"):
            made = node.metrics().get("shuffleRecordsWritten")
            yield made.get().value() if made.isDefined() else 0
        for k in range(node.children().size()):
            yield from walk(node.children().apply(k))

    return list(walk(df._jdf.queryExecution().executedPlan()))


def test_trimmed_means_move_few(spark):
    """Only the first k of a task and seed are sorted and moved; the rest are equal to a mean by hand, with ties, nulls, signs and repeated places."""
    nan = float("nan")
    made = [("c", i % 3, i, (-1.0) ** i * (i * 7919 % 97)) for i in range(6000)] + [("d", None, i, v) for i, v in enumerate([2.0, -2.0, None, 2.0, 1.0])]
    made += [("e", 0, i, v) for i, v in enumerate([nan, 1.0, 3.0])] + [("f", 0, 0, 5.0)] * 4 + [("g", 0, i, None) for i in range(4)]
    trades = spark.createDataFrame(made, "cell string, seed int, trade_idx long, pnl double")
    out = reduce.trimmed_means(trades, ["cell"], 2)
    assert max(exchanges(out)) < 500
    means = []
    for seed in range(3):
        left = sorted((r for r in made if r[:2] == ("c", seed)), key=lambda r: (-abs(r[3]), -r[2]))[2:]
        means.append(sum(r[3] for r in left) / len(left))
    got = {r["cell"]: (r["trimmed_mean"], r["n_seeds"]) for r in out.collect()}
    assert abs(got["c"][0] - sum(means) / 3) < 1e-12 and got["c"][1] == 3
    assert got == got | {"d": (1.5, 1), "e": (1.0, 1), "f": (5.0, 1), "g": (0.0, 1)}
    assert {r["trimmed_mean"] for r in reduce.trimmed_means(trades.filter("cell = 'd'"), ["cell"], 0).collect()} == {0.75}


def test_group_places(spark):
    """Places in groups over several ranges, with repeated rows, a large and a small group; rows without a group are left out."""
    df = spark.range(0, 5000, 1, 7).select(F.when(F.col("id") < 4990, "a").when(F.col("id") < 4998, "b").alias("g"), (F.col("id") * 7919 % 911).alias("v"), "id")
    out = ranking.group_places(df, ["g"], ["v"], [(F.col("v") * 2).alias("w")])
    assert out.columns == ["g", "w", "idx"]
    for g, n in (("a", 4990), ("b", 8)):
        got = [(r["idx"], r["w"]) for r in out.filter(F.col("g") == g).orderBy("idx").collect()]
        assert [i for i, _ in got] == list(range(n)) and [w for _, w in got] == sorted(2 * (i * 7919 % 911) for i in (range(4990) if g == "a" else range(4990, 4998)))
    assert out.count() == 4998 and ranking.group_places(df.limit(0), ["g"], ["v"], ["id"]).count() == 0


def test_seeds_plan_is_small(spark, sf_dir):
    """The trades are numbered and written once; a plan that held their numbering at each reading would fill the driver."""
    from quillon.plans.catalog import QUERIES

    assert len(exchanges(QUERIES["analyze_seeds"](spark, sf_dir))) <= 24


def test_draws_take_few_bytes(spark):
    """Draws some hundred places apart take little more than a byte each; differences about and far over 255 come back."""
    from quillon.operators import draws

    for gaps in ([0, 254, 255, 256, 509, 510, 511], [0, 65_535], [255], [510], [1, 65_000, 0, 255]):
        places = np.cumsum(np.array(gaps), dtype=np.uint32)
        assert draws.decode(draws.encode(places)).tolist() == places.tolist()
    places = np.sort(np.random.default_rng(1).integers(0, 1 << 16, 360)).astype(np.uint32)
    packed = draws.encode(places)
    assert draws.decode(packed).tolist() == places.tolist() and len(packed) < 1.5 * len(places)
