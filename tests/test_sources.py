import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillon.sources import files, sinks
from quillon.streaming.rollup import windowed_counts


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_records_with_quarantine(spark, tmp_path):
    write(tmp_path / "b.json", json.dumps({"experiment_id": "e2", "status": "completed", "tags": ["x"], "training_metrics": {"f1": 0.5}, "training_config": {"a": {"b": 1}}, "created_at": "2026-01-02"}))
    write(tmp_path / "a.json", json.dumps({"experiment_id": "e1", "created_at": "2026-01-03"}))
    write(tmp_path / "c.json", "{broken")
    good, bad = files.quarantine(files.read_records(spark, str(tmp_path)))
    assert [r["experiment_id"] for r in files.newest_first(good).collect()] == ["e1", "e2"]
    assert [r["file"] for r in bad.collect()] == ["c.json"]
    assert ("training_metrics", "f1", "0.5") in {tuple(r) for r in files.describe_record(good, "e2").collect()}
    assert files.find_record(good, "nope").count() == 0
    write(tmp_path / "more" / "d.json", json.dumps({"experiment_id": "e4", "training_metrics": {"z": 1, "f1": 0.25, "nested": {"a": 1}}, "artifacts": [{"kind": "plot", "path": "p", "sha256": "s", "bytes": 3}], "sub_records": [{"experiment_id": "c", "training_metrics": {"f1": 1}}], "feature_set_ref": {"name": "n", "content_hash": "h"}, "provenance": {"git": {"branch": "main"}}, "training_config": {"model_config_hash": "m"}}))
    row = files.read_records(spark, str(tmp_path / "more"))
    r = row.first()
    assert r["training_metrics"] == {"z": 1.0, "f1": 0.25} and r["training_metrics_other"] == {"nested": '{"a":1}'} and r["model_config_hash"] == "m"
    assert r["artifacts"][0]["bytes"] == 3 and r["sub_records"][0]["experiment_id"] == "c" and r["feature_set_ref"]["content_hash"] == "h"
    told = [tuple(x) for x in files.describe_record(row, "e4").collect()]
    assert [x for x in told if x[0] != "header"] == [("training_metrics", "f1", "0.25"), ("training_metrics", "z", "1.0"), ("training_metrics_other", "nested", '{"a":1}'), ("provenance", "git.branch", '"main"'), ("artifacts", "plot/p", "s")]


def test_index_status(spark):
    texts = [json.dumps({"schema": {"version": "1.2.9"}, "entries": []}), json.dumps({"schema": {"version": "1.3.0"}, "entries": []}), "[]", "{", "{}"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    assert [r["index_status"] for r in files.index_status(df, "1.2.0").collect()] == ["envelope", "version_mismatch", "bare_list", "malformed", "malformed"]


def test_verdict_scan(spark, tmp_path):
    for name, text in {"study/results/v.json": '{"verdict": "GO", "any_tradeable_edge": true}', "study/results/_h.json": "{}", "study/results/v.shard0of4.json": "{}", "study/other/x.json": "{}", "study/results/deep/y.json": "{}", "s2/results/bad.json": "{", "s2/results/no.json": "{}"}.items():
        write(tmp_path / name, text)
    out = files.read_verdicts(spark, [str(tmp_path)], deny=["no.json"]).collect()
    assert [(r["study"], r["file"], r["verdict"], r["parse_warnings"]) for r in out] == [("s2", "bad.json", None, ["not JSON"]), ("study", "v.json", "GO", [])]


def test_arrays(spark, tmp_path):
    np.save(tmp_path / "x.npy", np.array([[1.0, 2.0], [3.0, math.nan], [5.0, 6.0]]))
    out = files.read_arrays(spark, str(tmp_path), horizons=2)
    assert sorted((r["sample_idx"], r["horizon_idx"]) for r in out.collect()) == [(i, j) for i in range(3) for j in range(2)]
    with pytest.raises(Exception, match="transposed"):
        files.read_arrays(spark, str(tmp_path), horizons=3).collect()


def test_trades(spark):
    expected = spark.createDataFrame([("a", "t", "completed"), ("b", "t", "completed")], "run_name string, threshold_label string, status string")
    trades = spark.createDataFrame([("a", "t", 50.0)], "run_name string, threshold_label string, pnl_usd double")
    assert sorted((r["run_name"], r["pnl"]) for r in files.trade_fractions(expected, trades, 100.0).collect()) == [("a", 0.5), ("b", None)]
    with pytest.raises(Exception, match="no trades"):
        files.trade_fractions(expected.withColumn("status", F.lit("failed")), trades, 100.0).collect()


def test_histories(spark):
    df = spark.createDataFrame([("a", '[{"val_loss": 1.0}, {"val_loss": 0.5, "x": 2}]'), ("b", '{"val_loss": [3, 2]}')], "experiment_id string, text string")
    assert sorted(tuple(r) for r in files.history_rows(df).collect()) == [("a", 0, "val_loss", 1.0), ("a", 1, "val_loss", 0.5), ("a", 1, "x", 2.0), ("b", 0, "val_loss", 3.0), ("b", 1, "val_loss", 2.0)]


def test_small_readers(spark, tmp_path):
    write(tmp_path / "logs/r.log", "acc=1\nacc=2\n")
    assert [tuple(r) for r in files.scrape_logs(spark, str(tmp_path / "logs"), {"acc": "acc=([0-9]+)"}).collect()] == [("r.log", "2")]
    listed = files.listing(spark, str(tmp_path / "logs"))
    assert [r["name"] for r in listed.collect()] == ["r.log"]
    assert [r["kind"] for r in files.classify_outputs(listed, {"r.log": "log_only"}).collect()] == ["log_only"]
    cond = spark.createDataFrame([("k", json.dumps({"splits": {"test": {"conditioned_metrics": [{"filter": "hi", "metric": "f1", "value": 0.5}, {"filter": "lo", "metric": "f1", "value": 0.1}]}}}))], "k string, text string")
    assert [tuple(r) for r in files.conditioned_metrics(cond, "k", "hi").collect()] == [("k", "f1", 0.5)]
    side = spark.createDataFrame([("a", 0, "{"), ("a", 1, "{}"), ("b", 0, "{}")], "k string, o int, text string")
    assert [r["k"] for r in files.first_valid(side, "k", "o").collect()] == ["b"]
    names = spark.createDataFrame([("x_1.json", "p1"), ("y_1.json", "p2"), ("z_2.json", "p3")], "name string, path string")
    assert [tuple(r) for r in files.locate(names, spark.createDataFrame([("_1.json",), ("_2.json",)], "suffix string")).collect()] == [("_2.json", "p3")]
    assert files.load_config(str(tmp_path / "none.toml")) == {}
    write(tmp_path / "c.toml", "a = 1")
    assert files.load_config(str(tmp_path / "c.toml")) == {"a": 1}
    assert files.first_existing(None, str(tmp_path / "q"), str(tmp_path)) == str(tmp_path)


def test_sinks(spark, tmp_path):
    store = str(tmp_path / "store")
    new = spark.createDataFrame([("a", "training", "n"), ("b", "backtest", "n")], "experiment_id string, record_type string, notes string")
    sinks.append_records(store, new)
    with pytest.raises(ValueError):
        sinks.append_records(store, new.limit(1))
    with pytest.raises(ValueError):
        sinks.append_records(store, new.selectExpr("'z' AS experiment_id", "record_type", "notes"))
    assert spark.read.parquet(store).count() == 2
    assert sinks.with_notes(new, "a", "new").filter("notes = 'new'").count() == 1
    art = spark.createDataFrame([("plot", "a" * 64, "2026-03-04"), ("plot", "a" * 64, "2026-05-01"), ("plot", "bad", "2026-05-01")], "kind string, sha256 string, created_at string")
    assert [(r["path"], r["n_uses"]) for r in sinks.artifact_paths(art).collect()] == [(f"plot/2026_03/{'a' * 64}.json", 2)]
    blobs = str(tmp_path / "blobs")
    sinks.write_artifacts(blobs, art)
    sinks.write_artifacts(blobs, art)
    assert [(r["sha256"], r["created_at"]) for r in spark.read.parquet(blobs).collect()] == [("a" * 64, "2026-03-04")]
    sinks.write_index(new.withColumn("ordinal", F.col("experiment_id")), "1.2.0", str(tmp_path / "index"))
    assert [json.loads(r["value"])["experiment_id"] for r in spark.read.text(str(tmp_path / "index/entries")).collect()] == ["a", "b"]
    shapes = spark.createDataFrame([("a", '{"f1": 1}'), ("b", '{"metrics": {"f1": 2}}'), ("c", '{"test": {"f1": 3}}'), ("d", '[{"f1": 0}, {"f1": 4}]')], "name string, text string")
    assert [(r["shape"], r["metrics"]["f1"]) for r in sinks.records_from_metrics(shapes).orderBy("name").collect()] == [("flat", 1.0), ("metrics", 2.0), ("test", 3.0), ("list", 4.0)]
    assert sinks.render(new.select("experiment_id"), "markdown").splitlines()[2] == "| a |"
    assert json.loads(sinks.render(new, "json"))[0]["experiment_id"] == "a"
    with pytest.raises(Exception, match="no hash"):
        sinks.records_from_verdicts(spark.createDataFrame([("s", "x", "t", "GO")], "study string, config_sha256 string, run_timestamp_utc string, verdict string")).collect()
    preset = spark.createDataFrame([("p", [2, 0, 2], 5, "1.0")], "name string, feature_indices array<int>, source_feature_count int, contract_version string")
    made = sinks.migrate_presets(preset).select(F.to_json(F.struct("*")).alias("text"))
    assert [(r["name"], r["intact"]) for r in files.feature_sets(made).collect()] == [("p", True)]


def test_streaming_equals_batch(spark, sf_dir, tmp_path):
    batch = spark.read.parquet(f"{sf_dir}/events.parquet")
    batch.repartition(1).write.parquet(str(tmp_path / "in"))
    stream = windowed_counts(spark.readStream.schema(batch.schema).parquet(str(tmp_path / "in")))
    q = stream.writeStream.outputMode("complete").format("memory").queryName("windowed").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    key = lambda r: (r["window_start"], r["event_type"], r["n"], round(r["total"], 6))
    assert sorted(map(key, spark.table("windowed").collect())) == sorted(map(key, windowed_counts(batch).collect()))
