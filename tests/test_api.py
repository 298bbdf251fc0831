import json

import pytest
from pyspark.sql import functions as F

from quillon.api import Workbench, validate


@pytest.fixture(scope="module")
def bench(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("records")
    for i in range(6):
        record = {"experiment_id": f"e{i}", "name": f"n{i % 2}", "record_type": "sweep_aggregate" if i == 5 else "training", "status": "completed", "created_at": f"2026-01-0{i + 1}", "sweep_id": "s", "fingerprint": f"{i % 3:064x}", "tags": ["a"] if i % 2 else ["b"], "training_metrics": {"f1": 0.1 * i}, "training_config": {"lr": str(i)}, "axis_values": {"x": str(i)}}
        (folder / f"{i}.json").write_text(json.dumps(record))
    (folder / "bad.json").write_text("{")
    w = Workbench(spark, str(tmp_path_factory.mktemp("store") / "p"))
    assert [r["file"] for r in w.rebuild(str(folder)).collect()] == ["bad.json"]
    return w


def test_ledger(bench):
    assert [r["experiment_id"] for r in bench.list().collect()][0] == "e5"
    assert bench.search(tags=["a"]).count() == 3
    assert bench.show("e2").filter("key = 'f1'").count() == 1
    assert bench.summary().filter("section = 'total'").first()["n"] == 6
    assert bench.sql("SELECT count(*) AS n FROM {records}").first()["n"] == 6
    assert sorted((r["path"], r["a"], r["b"]) for r in bench.diff("e1", "e2").collect())[-1] == ("training_metrics/f1", "0.1", "0.2")
    dup = bench.check_duplicates(bench.spark.createDataFrame([(f"{0:064x}",), ("z",)], "fingerprint string"))
    assert sorted((r["fingerprint"], r["duplicate"]) for r in dup.collect()) == [(f"{0:064x}", True), ("z", False)]


def test_sweeps(bench):
    flat = bench.records.withColumn("f1", F.col("training_metrics.f1"))
    flat.write.parquet(bench.store + "-flat")
    wide = Workbench(bench.spark, bench.store + "-flat")
    assert [r["experiment_id"] for r in wide.compare(["f1"], "f1", 2).collect()] == ["e4", "e3"]
    assert [r["rank"] for r in wide.sweep_results("s", ["f1"], "f1").collect()] == [1, 2, 3, 4, 5]
    axes = bench.spark.createDataFrame([("a", 0, "bad label", 0, {"k": "1"})], "axis string, axis_pos int, label string, value_pos long, overrides map<string,string>")
    with pytest.raises(ValueError, match="bad label"):
        bench.sweep_expand(axes, "s")
    assert bench.sweep_expand(axes.withColumn("label", F.lit("ok")), "s").first()["name"] == "s__ok"


def test_validate(tmp_path):
    (tmp_path / "c.json").write_text('{"a": {"b": 1}}')
    assert validate(str(tmp_path / "c.json"), ["a.b", "c"]) == ["missing: c"]
    (tmp_path / "d.json").write_text("{")
    assert validate(str(tmp_path / "d.json"), []) != []
