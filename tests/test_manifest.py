import datetime
import json

import pytest

from quillon.operators import grid
from quillon.plans import manifest

DOC = {
    "experiment": {"name": "e_${date}", "tags": ["a"]},
    "variables": {"root": "/data"},
    "stages": {"training": {"output_dir": "${variables.root}/out/${sweep.point}", "script": "t.py", "lerning_rate": 0.1}, "backtesting": {"enabled": False}, "extraction": {"config": "${nothing.here}"}},
    "sweep": {"name": "s", "axes": [{"name": "lr", "values": [{"label": "lo", "overrides": {"train.lr": 0.1}}, {"label": "hi", "overrides": {"train.lr": 1}}]}]},
}
NOW = datetime.datetime(2026, 5, 6, tzinfo=datetime.UTC)


def test_build(spark, tmp_path):
    m = manifest.build(DOC, NOW)
    assert m.experiment.name == "e_2026-05-06" and m.experiment.tags == ("a",)
    assert m.stages["training"].output_dir == "/data/out/${sweep.point}"
    assert m.stages["training"].options == {"lerning_rate": 0.1}
    assert m.selected() == ["extraction", "training"] and m.selected(skip=["training"]) == ["extraction"]
    assert sorted(w.split(";")[0] for w in m.warnings) == ["unknown key stages.training.lerning_rate", "unresolved nothing.here at stages.extraction.config"]
    points = grid.expand(manifest.axes(spark, m.sweep), m.sweep.name).collect()
    assert {r["name"]: r["overrides"] for r in points} == {"s__lo": {"train.lr": "0.1"}, "s__hi": {"train.lr": "1"}}
    (tmp_path / "m.json").write_text(json.dumps(DOC))
    assert manifest.load(str(tmp_path / "m.json")).sweep.strategy == "grid"


def test_errors():
    with pytest.raises(ValueError, match="needs a name"):
        manifest.build({})
    with pytest.raises(ValueError, match="training"):
        manifest.build({"experiment": {"name": "x"}, "stages": {"trainning": {}}})
    with pytest.raises(ValueError, match="backtesting"):
        manifest.build(DOC, NOW).selected(only=["backtestin"])
