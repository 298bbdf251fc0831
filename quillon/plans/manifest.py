"""Experiment manifests: typed configuration on the driver, axes as a DataFrame."""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, fields

from pyspark.sql import DataFrame, SparkSession

from quillon.functions.scalars import close_match, resolve, unresolved
from quillon.operators.scheduling import STAGES
from quillon.sources.files import load_config

AXES = "axis string, axis_pos int, label string, value_pos long, overrides map<string,string>"


@dataclass(frozen=True)
class Experiment:
    name: str = ""
    description: str = ""
    hypothesis: str = ""
    contract_version: str = ""
    tags: tuple[str, ...] = ()


@dataclass(frozen=True)
class Stage:
    """One step of a run; what is particular to a kind of stage stands in ``options``."""

    enabled: bool = True
    config: str = ""
    output_dir: str = ""
    script: str = ""
    extra_args: tuple[str, ...] = ()
    options: Mapping[str, object] = field(default_factory=dict)
    overrides: Mapping[str, object] = field(default_factory=dict)


@dataclass(frozen=True)
class Sweep:
    name: str = ""
    strategy: str = "grid"
    axes: tuple[Mapping[str, object], ...] = ()


@dataclass(frozen=True)
class Manifest:
    experiment: Experiment
    stages: Mapping[str, Stage]
    sweep: Sweep | None
    warnings: tuple[str, ...]

    def selected(self, only: Sequence[str] = (), skip: Sequence[str] = ()) -> list[str]:
        """Enabled stages in the order of a run, of ``only`` if given and without ``skip``; unknown names raise."""
        for name in (*only, *skip):
            if name not in STAGES:
                raise ValueError(f"no stage {name!r}; did you mean {close_match(name, STAGES)!r}?")
        return [s for s in STAGES if s in self.stages and self.stages[s].enabled and (not only or s in only) and s not in skip]


def known(kind: type) -> list[str]:
    """The keys of a section: the fields of its class, and nothing listed elsewhere."""
    return [f.name for f in fields(kind)]


def _build(kind: type, section: object, at: str, warnings: list[str]):
    section = dict(section or {})
    names = known(kind)
    for key in [k for k in section if k not in names]:
        hint = close_match(key, names)
        warnings.append(f"unknown key {at}.{key}" + (f"; did you mean {hint}?" if hint else ""))
        value = section.pop(key)
        if "options" in names:
            section["options"] = {**section.get("options", {}), key: value}
    return kind(**{k: tuple(v) if isinstance(v, list) else v for k, v in section.items()})


def build(document: Mapping, now: datetime.datetime | None = None) -> Manifest:
    """A manifest from a document: variables resolved (built-in ``now``, ``date``), unknown keys warned about.

    A key that a stage does not know goes to its options with the warning.
    References that are left are warnings too; an unknown stage, or an
    experiment without a name, is an error.
    """
    now = now or datetime.datetime.now(datetime.UTC)
    document = resolve(document, builtin={"now": now.strftime("%Y%m%dT%H%M%S"), "date": now.strftime("%Y-%m-%d")}, deferred=["sweep"])
    warnings = [f"unresolved {ref} at {path}" for path, ref in unresolved(document) if not ref.startswith("sweep.")]
    warnings += [f"unknown section {k}" for k in document if k not in ("experiment", "stages", "sweep", "variables")]
    experiment = _build(Experiment, document.get("experiment"), "experiment", warnings)
    if not experiment.name:
        raise ValueError("an experiment needs a name")
    stages = {}
    for name, section in (document.get("stages") or {}).items():
        if name not in STAGES:
            raise ValueError(f"no stage {name!r}; did you mean {close_match(name, STAGES)!r}?")
        stages[name] = _build(Stage, section, f"stages.{name}", warnings)
    sweep = _build(Sweep, document["sweep"], "sweep", warnings) if document.get("sweep") else None
    return Manifest(experiment, stages, sweep, tuple(warnings))


def load(path: str) -> Manifest:
    return build(load_config(path))


def axes(spark: SparkSession, sweep: Sweep) -> DataFrame:
    """The axes of a sweep as rows that :func:`quillon.operators.grid.expand` takes.

    An axis is {name, values: [{label, overrides}]}; an override may be any
    scalar and is kept as its text.
    """
    rows = []
    for pos, axis in enumerate(sweep.axes):
        for k, value in enumerate(axis.get("values") or ()):
            rows.append((str(axis.get("name", "")), pos, str(value.get("label", "")), k, {str(p): str(v) for p, v in (value.get("overrides") or {}).items()}))
    return spark.createDataFrame(rows, AXES)
