"""Records: filter, project, rank, group, summarise, diff and fuse."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillon.functions.scalars import require_sha256
from quillon.functions.semantics import choose, finite, first_by, is_finite, non_empty
from quillon.operators.ranking import global_rank

# --- filter and projection --------------------------------------------------


@dataclass
class RecordFilter:
    """Optional predicates, joined by AND.

    For tags and the five plain names and dates an empty value means no
    predicate; for the four hashes an empty string is a value to look for and
    only None means no predicate.
    """

    tags: Sequence[str] = ()
    model_type: str = ""
    labeling_strategy: str = ""
    status: str = ""
    sweep_id: str = ""
    created_after: str = ""
    created_before: str = ""
    floors: Mapping[str, float] = field(default_factory=dict)
    fingerprint: str | None = None
    compatibility_fingerprint: str | None = None
    provenance_hash: str | None = None
    model_config_hash: str | None = None

    def condition(self, columns: Sequence[str]) -> Column:
        """A missing metric counts as 0 where a floor is set; dates compare as strings, both bounds included."""
        out = F.lit(True)
        for tag in self.tags:
            out = out & F.coalesce(F.array_contains("tags", tag), F.lit(False))
        for name in ("model_type", "labeling_strategy", "status", "sweep_id"):
            if getattr(self, name):
                out = out & F.coalesce(F.col(name) == getattr(self, name), F.lit(False))
        if self.created_after:
            out = out & (F.col("created_at") >= self.created_after)
        if self.created_before:
            out = out & (F.col("created_at") <= self.created_before)
        for metric, least in self.floors.items():
            out = out & (F.coalesce(finite(F.col(metric)) if metric in columns else F.lit(None).cast("double"), F.lit(0.0)) >= least)
        for name in ("fingerprint", "compatibility_fingerprint", "provenance_hash", "model_config_hash"):
            if (value := getattr(self, name)) is not None:
                out = out & F.coalesce(F.col(name) == (require_sha256(value, name) if value else value), F.lit(False))
        return out


def filter_records(records: DataFrame, wanted: RecordFilter) -> DataFrame:
    return records.filter(wanted.condition(records.columns))


def without_kinds(records: DataFrame, *kinds: str) -> DataFrame:
    """Drop aggregate or failure rows by record_type; rows without a type stay."""
    return records.filter(~F.coalesce(F.col("record_type").isin(*kinds), F.lit(False)))


def project(records: DataFrame, paths: Mapping[str, tuple[str, str]], document: str = "config") -> DataFrame:
    """Add a column for each name -> (JSON path, type) of a VARIANT or JSON string column; missing is null."""
    tree = F.col(document)
    if dict(records.dtypes)[document] != "variant":
        tree = F.try_parse_json(tree)
    return records.withColumns({name: F.try_variant_get(tree, path, kind) for name, (path, kind) in paths.items()})


def unresolved_metrics(records: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """(metric, unresolved): whether a metric is null in every row; true on an empty table."""
    counts = records.agg(*[F.count(m).alias(m) for m in metrics])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), (F.col(m) == 0).alias("unresolved")) for m in metrics])))


def primary_metric(metrics: Column, configured: str, fallback: Sequence[str]) -> tuple[Column, Column]:
    """(name, value) from a map of metrics: the configured one even if null, else the first finite fallback."""
    if configured:
        return F.lit(configured), finite(metrics[configured])
    names = F.coalesce(*[F.when(is_finite(metrics[m]), F.lit(m)) for m in fallback])
    return names, F.coalesce(*[finite(metrics[m]) for m in fallback])


#: Metrics tried in this order when none is configured.
PRIMARY_FALLBACK = (
    "test_ic", "test_directional_accuracy", "best_val_ic", "best_val_directional_accuracy", "best_val_r2",
    "best_val_pearson", "best_val_profitable_accuracy", "best_val_macro_f1", "best_val_accuracy",
)

# --- rank and group ---------------------------------------------------------


def compare(records: DataFrame, metrics: Sequence[str], sort_by: str, k: int | None = None, ascending: bool = False, group_by: str | None = None, keys: Sequence[str] = ("experiment_id",), ordinal: str = "ordinal") -> DataFrame:
    """Rank by a metric, missing last in either direction, ties by ``ordinal``; then keep k; then label groups.

    Grouping re-orders the k survivors by group and gives each its ``group``
    value; it is not a top-k per group.  The result carries ``rank`` (from 1).
    """
    names = [m.split(".")[-1] for m in metrics]
    if len(set(names)) < len(names):
        raise ValueError(f"two metrics share a short name: {metrics}")
    if sort_by not in metrics:
        raise ValueError(f"{sort_by!r} is not among the metrics")
    values = {n: finite(F.col(m)) for n, m in zip(names, metrics, strict=True)}
    rows = records.select(*keys, ordinal, *[v.alias(n) for n, v in values.items()], *([F.col(group_by).alias("group")] if group_by else []))
    by = F.col(sort_by.split(".")[-1])
    order = [by.asc_nulls_last() if ascending else by.desc_nulls_last(), F.col(ordinal).asc()]
    if k is None:
        out = global_rank(rows, *order)
    else:  # k rows in all: the ranking window sees those only
        out = rows.orderBy(*order).limit(k).withColumn("rank", F.row_number().over(Window.orderBy(*order)))
    return out.drop(ordinal).orderBy(*(["group"] if group_by else []), "rank")


def latest(records: DataFrame, key: str, *order: Column) -> DataFrame:
    """One row for each key: the first in ``order``."""
    return records.withColumn("_n", first_by([key], *order)).filter("_n = 1").drop("_n")


def prior_best(records: DataFrame, metric: str, signature: Mapping[str, object], ordinal: str = "ordinal") -> DataFrame:
    """The best earlier training record of a signature, and how many match, in one row; none without a match.

    In the signature only the empty string matches anything; None matches
    null.  A signature of nothing but empty strings, 0 and None tells nothing
    and matches nothing.  Records without a type are training records.  Of
    equal metrics the first by ordinal wins; matches none of which has the
    metric are counted all the same, beside nulls.
    """
    if all(v in ("", 0, None) for v in signature.values()):
        return records.limit(0).withColumns({"n_matches": F.lit(0).cast("long")})
    hit = F.coalesce(F.col("record_type") == "training", F.lit(True)) if "record_type" in records.columns else F.lit(True)
    for name, value in signature.items():
        if value != "":
            hit = hit & F.col(name).eqNullSafe(F.lit(value))
    found = records.filter(hit)
    counted = found.agg(F.count("*").alias("n_matches")).filter("n_matches > 0")
    best = found.filter(is_finite(F.col(metric))).orderBy(F.col(metric).desc(), F.col(ordinal).asc()).limit(1)
    return counted.join(best, F.lit(True), "left").select(*records.columns, "n_matches")  # one row each


def summary(records: DataFrame, top: int = 10, ordinal: str = "ordinal") -> DataFrame:
    """(section, key, n): total, counts by status and model_type, and the ``top`` tags, earlier-seen first among equals."""
    total = records.agg(F.lit("total").alias("section"), F.lit("all").alias("key"), F.count("*").alias("n"))
    by = lambda c: records.groupBy(F.col(c).alias("key")).agg(F.count("*").alias("n")).select(F.lit(c).alias("section"), F.coalesce("key", F.lit("")).alias("key"), "n")
    tags = records.select(ordinal, F.posexplode("tags").alias("at", "key")).groupBy("key").agg(F.count("*").alias("n"), F.min(F.struct(ordinal, "at")).alias("seen"))
    tags = tags.orderBy(F.desc("n"), "seen").limit(top).select(F.lit("tag").alias("section"), "key", "n")
    return total.unionByName(by("status")).unionByName(by("model_type")).unionByName(tags)


def run_status(stages: DataFrame, key: str = "run_id", status: str = "status") -> DataFrame:
    """failed if any stage failed, completed if all completed, else partial."""
    return stages.groupBy(key).agg(choose((F.bool_or(F.col(status) == "failed"), "failed"), (F.bool_and(F.col(status) == "completed"), "completed"), otherwise="partial").alias("status"))


# --- diff -------------------------------------------------------------------


def leaves(text: str | None) -> list[tuple[str, str]]:
    """(dotted path, JSON text) of every leaf of a JSON object; lists and empty objects are leaves.  Other text has none."""
    try:
        tree = json.loads(text) if text else None
    except (ValueError, RecursionError):
        return []
    out, left = [], [("", tree)] if isinstance(tree, dict) else []
    while left:
        at, value = left.pop()
        if isinstance(value, dict) and value:
            left += [(f"{at}.{k}" if at else k, v) for k, v in value.items()]
        elif at:
            out.append((at, json.dumps(value, sort_keys=True)))
    return sorted(out)


def flatten_json(df: DataFrame, key: str, document: str) -> DataFrame:
    """(key, path, value) of every leaf of a JSON object column, at any depth; values as JSON text."""

    @F.pandas_udf("array<struct<path:string,value:string>>")
    def paths(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [{"path": p, "value": v} for p, v in leaves(t)])

    return df.select(key, F.explode(paths(F.col(document).cast("string"))).alias("e")).select(key, "e.path", "e.value")


def axis_value(axes: Column, name: str, configured: Column) -> Column:
    """The value of a sweep's axis, or what the configuration says where the sweep has no such axis."""
    return F.coalesce(F.try_element_at(axes, F.lit(name)), configured)


def metric_from(name: str, *places: Column, missing: float | None = None) -> Column:
    """A metric from the first of several maps that has a number under its name (not a number in the sense of text is
    passed over, NaN counts); ``missing`` where none has."""
    return F.coalesce(*[F.try_element_at(p, F.lit(name)).try_cast("double") for p in places], F.lit(missing).cast("double"))


def horizon_number(text: Column) -> Column:
    """H60 or 60 as 60; null for anything else."""
    return F.regexp_extract(text, "^[Hh]?([0-9]+)$", 1).try_cast("int")


def trusted(rows: DataFrame, trust: DataFrame, on: Sequence[str] = ("sweep_id", "seed"), default: str = "unknown") -> DataFrame:
    """Adds ``trust``, looked up by sweep and seed; rows the table does not know have the default."""
    known = trust.dropDuplicates(list(on)).select(*on, F.col("trust").alias("_trust"))
    return rows.join(known, list(on), "left").withColumn("trust", F.coalesce("_trust", F.lit(default))).drop("_trust")


def diff_maps(a: DataFrame, b: DataFrame, path: str = "path", value: str = "value") -> DataFrame:
    """Full outer join of two path tables; rows whose values differ, with a delta where both are numbers."""
    left = a.select(F.col(path).alias("path"), F.col(value).alias("a"), F.lit(True).alias("in_a"))
    right = b.select(F.col(path).alias("path"), F.col(value).alias("b"), F.lit(True).alias("in_b"))
    both = left.join(right, "path", "full_outer").filter(~F.col("a").eqNullSafe(F.col("b")) | F.col("in_a").isNull() | F.col("in_b").isNull())
    number = lambda c: F.expr(f"try_cast({c} AS double)")
    return both.select("path", "a", "b", (number("b") - number("a")).alias("delta"))


def diff_records(long: DataFrame, left: str, right: str, key: str = "experiment_id") -> DataFrame:
    """Differences between two records of a long table (key, section, path, value)."""
    pick = lambda who: long.filter(F.col(key) == who).select(F.concat_ws("/", "section", "path").alias("path"), "value")
    return diff_maps(pick(left), pick(right))


def commit_changes(records: DataFrame, left: str, right: str, key: str = "experiment_id", provenance: str = "provenance") -> DataFrame:
    """Producers whose commits differ between two records, by name: a and b as shown, the first 12 letters of long ones.

    A producer that a record lacks, or has as null, shows as (none).
    """
    commits = F.from_json(F.get_json_object(provenance, "$.producer_commits"), "map<string,string>")
    shown = lambda c: choose((c.isNull(), "(none)"), ((F.length(c) > 16) & (c != "unresolved"), F.concat(F.left(c, F.lit(12)), F.lit("..."))), otherwise=c)
    pick = lambda who, name: records.filter(F.col(key) == who).select(F.explode(commits).alias("producer", name))
    both = pick(left, "a").join(pick(right, "b"), "producer", "full_outer").filter(~F.col("a").eqNullSafe(F.col("b")))
    return both.select("producer", shown(F.col("a")).alias("a"), shown(F.col("b")).alias("b")).orderBy("producer")


# Fields that a finished run gives its record; what else a record has comes later or by default.
BUILT_FIELDS = (
    "experiment_id", "name", "manifest_path", "fingerprint", "feature_set_ref", "compatibility_fingerprint", "signal_export_output_dir", "provenance", "contract_version",
    "training_config", "training_metrics", "gate_reports", "cache_info", "tags", "hypothesis", "description", "created_at", "duration_seconds", "status", "stages_completed",
)


def built(rows: DataFrame) -> DataFrame:
    """The fields of a record that a run fills in itself; a column that is not there is an error, others are left out."""
    return rows.select(*BUILT_FIELDS)


# --- identity of rows across tables -----------------------------------------


def new_only(candidates: DataFrame, records: DataFrame, key: str = "fingerprint", first_match_compat: bool = False, ordinal: str = "ordinal") -> DataFrame:
    """Candidates whose fingerprint no record has, failures not counting.

    With ``first_match_compat`` only the first record of a fingerprint is
    looked at, so a failure standing before a success hides it.
    """
    done = records
    if first_match_compat:
        done = latest(records, key, F.col(ordinal).asc())
    done = without_kinds(done, "sweep_failure").select(key).distinct()
    return candidates.join(done, key, "left_anti")


def expected_missing(expected: DataFrame, actual: DataFrame, on: Sequence[str]) -> DataFrame:
    """Cells of the expected grid that the actual table lacks."""
    return expected.join(actual.select(*on).distinct(), list(on), "left_anti")


def paired(table: DataFrame, key: str, on: str) -> DataFrame:
    """All pairs of keys a < b that share ``on``: columns key_a, key_b and both sides' other columns."""
    rest = [c for c in table.columns if c not in (key, on)]
    a = table.select(on, *[F.col(c).alias(f"{c}_a") for c in (key, *rest)])
    b = table.select(on, *[F.col(c).alias(f"{c}_b") for c in (key, *rest)])
    return a.join(b, on).filter(F.col(f"{key}_a") < F.col(f"{key}_b"))


def overlay(ledger: DataFrame, verdicts: DataFrame, columns: Sequence[str], key: str = "fingerprint", ordinal: str = "ordinal") -> DataFrame:
    """Ledger rows with the columns of their verdict laid over, and verdicts without a ledger row after them.

    Of verdicts with one key the last by ordinal counts.  ``source`` tells
    where a row comes from.
    """
    last = latest(verdicts.filter(F.col(key).isNotNull()), key, F.col(ordinal).desc())
    seen = last.select(key, *[F.col(c).alias(f"_{c}") for c in columns])
    base = ledger.join(seen, key, "left")
    laid = [F.coalesce(F.col(f"_{c}"), F.col(c) if c in ledger.columns else F.lit(None)).alias(c) for c in columns]
    others = [c for c in ledger.columns if c not in columns]
    own = base.select(*others, *laid, F.lit("ledger").alias("source"))
    alone = last.join(ledger.select(key).distinct(), key, "left_anti")
    alone = alone.select(*[(F.col(c) if c in alone.columns else F.lit(None).cast(ledger.schema[c].dataType)).alias(c) for c in others], *columns, F.lit("discovery").alias("source"))
    return own.unionByName(alone)


def with_flags(rows: DataFrame, flags: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Adds ``kinds``: the sorted union of flag kinds found by any of several keys (flags: key_name, key, kind)."""
    out = rows
    for k in keys:
        found = flags.filter(F.col("key_name") == k).groupBy(F.col("key").alias(k)).agg(F.collect_set("kind").alias(f"_{k}_kinds"))
        out = out.join(found, k, "left")
    none = F.array().cast("array<string>")
    kinds = none
    for k in keys:
        kinds = F.array_union(kinds, F.coalesce(f"_{k}_kinds", none))
    return out.withColumn("kinds", F.array_sort(kinds)).drop(*[f"_{k}_kinds" for k in keys])
