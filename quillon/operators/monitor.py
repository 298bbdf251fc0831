"""Monitoring: drift findings and the table that fuses ledger and discoveries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.functions.scalars import short_hash, version_key
from quillon.functions.semantics import first_finite
from quillon.operators.records import overlay, with_flags
from quillon.operators.reduce import divergence

FLAGS = ("severity", "kind", "key_name", "key", "detail")


def _flag(df: DataFrame, severity: str, kind: str, key_name: str, key: Column, detail: Column) -> DataFrame:
    return df.select(F.lit(severity).alias("severity"), F.lit(kind).alias("kind"), F.lit(key_name).alias("key_name"), key.cast("string").alias("key"), detail.cast("string").alias("detail"))


def count_drift(index: DataFrame | None, disk: DataFrame, status: str = "envelope") -> DataFrame:
    """A flag when the index and the record files differ in number (warn), or when there is none (info) or an unreadable one (warn).

    ``status`` is the index file's, as :func:`quillon.sources.files.index_status` tells it, or "missing".
    """
    if index is None or status in ("missing", "malformed"):
        n = disk.agg(F.count("*").alias("n"))
        told = F.concat(F.lit("no index" if status != "malformed" else "unreadable index"), F.lit("; records: "), F.col("n").cast("string"))
        return _flag(n, "warn" if status == "malformed" else "info", "index_count", "table", F.lit("index"), told)
    both = index.agg(F.count("*").alias("a")).crossJoin(disk.agg(F.count("*").alias("b")))  # one row each
    return _flag(both.filter("a <> b"), "warn", "index_count", "table", F.lit("index"), F.concat_ws(" vs ", F.col("a").cast("string"), F.col("b").cast("string")))


def config_drift(records: DataFrame) -> DataFrame:
    """Flags of names run under several configurations or provenances."""
    found = divergence(records)
    return _flag(found, "warn", "divergence", "name", F.col("name"), F.concat_ws(" ", "kind", F.col("n").cast("string")))


def stale_versions(verdicts: DataFrame, current: str, version: str = "stats_version", key: str = "probe_id") -> DataFrame:
    """Verdicts computed with an older version than the current one."""
    old = verdicts.filter(F.col(version).isNotNull() & (version_key(F.col(version)) < version_key(F.lit(current))))
    return _flag(old, "info", "stale_version", key, F.col(key), F.col(version))


def schema_drift(records: DataFrame, verdicts: DataFrame, expected: str | None, version: str = "contract_version", warnings: str = "parse_warnings", key: str = "experiment_id", verdict_key: str = "probe_id") -> DataFrame:
    """Records of another contract version than the current one, and verdicts that were read with warnings."""
    own = F.nullif(F.col(version), F.lit(""))
    other = records.filter(own != F.lit(expected)) if expected else records.limit(0)
    other = _flag(other, "info", "schema", key, F.col(key), F.col(version))
    read = _flag(verdicts.filter(F.size(warnings) > 0), "info", "parse", verdict_key, F.col(verdict_key), F.array_join(warnings, "; "))
    return other.unionByName(read)


def all_drift(*flags: DataFrame) -> DataFrame:
    out = flags[0]
    for f in flags[1:]:
        out = out.unionByName(f)
    return out


def fails(severities: Sequence[str], fail_on: str) -> bool:
    """Driver side: whether found severities make a run fail under ``never``, ``warn`` or ``error``."""
    return fail_on != "never" and bool({"error"} & set(severities) or (fail_on == "warn" and severities))


def headline(record_type: Column, choices: dict[str, Sequence[str]], default: Sequence[str], metrics: Column) -> tuple[Column, Column]:
    """(name, value) of the first finite metric of the list that belongs to a record's type."""
    pick = lambda names: first_finite([(n, metrics[n]) for n in names])
    name, value = pick(default)
    for kind, names in choices.items():
        n, v = pick(names)
        name, value = F.when(record_type == kind, n).otherwise(name), F.when(record_type == kind, v).otherwise(value)
    return name, value


def fused(ledger: DataFrame, verdicts: DataFrame, flags: DataFrame, columns: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Ledger rows overlaid with their verdicts, verdicts without one, drift kinds, and a short provenance."""
    rows = with_flags(overlay(ledger, verdicts, columns), flags, keys)
    return rows.withColumn("origin", short_hash(F.col("fingerprint")))


def select_rows(table: DataFrame, kind: str = "", source: str = "", edge_only: bool = False, status: str = "", text: str = "", within: Sequence[str] = ("name",)) -> DataFrame:
    """The table's filters; ``text`` is looked for in the named columns without regard to case."""
    if kind:
        table = table.filter(F.array_contains("kinds", kind))
    if source:
        table = table.filter(F.col("source") == source)
    if edge_only:
        table = table.filter(F.coalesce(F.col("edge"), F.lit(False)))
    if status:
        table = table.filter(F.col("status") == status)
    if text:
        hit = F.lit(False)
        for c in within:
            hit = hit | F.contains(F.lower(F.coalesce(F.col(c), F.lit(""))), F.lit(text.lower()))
        table = table.filter(hit)
    return table
