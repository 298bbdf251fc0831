"""One object for a store of records: what a user asks of it, as methods that return DataFrames."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.operators import grid, identity, monitor, records, reduce, stats, validation
from quillon.sources import files, sinks


class Workbench:
    """Records of a Parquet store, or of a folder of JSON files."""

    def __init__(self, spark: SparkSession, store: str, schema_version: str = "1.0.0") -> None:
        self.spark, self.store, self.schema_version = spark, store, schema_version

    @property
    def records(self) -> DataFrame:
        return self.spark.read.parquet(self.store)

    # --- ledger -------------------------------------------------------------

    def rebuild(self, folder: str) -> DataFrame:
        """Write the store anew from record files; returns the files that could not be read."""
        good, bad = files.quarantine(files.read_records(self.spark, folder))
        good.write.mode("overwrite").partitionBy("record_type").parquet(self.store)
        return bad

    def append(self, new: DataFrame) -> None:
        sinks.append_records(self.store, new)

    def list(self, newest_first: bool = True) -> DataFrame:
        return files.newest_first(self.records) if newest_first else self.records.orderBy("ordinal")

    def show(self, experiment_id: str) -> DataFrame:
        return files.describe_record(self.records, experiment_id)

    def search(self, **wanted: object) -> DataFrame:
        """Keyword arguments of :class:`quillon.operators.records.RecordFilter`."""
        return records.filter_records(self.records, records.RecordFilter(**wanted))

    def summary(self) -> DataFrame:
        return records.summary(self.records)

    def backfill(self, documents: DataFrame) -> DataFrame:
        return sinks.records_from_metrics(documents)

    def fingerprint_explain(self, flat: DataFrame, key: str) -> DataFrame:
        """Fingerprints with the components they are made of."""
        return identity.fingerprints(flat, key)

    def check_duplicates(self, candidates: DataFrame) -> DataFrame:
        """Candidates, and whether a record that did not fail has their fingerprint."""
        new = records.new_only(candidates, self.records).select("fingerprint", F.lit(False).alias("_dup")).distinct()
        return candidates.join(new, "fingerprint", "left").withColumn("duplicate", F.coalesce("_dup", F.lit(True))).drop("_dup")

    # --- comparison ---------------------------------------------------------

    def compare(self, metrics: Sequence[str], sort_by: str, k: int | None = None, **options: object) -> DataFrame:
        return records.compare(records.without_kinds(self.records, "sweep_aggregate"), metrics, sort_by, k, **options)

    def diff(self, left: str, right: str) -> DataFrame:
        return records.diff_records(self.long(), left, right)

    def long(self) -> DataFrame:
        """(experiment_id, section, path, value) of configurations, metrics and hashes."""
        parts = []
        for section in ("training_metrics", "backtest_metrics"):
            parts.append(self.records.select("experiment_id", F.explode(F.map_entries(section)).alias("e")).select("experiment_id", F.lit(section).alias("section"), F.col("e.key").alias("path"), F.col("e.value").cast("string").alias("value")))
        for section in ("training_config", "extraction_config", "backtest_params"):
            parts.append(records.flatten_json(self.records, "experiment_id", section).select("experiment_id", F.lit(section).alias("section"), "path", "value"))
        hashes = F.array(*[F.struct(F.lit(c).alias("path"), F.col(c).alias("value")) for c in ("fingerprint", "compatibility_fingerprint", "experiment_provenance_hash")])
        parts.append(self.records.select("experiment_id", F.inline(hashes)).select("experiment_id", F.lit("hash").alias("section"), "path", "value"))
        return validation.together(*parts)

    # --- sweeps -------------------------------------------------------------

    def sweep_expand(self, axes: DataFrame, sweep: str, strategy: str = "grid") -> DataFrame:
        """The grid; a sweep with errors raises and says them."""
        if errors := [r["message"] for r in grid.findings(axes, strategy).filter("severity = 'error'").collect()]:  # a configuration's own few findings
            raise ValueError("; ".join(errors))
        return grid.STRATEGIES[strategy](axes, sweep)

    def sweep_results(self, sweep_id: str, metrics: Sequence[str], sort_by: str) -> DataFrame:
        rows = records.without_kinds(self.records.filter(F.col("sweep_id") == sweep_id), "sweep_aggregate")
        return records.compare(rows, metrics, sort_by, keys=("experiment_id", "axis_values"))

    def sweep_compare(self, signals: DataFrame, statistic: str = "spearman", replicates: int = stats.REPLICATES) -> DataFrame:
        """All pairs of a sweep's treatments, by q."""
        return stats.compare_pairs(stats.paired_mask(signals), statistic, replicates).orderBy("q")

    # --- feature sets and caches --------------------------------------------

    def feature_sets(self, documents: DataFrame) -> DataFrame:
        return files.feature_sets(documents)

    def feature_set(self, documents: DataFrame, name: str) -> DataFrame:
        """One set by name; a wrong content hash is an error."""
        row = files.feature_sets(documents).filter(F.col("name") == name)
        return row.filter(F.when(~F.col("intact"), F.raise_error(F.concat(F.lit("content hash is wrong: "), F.col("name")))).otherwise(F.lit(True)))

    @staticmethod
    def cache_list(entries: DataFrame, by: str = "mtime", limit: int = 50) -> DataFrame:
        return entries.orderBy(F.desc(by), "cache_key").limit(limit)

    @staticmethod
    def cache_collect(entries: DataFrame, budget: int, max_age: float | None = None, now: float = 0.0) -> DataFrame:
        return reduce.evictions(entries, budget, max_age, now)

    @staticmethod
    def cache_pin(entries: DataFrame, key: str, pinned: bool = True) -> DataFrame:
        return entries.withColumn("pinned", F.when(F.col("cache_key") == key, F.lit(pinned)).otherwise(F.col("pinned")))

    # --- monitor ------------------------------------------------------------

    def drift(self, verdicts: DataFrame, index: DataFrame, stats_version: str) -> DataFrame:
        return monitor.all_drift(
            monitor.count_drift(index, self.records),
            monitor.config_drift(self.records.withColumn("provenance_hash", F.col("experiment_provenance_hash"))),
            monitor.stale_versions(verdicts, stats_version),
            monitor.schema_drift(self.records, verdicts, self.schema_version),
        )

    def table(self, verdicts: DataFrame, flags: DataFrame, columns: Sequence[str] = ("verdict",), **filters: object) -> DataFrame:
        """Ledger and discoveries in one table; ``filters`` as of :func:`quillon.operators.monitor.select_rows`."""
        return monitor.select_rows(monitor.fused(self.records, verdicts, flags, list(columns), ["name"]), **filters)

    def sql(self, text: str, views: Mapping[str, DataFrame] | None = None) -> DataFrame:
        """SQL over the records (view ``records``) and other named tables."""
        return self.spark.sql(text, **{"records": self.records, **(views or {})})


def validate(path: str, required: Sequence[str]) -> list[str]:
    """Driver side: what a configuration file lacks or cannot be read for."""
    try:
        document = files.load_config(path)
    except (ValueError, RuntimeError, json.JSONDecodeError) as e:
        return [str(e)]
    return [f"missing: {p}" for p in required if grid.get_path(document, p) is None]
