"""Sinks: append-only stores, content-addressed artifacts, rendering."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.functions.scalars import is_sha256


def append_records(store: str, new: DataFrame, key: str = "experiment_id", partition: str = "record_type") -> None:
    """Append records to a Parquet store; ids that repeat, or that the store has, are an error and nothing is written."""
    spark = new.sparkSession
    clash = new.groupBy(key).count().filter("count > 1").select(key)
    if exists(spark, store):
        clash = clash.unionByName(spark.read.parquet(store).join(new.select(key), key, "left_semi").select(key))
    if found := clash.head(1):
        raise ValueError(f"{key} is taken: {found[0][0]!r}")
    new.write.mode("append").partitionBy(partition).parquet(store)


def exists(spark, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def index_envelope(records: DataFrame, version: str) -> DataFrame:
    """(entry, schema_version) of an index: one JSON object for each record, sorted by its ordinal."""
    plain = [c for c in records.columns if c not in ("ordinal", "file")]
    return records.orderBy("ordinal").select(F.to_json(F.struct(*plain)).alias("entry"), F.lit(version).alias("schema_version"))


def write_index(records: DataFrame, version: str, folder: str) -> None:
    """Write a versioned index: entries in part files of one JSON object a line, and beside them the schema they have."""
    index_envelope(records, version).select("entry").write.mode("overwrite").text(f"{folder}/entries")
    schema = json.dumps({"schema": {"version": version}, "entries": "entries"})
    records.sparkSession.createDataFrame([(schema,)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/envelope")


def with_notes(records: DataFrame, experiment_id: str, notes: str, key: str = "experiment_id") -> DataFrame:
    """The one field that may change."""
    return records.withColumn("notes", F.when(F.col(key) == experiment_id, F.lit(notes)).otherwise(F.col("notes")))


def artifact_paths(artifacts: DataFrame, kind: str = "kind", created: str = "created_at", digest: str = "sha256") -> DataFrame:
    """Content-addressed places ``<kind>/<yyyy_mm>/<sha256>.json``; equal contents of a kind are stored once."""
    rows = artifacts.filter(is_sha256(F.col(digest))).groupBy(kind, digest).agg(F.min(created).alias(created), F.count("*").alias("n_uses"))
    month = F.replace(F.substring(created, 1, 7), F.lit("-"), F.lit("_"))
    return rows.withColumn("path", F.concat_ws("/", F.col(kind), month, F.concat(F.col(digest), F.lit(".json"))))


# Files that are kept as artifacts, and their kinds.
ARTIFACT_FILES = {"feature_importance_v1.json": "feature_importance", "test_metrics_ci_v1.json": "test_metrics_ci", "pairwise_compare_v1.json": "pairwise_compare"}


def is_object(text: Column) -> Column:
    """Whether a text is a JSON object."""
    return F.coalesce(F.try_parse_json(text).isNotNull() & text.rlike(r"^\s*\{"), F.lit(False))


def route_artifacts(files: DataFrame, validators: Mapping[str, Callable[[Column], Column]] | None = None, names: Mapping[str, str] | None = None) -> DataFrame:
    """kind, sha256 and valid of each output file (path, text) whose name is an artifact's.

    ``validators`` holds a condition on the text for each kind; a kind without
    one must be a JSON object.  A condition that is null is not met.
    """
    names = ARTIFACT_FILES if names is None else names
    kinds = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    kind = F.try_element_at(kinds, F.element_at(F.split("path", "/"), -1))
    valid = is_object(F.col("text"))
    for k, condition in (validators or {}).items():
        valid = F.when(F.col("kind") == k, F.coalesce(condition(F.col("text")), F.lit(False))).otherwise(valid)
    return files.withColumn("kind", kind).filter("kind IS NOT NULL").select("path", "kind", F.sha2("text", 256).alias("sha256"), valid.alias("valid"))


def write_artifacts(store: str, artifacts: DataFrame) -> None:
    """Add the contents that the store does not have, partitioned by kind and month of first creation; writing again adds nothing.

    Rows whose digest is no SHA-256 are left out, as :func:`artifact_paths` leaves them out.
    """
    spark = artifacts.sparkSession
    rest = [c for c in artifacts.columns if c not in ("kind", "sha256", "created_at")]
    first = F.min(F.struct("created_at", *rest)).alias("first")  # of equal contents the earliest
    new = artifacts.filter(is_sha256(F.col("sha256"))).groupBy("kind", "sha256").agg(first).select("kind", "sha256", "first.*").withColumn("month", F.replace(F.substring("created_at", 1, 7), F.lit("-"), F.lit("_")))
    if exists(spark, store):
        new = new.join(spark.read.parquet(store).select("kind", "sha256"), ["kind", "sha256"], "left_anti")
    new.write.mode("append").partitionBy("kind", "month").parquet(store)


def records_from_metrics(documents: DataFrame, key: str = "name", text: str = "text") -> DataFrame:
    """(name, shape, metrics) of back-filled metric files of four shapes: flat, under ``metrics``, under ``test``, or a list's last entry."""
    nested = lambda path: F.from_json(F.get_json_object(text, path), "map<string,double>")
    flat = F.from_json(text, "map<string,double>")
    last = F.try_element_at(F.from_json(text, "array<map<string,double>>"), F.lit(-1))
    shape = F.when(F.col(text).rlike(r"^\s*\["), "list").when(nested("$.metrics").isNotNull(), "metrics").when(nested("$.test").isNotNull(), "test").otherwise("flat")
    metrics = F.when(shape == "list", last).when(shape == "metrics", nested("$.metrics")).when(shape == "test", nested("$.test")).otherwise(flat)
    return documents.select(key, shape.alias("shape"), F.map_filter(metrics, lambda _, v: v.isNotNull()).alias("metrics"))


def records_from_verdicts(verdicts: DataFrame) -> DataFrame:
    """Discovery records of verdicts; a configuration hash that is no SHA-256 is an error."""
    checked = F.when(is_sha256(F.col("config_sha256")), F.col("config_sha256")).otherwise(F.raise_error(F.concat(F.lit("no hash: "), F.coalesce("config_sha256", F.lit("null")))))
    return verdicts.select(F.concat_ws("_", F.lit("discovery"), "study", F.substring("config_sha256", 1, 12)).alias("experiment_id"), F.col("study").alias("name"), checked.alias("fingerprint"), F.lit("discovery").alias("record_type"), F.lit("completed").alias("status"), F.col("run_timestamp_utc").alias("created_at"), "verdict")


def render(table: DataFrame, form: str = "text", limit: int = 1000) -> str:
    """A report of a table's first ``limit`` rows as text, markdown or json."""
    rows = table.limit(limit).collect()
    names = table.columns
    if form == "json":
        return json.dumps([r.asDict(recursive=True) for r in rows], sort_keys=True, default=str)
    show = lambda v: "" if v is None else f"{v:.6g}" if isinstance(v, float) else str(v)
    cells = [[show(r[c]) for c in names] for r in rows]
    if form == "markdown":
        line = lambda xs: "| " + " | ".join(xs) + " |"
        return "\n".join([line(names), line(["-"] * len(names)), *map(line, cells)])
    widths = [max(map(len, column)) for column in zip(names, *cells, strict=True)]
    return "\n".join("  ".join(x.ljust(w) for x, w in zip(xs, widths, strict=True)).rstrip() for xs in [names, *cells])


def migrate_presets(presets: DataFrame, columns: Sequence[str] = ("name", "feature_indices", "source_feature_count", "contract_version")) -> DataFrame:
    """Feature sets, with their content hash, of named presets."""
    from quillon.operators.identity import selection, set_hash

    indices = selection(F.col("feature_indices"))
    return presets.select(*columns).withColumn("feature_indices", indices).withColumn("content_hash", set_hash(indices, F.col("source_feature_count"), F.col("contract_version")))
