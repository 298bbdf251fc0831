"""Sources: record files, indexes, verdict trees, arrays, logs, listings, configurations."""

from __future__ import annotations

import io
import json
import tomllib
from collections.abc import Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillon.functions.scalars import last_match, minor_differs
from quillon.functions.semantics import choose, is_finite
from quillon.operators.identity import canonical_hash
from quillon.operators.records import flatten_json

S, D, L, B = T.StringType(), T.DoubleType(), T.LongType(), T.BooleanType()
_numbers = T.MapType(S, D)

RECORD = T.StructType(
    [T.StructField(n, S) for n in ("experiment_id", "name", "fingerprint", "record_type", "status", "created_at", "sweep_id", "parent_experiment_id", "contract_version", "hypothesis", "description", "notes", "manifest_path", "compatibility_fingerprint", "experiment_provenance_hash", "signal_export_output_dir")]
    + [T.StructField("duration_seconds", D), T.StructField("tags", T.ArrayType(S)), T.StructField("stages_completed", T.ArrayType(S)), T.StructField("axis_values", T.MapType(S, S))]
    + [T.StructField(n, S) for n in ("training_metrics", "backtest_metrics")]
    + [T.StructField(n, S) for n in ("training_config", "extraction_config", "backtest_params", "gate_reports", "cache_info", "sweep_failure_info", "provenance", "dataset_health")]
    + [
        T.StructField("artifacts", T.ArrayType(T.StructType([T.StructField(n, S) for n in ("kind", "method", "path", "sha256")] + [T.StructField("bytes", L)]))),
        T.StructField("sub_records", T.ArrayType(T.StructType([*[T.StructField(n, S) for n in ("experiment_id", "name", "fingerprint", "status")], T.StructField("duration_seconds", D), T.StructField("axis_values", T.MapType(S, S)), T.StructField("training_metrics", S), T.StructField("backtest_metrics", S)]))),
        T.StructField("feature_set_ref", T.StructType([T.StructField("name", S), T.StructField("content_hash", S)])),
    ]
)


def _metrics(name: str) -> dict:
    """A metrics object as a map of its numbers, and what is no number (nested or text) as a map of JSON texts beside it."""
    texts = F.from_json(name, "map<string,string>")
    numbers = F.transform_values(texts, lambda _, v: v.try_cast("double"))
    return {name: F.map_filter(numbers, lambda _, v: v.isNotNull()), f"{name}_other": F.map_filter(texts, lambda _, v: v.try_cast("double").isNull() & v.isNotNull())}


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Record files (one JSON object each) in the order of their file names, as ``ordinal``; open sub-trees stay JSON text.

    A file that is no record is kept with ``_corrupt`` set; see :func:`quarantine`.
    """
    schema = T.StructType([*RECORD.fields, T.StructField("_corrupt", S)])
    rows = spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path)
    config = lambda *paths: F.coalesce(*[F.get_json_object(c, p) for c in ("training_config", "extraction_config") for p in paths])
    derived = {"model_type": config("$.model.model_type", "$.model_type"), "labeling_strategy": config("$.data.labeling_strategy", "$.labels.strategy", "$.labeling_strategy")}
    derived["model_config_hash"] = config("$.model_config_hash")
    return rows.withColumns({"file": F.col("_metadata.file_name"), "ordinal": F.col("_metadata.file_name"), **derived, **_metrics("training_metrics"), **_metrics("backtest_metrics")})


def quarantine(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good records, files that could not be read)."""
    bad = F.col("_corrupt").isNotNull() | F.col("experiment_id").isNull()
    return records.filter(~bad).drop("_corrupt"), records.filter(bad).select("file", "_corrupt")


def newest_first(records: DataFrame) -> DataFrame:
    return records.orderBy(F.col("created_at").desc_nulls_last(), "ordinal")


def find_record(records: DataFrame, experiment_id: str) -> DataFrame:
    return records.filter(F.col("experiment_id") == experiment_id)


def describe_record(records: DataFrame, experiment_id: str) -> DataFrame:
    """(section, key, value) of one record: header and hashes, then metrics, provenance, health and gate reports, artifacts, each sorted by key."""
    row = find_record(records, experiment_id)
    plain = ("experiment_id", "name", "record_type", "status", "created_at", "fingerprint", "compatibility_fingerprint", "experiment_provenance_hash")
    head = row.select(F.inline(F.array(*[F.struct(F.lit("header").alias("section"), F.lit(c).alias("key"), F.col(c).cast("string").alias("value")) for c in plain])))
    out = head.withColumn("_o", F.lit(0))
    say = lambda df, o, section, key, value: df.select(F.lit(section).alias("section"), key.alias("key"), value.cast("string").alias("value"), F.lit(o).alias("_o"))
    for o, section in enumerate(("training_metrics", "training_metrics_other", "backtest_metrics", "backtest_metrics_other"), 1):
        out = out.unionByName(say(row.select(F.explode(F.map_entries(section)).alias("e")), o, section, F.col("e.key"), F.col("e.value")))
    for o, section in enumerate(("provenance", "dataset_health", "gate_reports", "cache_info", "sweep_failure_info"), 5):
        out = out.unionByName(say(flatten_json(row, "experiment_id", section), o, section, F.col("path"), F.col("value")))
    out = out.unionByName(say(row.select(F.explode("artifacts").alias("a")), 10, "artifacts", F.concat_ws("/", "a.kind", "a.path"), F.col("a.sha256")))
    return out.orderBy("_o", F.when(F.col("_o") > 0, F.col("key"))).drop("_o")


def index_status(envelopes: DataFrame, version: str, text: str = "text") -> DataFrame:
    """How index texts are to be used: envelope, version_mismatch, bare_list or malformed."""
    tree = F.try_parse_json(text)
    kind = F.schema_of_variant(tree)
    own = F.try_variant_get(tree, "$.schema.version", "string")
    state = choose((tree.isNull(), "malformed"), (kind.startswith("ARRAY"), "bare_list"), (own.isNull() | F.try_variant_get(tree, "$.entries", "variant").isNull(), "malformed"), (minor_differs(own, F.lit(version)), "version_mismatch"), otherwise="envelope")
    return envelopes.withColumn("index_status", state)


def read_verdicts(spark: SparkSession, roots: Sequence[str], folder: str = "results", deny: Sequence[str] = (), skip_prefix: Sequence[str] = ("_", "."), skip_glob: str = r"shard[0-9]+of[0-9]+", skip_folders: Sequence[str] = (".venv", "site-packages"), gated_out: bool = True) -> DataFrame:
    """Verdict files that are direct children of a ``results`` folder under any root, sorted by tree, study and file.

    Files of denied names, hidden prefixes or shard parts are left out, and
    those below a folder of ``skip_folders``; ``gated_out=False`` leaves out
    verdicts of GATED_OUT too.  A verdict without a digest of its configuration
    has that of its ``config`` object's canonical JSON.
    """
    rows = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").text(list(roots), wholetext=True).withColumn("source_path", F.col("_metadata.file_path"))
    parts = F.split("source_path", "/")
    rows = rows.withColumns({"file": F.element_at(parts, -1), "folder": F.element_at(parts, -2), "study": F.element_at(parts, -3)}).filter(F.col("folder") == folder)
    rows = rows.filter(~F.arrays_overlap(parts, F.array(*[F.lit(x) for x in ("\x00", *skip_folders)])))
    for p in skip_prefix:
        rows = rows.filter(~F.col("file").startswith(p))
    rows = rows.filter(~F.col("file").rlike(skip_glob))
    if deny:
        rows = rows.filter(~F.col("file").isin(*deny))
    if not gated_out:
        rows = rows.filter(~F.coalesce(F.get_json_object("value", "$.verdict") == "GATED_OUT", F.lit(False)))
    tree = F.try_parse_json("value")
    get = lambda p, t: F.try_variant_get(tree, p, t)
    own = canonical_hash(F.get_json_object("value", "$.config"))
    return rows.select(
        "study", "file", "source_path",
        get("$.verdict", "string").alias("verdict"), get("$.any_tradeable_edge", "boolean").alias("any_tradeable_edge"),
        get("$.deflated_sharpe_ratio", "double").alias("deflated_sharpe_ratio"), F.coalesce(get("$.config_sha256", "string"), own).alias("config_sha256"),
        get("$.run_timestamp_utc", "string").alias("run_timestamp_utc"), get("$.metrics_version", "string").alias("stats_version"), get("$.schema_version", "string").alias("schema_version"),
        F.when(tree.isNull(), F.array(F.lit("not JSON"))).otherwise(F.array().cast("array<string>")).alias("parse_warnings"),
    ).orderBy("study", "file", "source_path")


def read_arrays(spark: SparkSession, path: str, horizons: int | None = None) -> DataFrame:
    """``.npy`` files as (file, sample_idx, horizon_idx, value): one row for each number, no pickles.

    One axis is horizon 0.  With ``horizons`` the second axis must have that
    size; if the first has it instead, the error says that the array looks
    transposed.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.npy").option("recursiveFileLookup", True).load(path).select(F.col("path").alias("file"), "content")
    schema = pa.schema([("file", pa.string()), ("sample_idx", pa.int64()), ("horizon_idx", pa.int32()), ("value", pa.float64())])

    def run(batches):
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                x = np.load(io.BytesIO(content), allow_pickle=False)
                if x.ndim not in (1, 2):
                    raise ValueError(f"{name}: {x.ndim} axes")
                x = x[:, None] if x.ndim == 1 else x
                if horizons and x.shape[1] != horizons:
                    hint = "; it looks transposed" if x.shape[0] == horizons else ""
                    raise ValueError(f"{name}: {x.shape[1]} horizons, expected {horizons}{hint}")
                for i in range(0, len(x), 65536):
                    part = x[i : i + 65536]
                    yield pa.RecordBatch.from_arrays([pa.array([name] * part.size), pa.array(np.repeat(np.arange(i, i + len(part)), x.shape[1])), pa.array(np.tile(np.arange(x.shape[1], dtype=np.int32), len(part))), pa.array(part.ravel().astype(float))], schema=schema)

    return files.mapInArrow(run, "file string, sample_idx long, horizon_idx int, value double")


def trade_fractions(expected: DataFrame, trades: DataFrame, capital: float, on: Sequence[str] = ("run_name", "threshold_label")) -> DataFrame:
    """Trades as shares of capital for every expected cell; a cell without a file is empty if its run completed, else an error."""
    from quillon.functions.scalars import as_fraction

    joined = expected.join(trades.withColumn("_there", F.lit(True)), list(on), "left")
    guard = F.when(F.col("_there").isNull() & (F.col("status") != "completed"), F.raise_error(F.concat_ws(" ", F.lit("no trades of unfinished run"), *on))).otherwise(F.lit(True))
    return joined.filter(guard).withColumn("pnl", as_fraction(F.col("pnl_usd"), capital)).drop("_there", "pnl_usd")


def history_rows(documents: DataFrame, key: str = "experiment_id", text: str = "text") -> DataFrame:
    """(key, epoch, metric, value) from training histories of either shape: a list of objects or an object of lists; finite numbers only."""
    rows = F.from_json(text, "array<map<string,double>>")
    columns = F.from_json(text, "map<string,array<double>>")
    kind = F.when(F.col(text).rlike(r"^\s*\["), "rows").otherwise("columns")
    typed = documents.select(key, rows.alias("r"), columns.alias("c"), kind.alias("k"))
    a = typed.filter("k = 'rows'").select(key, F.posexplode("r").alias("epoch", "m")).select(key, "epoch", F.explode("m").alias("metric", "value"))
    b = typed.filter("k = 'columns'").select(key, F.explode("c").alias("metric", "v")).select(key, "metric", F.posexplode("v").alias("epoch", "value")).select(key, "epoch", "metric", "value")
    return a.unionByName(b).filter(is_finite(F.col("value")))


def first_valid(candidates: DataFrame, key: str, order: str, text: str = "text") -> DataFrame:
    """Of candidate documents in order: the first that parses, nothing from behind the first that does not."""
    from quillon.operators.records import latest

    bad = F.try_parse_json(text).isNull()
    first = latest(candidates.withColumn("malformed", bad), key, F.col(order).asc())
    return first.filter("NOT malformed").drop("malformed")


def scrape_logs(spark: SparkSession, path: str, patterns: dict[str, str]) -> DataFrame:
    """One row for each log file: the last match of each pattern's first group."""
    rows = spark.read.text(path, wholetext=True).withColumn("file", F.col("_metadata.file_name"))
    return rows.select("file", *[last_match(F.col("value"), p).alias(n) for n, p in patterns.items()])


def conditioned_metrics(documents: DataFrame, key: str, wanted: str, text: str = "text") -> DataFrame:
    """Metrics of ``splits.test.conditioned_metrics`` whose filter is ``wanted``."""
    entries = F.from_json(F.get_json_object(text, "$.splits.test.conditioned_metrics"), "array<struct<filter:string,metric:string,value:double>>")
    return documents.select(key, F.inline(entries)).filter(F.col("filter") == wanted).drop("filter")


def listing(spark: SparkSession, path: str) -> DataFrame:
    """(path, dir, name, size_bytes, mtime) of every file below a folder; contents are not read."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return rows.select("path", F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("dir"), F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("size_bytes"), F.col("modificationTime").alias("mtime"))


def hashed_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, sha256, size_bytes) of every file below a folder."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return rows.select("path", F.sha2("content", 256).alias("sha256"), F.col("length").alias("size_bytes"))


def classify_outputs(files: DataFrame, kinds: dict[str, str], directory: str = "dir") -> DataFrame:
    """The kind of each output folder, by the first artifact name it holds."""
    per = files.groupBy(directory).agg(F.collect_set("name").alias("names"))
    return per.withColumn("kind", choose(*[(F.array_contains("names", artifact), kind) for artifact, kind in kinds.items()], otherwise="unknown")).drop("names")


def stage_dashboard(runs: DataFrame, files: DataFrame, artifacts: dict[str, str]) -> DataFrame:
    """(run_id, stage, present): which stages of a run (run_id, dir) left their artifact."""
    wanted = runs.select("run_id", "dir", F.inline(F.array(*[F.struct(F.lit(s).alias("stage"), F.lit(n).alias("name")) for s, n in artifacts.items()])))
    there = files.select("dir", "name").distinct().withColumn("present", F.lit(True))
    return wanted.join(there, ["dir", "name"], "left").select("run_id", "stage", F.coalesce("present", F.lit(False)).alias("present"))


def route_results(results: DataFrame, routes: dict[str, str], name: str = "name", order: str = "ordinal") -> DataFrame:
    """The last result of each route, a route being what a name's pattern (SQL LIKE) sends it to."""
    from quillon.operators.records import latest

    routed = results.withColumn("route", choose(*[(F.col(name).like(p), r) for p, r in routes.items()])).filter("route IS NOT NULL")
    return latest(routed, "route", F.col(order).desc())


def locate(files: DataFrame, suffixes: DataFrame) -> DataFrame:
    """(suffix, path): the only file whose name ends with a suffix; none where several or no file does."""
    hit = suffixes.join(files, F.col("name").endswith(F.col("suffix")))
    return hit.groupBy("suffix").agg(F.count("*").alias("n"), F.min("path").alias("path")).filter("n = 1").select("suffix", "path")


def feature_sets(documents: DataFrame, text: str = "text") -> DataFrame:
    """Feature-set documents by name, malformed ones left out, with ``intact``: whether their content hash is right."""
    from quillon.operators.identity import set_hash

    schema = "name string, feature_indices array<int>, source_feature_count int, contract_version string, content_hash string"
    rows = documents.select(F.from_json(text, schema).alias("s")).select("s.*").filter("name IS NOT NULL AND size(feature_indices) > 0")
    return rows.withColumn("intact", F.coalesce(set_hash(F.col("feature_indices"), F.col("source_feature_count"), F.col("contract_version")) == F.col("content_hash"), F.lit(False))).orderBy("name")


def load_config(path: str) -> dict:
    """Driver side: a TOML, YAML or JSON configuration; a missing file is empty, a bad one raises."""
    file = Path(path)
    if not file.exists():
        return {}
    text = file.read_text()
    if file.suffix == ".toml":
        return tomllib.loads(text)
    if file.suffix == ".json":
        return json.loads(text)
    if file.suffix in (".yaml", ".yml"):
        try:
            import yaml
        except ImportError as e:
            raise RuntimeError("reading YAML needs the yaml package") from e
        return yaml.safe_load(text) or {}
    raise ValueError(f"no configuration: {path}")


def first_existing(*paths: str | None) -> str | None:
    """Driver side: the first path that exists, of a chain of candidates."""
    return next((p for p in paths if p and Path(p).exists()), None)
