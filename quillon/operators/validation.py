"""Rules over configurations and data: every check gives rows of (severity, rule, message, context)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.functions.scalars import fold_name, minor_differs, types_match
from quillon.functions.semantics import choose, non_empty

FINDINGS = "severity string, rule string, message string, context string"


def finding(df: DataFrame, severity: str, rule: str, message: Column | str, context: Column | str) -> DataFrame:
    text = lambda x: F.lit(x) if isinstance(x, str) else x.cast("string")
    return df.select(F.lit(severity).alias("severity"), F.lit(rule).alias("rule"), text(message).alias("message"), text(context).alias("context"))


def together(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def counts(findings: DataFrame) -> DataFrame:
    """Errors and warnings, and whether there is no error."""
    return findings.agg(F.count_if(F.col("severity") == "error").alias("errors"), F.count_if(F.col("severity") == "warn").alias("warnings"), (F.count_if(F.col("severity") == "error") == 0).alias("ok"))


def contract_version(configs: DataFrame, expected: str, key: str = "config_id", version: str = "contract_version") -> DataFrame:
    """A missing version warns, one of another major or minor is an error."""
    v = non_empty(F.col(version))
    return together(finding(configs.filter(v.isNull()), "warn", "contract", "no contract version", F.col(key)), finding(configs.filter(v.isNotNull() & minor_differs(v, F.lit(expected))), "error", "contract", F.concat(F.lit("contract version "), v), F.col(key)))


def missing_references(references: DataFrame, existing: DataFrame, path: str = "path", key: str = "config_id") -> DataFrame:
    """References to paths that are not there."""
    return finding(references.join(existing.select(path).distinct(), path, "left_anti"), "error", "reference", F.concat(F.lit("missing: "), F.col(path)), F.col(key))


def consistent(a: DataFrame, b: DataFrame, keys: DataFrame, severity: str = "error") -> DataFrame:
    """Two flattened configurations (path, value) disagree on a pair of paths (path_a, path_b) that must be equal."""
    left = a.select(F.col("path").alias("path_a"), F.col("value").alias("value_a"))
    right = b.select(F.col("path").alias("path_b"), F.col("value").alias("value_b"))
    bad = keys.join(left, "path_a").join(right, "path_b").filter(~F.col("value_a").eqNullSafe(F.col("value_b")))
    return finding(bad, severity, "consistency", F.concat_ws("", "path_a", F.lit("="), F.coalesce("value_a", F.lit("null")), F.lit(" but "), "path_b", F.lit("="), F.coalesce("value_b", F.lit("null"))), F.col("path_a"))


def uniform_exports(exports: DataFrame, directory: str = "dir", version: str = "schema_version", files: str = "n_files", listed: str = "n_listed") -> DataFrame:
    """Export folders of mixed schema versions, or whose manifest lists another number of files than there are."""
    per = exports.groupBy(directory).agg(F.count_distinct(version).alias("versions"), F.sum(files).alias("have"), F.sum(listed).alias("want"))
    return together(finding(per.filter("versions > 1"), "error", "uniform", "mixed schema versions", F.col(directory)), finding(per.filter("have <> want"), "warn", "uniform", "manifest and folder differ", F.col(directory)))


# Model, least and most features, least sequence length, sources.
MODELS = [
    ("deeplob", 40, 98, 20, ["any"]),
    ("gru", 1, None, 1, ["any"]),
    ("hmhp", 1, None, 1, ["any"]),
    ("hmhp_regressor", 1, None, 1, ["any"]),
    ("logistic_lob", 1, None, 1, ["any"]),
    ("lstm", 1, None, 1, ["any"]),
    ("mlplob", 1, None, 4, ["any"]),
    ("temporal_gradboost", 1, None, 1, ["any"]),
    ("temporal_ridge", 1, None, 1, ["any"]),
    ("tlob", 1, None, 4, ["any"]),
    ("xgboost_lob", 1, None, 1, ["any"]),
]


def model_table(spark: SparkSession) -> DataFrame:
    """What the known models take, as :func:`input_contracts` wants it."""
    return spark.createDataFrame(MODELS, "model string, min_features int, max_features int, min_sequence_length int, sources array<string>")


def input_contracts(runs: DataFrame, models: DataFrame) -> DataFrame:
    """Runs outside what their model takes.

    ``runs``: run_id, model, n_features, sequence_length, source.  ``models``:
    model, min_features, max_features (null: no bound), min_sequence_length,
    sources (array; 'any' takes all).  An unknown model warns, unless its run has no
    features or no sequence, which is an error whatever the model.
    """
    j = runs.join(models.withColumn("_known", F.lit(True)), "model", "left")
    bad = lambda cond, rule, text: finding(j.filter(F.col("_known") & F.coalesce(cond, F.lit(False))), "error", rule, F.concat_ws(" ", F.col("model"), F.lit(text)), F.col("run_id"))
    return together(
        finding(j.filter("_known IS NULL AND (n_features <= 0 OR sequence_length <= 0)"), "error", "positive", F.concat_ws(" ", F.col("model"), F.lit("needs features and a sequence")), F.col("run_id")),
        finding(j.filter("_known IS NULL AND NOT coalesce(n_features <= 0 OR sequence_length <= 0, false)"), "warn", "model", F.concat(F.lit("unknown model "), "model"), F.col("run_id")),
        bad(F.col("n_features") < F.coalesce("min_features", F.lit(1)), "min_features", "needs more features"),
        bad(F.col("n_features") > F.col("max_features"), "max_features", "takes fewer features"),
        bad(F.col("sequence_length") < F.coalesce("min_sequence_length", F.lit(1)), "sequence", "needs a longer sequence"),
        bad(~F.array_contains("sources", "any") & ~F.array_contains(F.col("sources"), F.col("source")), "source", "does not take the source"),
    )


def required_keys(declared: DataFrame, required: DataFrame, key: str = "config_id", name: str = "key") -> DataFrame:
    """Required keys that a configuration does not declare."""
    every = declared.select(key).distinct().crossJoin(F.broadcast(required.select(name).distinct()))  # a policy's fixed list of keys for each configuration
    return finding(every.join(declared.select(key, name), [key, name], "left_anti"), "error", "required", F.concat(F.lit("missing key "), F.col(name)), F.col(key))


def unknown_keys(declared: DataFrame, known: DataFrame, key: str = "config_id", name: str = "key") -> DataFrame:
    """Keys that nothing knows: likely typing errors."""
    return finding(declared.join(known.select(name).distinct(), name, "left_anti"), "warn", "unknown", F.concat(F.lit("unknown key "), F.col(name)), F.col(key))


def label_identity(runs: DataFrame) -> DataFrame:
    """Whether the label that was scored is the one the model was fitted on.

    run_id, scored_name, fitted_name, scored_type, fitted_type, scored_horizon,
    fitted_horizon.  verdict: same, differs (with what), or unknown.
    """
    name = F.when(non_empty(F.col("scored_name")).isNotNull() & non_empty(F.col("fitted_name")).isNotNull(), fold_name(F.col("scored_name")) == fold_name(F.col("fitted_name")))
    kind = types_match(F.col("scored_type"), F.col("fitted_type"))
    horizon = F.col("scored_horizon") == F.col("fitted_horizon")
    parts = F.filter(F.array(F.when(~name, "name"), F.when(~kind, "type"), F.when(~horizon, "horizon")), lambda x: x.isNotNull())
    unknown = name.isNull() & kind.isNull() & horizon.isNull()
    return runs.withColumn("differs", parts).withColumn("verdict", choose((F.size("differs") > 0, "differs"), (unknown, "unknown"), otherwise="same"))


def paired_labels(signals: DataFrame, digest: str = "label_sha", horizon: str = "horizon") -> DataFrame:
    """Whether all treatments share one label vector and one horizon."""
    return signals.agg(F.count_distinct(digest).alias("n_labels"), F.count_distinct(F.coalesce(F.col(horizon).cast("string"), F.lit("none"))).alias("n_horizons")).withColumn("paired", (F.col("n_labels") == 1) & (F.col("n_horizons") == 1))


def exclusive(configs: DataFrame, columns: Sequence[str], key: str = "config_id") -> DataFrame:
    """Configurations that give more than one of several alternatives."""
    given = sum((F.col(c).isNotNull().cast("int") for c in columns), F.lit(0))
    return finding(configs.filter(given > 1), "error", "exclusive", "only one of " + ", ".join(columns), F.col(key))
