"""Content identity: canonical hashes, fingerprints, feature sets, caches."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.functions.scalars import finite_tree, json_text
from quillon.functions.semantics import choose, non_empty

#: Keys that tell about a run without changing its outcome; no fingerprint holds them.
OBSERVED_KEYS = (
    "name", "description", "tags", "version", "output_dir", "log_level", "verbose", "experiment",
    "importance", "artifacts", "rng_state", "callback_state", "producer_commits",
)


def canonical_json(value: object) -> str:
    """Sorted keys, ``", "`` and ``": "`` separators, NaN and infinities as null, other objects by str()."""
    return json.dumps(finite_tree(value), sort_keys=True, default=str)


def content_hash(value: object) -> str:
    return hashlib.sha256(canonical_json(value).encode()).hexdigest()


def canonical_hash(document: Column) -> Column:
    """:func:`content_hash` of a JSON text column; null for text that is no JSON."""

    @F.pandas_udf("string")
    def digest(texts: pd.Series) -> pd.Series:
        def one(text):
            try:
                return content_hash(json.loads(text))
            except (TypeError, ValueError, RecursionError):
                return None

        return texts.map(one)

    return digest(document)


def strip_keys(value: object, keys: Sequence[str] = OBSERVED_KEYS) -> object:
    """Driver side: a document without the keys at any depth, and without objects that this empties."""
    if not isinstance(value, Mapping):
        return value
    out = {k: strip_keys(v, keys) for k, v in value.items() if k not in keys}
    return {k: v for k, v in out.items() if not (isinstance(v, Mapping) and not v)}


def treatment_paths(flat: DataFrame, path: str = "path", keys: Sequence[str] = OBSERVED_KEYS) -> DataFrame:
    """The same over a long table of dotted paths: rows none of whose path segments is an observed key."""
    return flat.filter(~F.arrays_overlap(F.split(path, "\\."), F.array(*[F.lit(k) for k in keys])))


def fingerprints(flat: DataFrame, key: str, path: str = "path", value: str = "value", defaults: Mapping[str, str] | None = None) -> DataFrame:
    """(key, fingerprint, components) from a long configuration table (key, path, value).

    Observed keys go; values equal to their default go, so that a new option
    leaves old fingerprints alone; what is left is hashed as the JSON text of
    its sorted (path, value) pairs, with ``value_type`` where the table has
    one, so no value can pass for another path and 1 is not "1".  A key without
    any path left is fingerprinted by its name.
    """
    rows = treatment_paths(flat, path)
    for name, default in (defaults or {}).items():
        rows = rows.filter(~((F.col(path) == name) & F.coalesce(F.col(value) == default, F.lit(False))))
    line = F.concat(F.col(path), F.lit("="), F.coalesce(F.col(value), F.lit("null")))
    typed = [F.col("value_type")] if "value_type" in rows.columns else []
    pair = F.struct(F.col(path).alias("path"), F.col(value).alias("value"), *typed)
    lines = rows.groupBy(key).agg(F.array_sort(F.collect_list(line)).alias("components"), F.to_json(F.array_sort(F.collect_list(pair))).alias("_pairs"))
    every = flat.select(key).distinct().join(lines, key, "left")
    components = F.when(F.size("components") > 0, F.col("components")).otherwise(F.array(F.concat(F.lit("name="), F.col(key).cast("string"))))
    return every.withColumn("components", components).withColumn("fingerprint", F.sha2(F.coalesce("_pairs", F.to_json("components")), 256)).select(key, "fingerprint", "components")


def selection(indices: Column) -> Column:
    """A selection of columns as a set: sorted, without repeats."""
    return F.array_sort(F.array_distinct(indices))


def resolve_selections(runs: DataFrame, catalog: DataFrame) -> DataFrame:
    """Adds ``resolved`` to runs that select by set_name, by preset or by explicit indices; more than one of them is an error."""
    given = sum((F.col(c).isNotNull().cast("int") for c in ("set_name", "preset", "indices")), F.lit(0))
    look = lambda c: catalog.select(F.col("name").alias(c), F.col("feature_indices").alias(f"_{c}"))
    joined = runs.join(look("set_name"), "set_name", "left").join(look("preset"), "preset", "left")
    chosen = F.when(given > 1, F.raise_error(F.lit("more than one feature selection"))).otherwise(F.coalesce("indices", "_set_name", "_preset"))
    return joined.withColumn("resolved", selection(chosen)).drop("_set_name", "_preset")


def set_hash(indices: Column, source_count: Column, contract: Column) -> Column:
    """Content hash of a feature set: its canonical JSON of contract version, indices and source count."""
    body = F.concat(F.lit('{"contract_version": '), json_text(contract), F.lit(', "feature_indices": ['), F.array_join(F.transform(selection(indices), lambda i: i.cast("string")), ", "), F.lit('], "source_feature_count": '), source_count.cast("string"), F.lit("}"))
    return F.sha2(body, 256)


def all_or_nothing_hash(*parts: Column) -> Column:
    """Hash of the JSON list of all parts; null if any is null or empty (provenance and cache keys fail closed)."""
    whole = F.lit(True)
    for p in parts:
        whole = whole & non_empty(p.cast("string")).isNotNull()
    return F.when(whole, F.sha2(F.to_json(F.array(*[p.cast("string") for p in parts])), 256))


def directory_hash(files: DataFrame, directory: str = "dir", name: str = "name", size: str = "size_bytes") -> DataFrame:
    """A hash of each folder's sorted file names and sizes."""
    entry = F.concat_ws(":", name, F.col(size).cast("string"))
    return files.groupBy(directory).agg(F.sha2(F.concat_ws("\n", F.array_sort(F.collect_list(entry))), 256).alias("dir_hash"), F.count("*").alias("n_files"), F.sum(size).alias("total_bytes"))


def verify_tree(manifest: DataFrame, found: DataFrame, key: str | Sequence[str] = "cache_key") -> DataFrame:
    """For each cache entry whether every file of its manifest is there with the same size, then the same hash.

    ``key``: the column or columns that name an entry.
    """
    key = [key] if isinstance(key, str) else list(key)
    both = manifest.select(*key, "path", F.col("size_bytes").alias("want_size"), F.col("sha256").alias("want_hash")).join(found.select(*key, "path", F.col("size_bytes").alias("size"), "sha256"), [*key, "path"], "left")
    ok = F.coalesce((F.col("size") == F.col("want_size")) & (F.col("sha256") == F.col("want_hash")), F.lit(False))
    return both.groupBy(*key).agg(F.bool_and(ok).alias("intact"), F.count_if(~ok).alias("n_bad"))


def cache_state(requests: DataFrame, entries: DataFrame, key: str | Sequence[str] = "cache_key") -> DataFrame:
    """bypass (no key, or asked for), miss, malformed (no manifest), poisoned (files differ) or hit: one row for each request.

    ``key``: the column or columns that name an entry.  Entries of one key are
    one entry, as good as the worst of them.
    """
    key = [key] if isinstance(key, str) else list(key)
    good = lambda c: F.bool_and(F.coalesce(c, F.lit(False))).alias(c)
    joined = requests.join(entries.groupBy(*key).agg(F.lit(True).alias("_there"), good("has_manifest"), good("intact")), key, "left")
    nameless = F.lit(False)
    for c in key:
        nameless = nameless | F.col(c).isNull()
    state = choose((F.col("bypass") | nameless, "bypass"), (F.col("_there").isNull(), "miss"), (~F.col("has_manifest"), "malformed"), (~F.col("intact"), "poisoned"), otherwise="hit")
    return joined.withColumn("state", state).drop("_there", "has_manifest", "intact")


def provenance(value: Column) -> Column:
    """A provenance field that could not be found says so; it never stops a run."""
    return F.coalesce(non_empty(value), F.lit("unresolved"))


def plan_writes(wanted: DataFrame, existing: DataFrame, key: str = "name", digest: str = "content_hash", force: bool = False) -> DataFrame:
    """What writing named content would do: write, unchanged, replace (with ``force``) or refuse, and the next free version's name."""
    from quillon.functions.scalars import next_version_name

    joined = wanted.join(existing.select(key, F.col(digest).alias("_have")), key, "left")
    action = choose((F.col("_have").isNull(), "write"), (F.col("_have") == F.col(digest), "unchanged"), otherwise="replace" if force else "refuse")
    return joined.withColumn("action", action).withColumn("suggested", F.when(F.col("action") == "refuse", next_version_name(F.col(key)))).drop("_have")
