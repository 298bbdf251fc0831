"""Parameter grids: validation, expansion, routing of overrides."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.functions.scalars import valid_label
from quillon.functions.semantics import choose

RESERVED = ("zip", "conditional", "bayesian")


def expand(axes: DataFrame, sweep: str) -> DataFrame:
    """Every combination of one value of each axis: point, axis_values and merged overrides.

    ``axes``: axis, axis_pos, label, value_pos, overrides (map).  Points count
    in row-major order of positions; later axes win on equal override keys.
    Without axes there is one point named as the sweep.
    """
    names = [(r["axis"], r["axis_pos"]) for r in axes.select("axis", "axis_pos").distinct().orderBy("axis_pos").collect()]  # a sweep's axes: configuration
    spark = axes.sparkSession
    if not names:
        return spark.sql(f"SELECT 0L AS point, '{sweep}' AS name, map() AS axis_values, map() AS overrides").select("point", "name", F.col("axis_values").cast("map<string,string>").alias("axis_values"), F.col("overrides").cast("map<string,string>").alias("overrides"))
    sides = []
    for k, (axis, pos) in enumerate(names):
        side = axes.filter((F.col("axis") == axis) & (F.col("axis_pos") == pos))
        sides.append(side.select(F.col("label").alias(f"l{k}"), F.col("value_pos").alias(f"p{k}"), F.col("overrides").alias(f"o{k}")))
    grid = reduce(lambda a, b: a.crossJoin(b), sides)  # the grid is the result: every combination is wanted
    ks = range(len(names))
    labels = F.map_from_arrays(F.array(*[F.lit(n) for n, _ in names]), F.array(*[F.col(f"l{k}") for k in ks]))
    merged = reduce(lambda a, b: F.map_concat(F.map_filter(a, lambda key, _: ~F.map_contains_key(b, key)), b), [F.col(f"o{k}") for k in ks])
    sizes = {k: side.agg(F.count("*")).first()[0] for k, side in enumerate(sides)}
    point: Column = F.lit(0).cast("long")
    for k in ks:
        point = point * sizes[k] + F.col(f"p{k}")
    name = F.concat_ws("__", F.lit(sweep), F.concat_ws("_", *[F.col(f"l{k}") for k in ks]))
    return grid.select(point.alias("point"), name.alias("name"), labels.alias("axis_values"), merged.alias("overrides"))


def zipped(axes: DataFrame, sweep: str) -> DataFrame:
    """Values of equal position taken together (an extension; axes must be of one length)."""
    rows = axes.groupBy("value_pos").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("axis", "label")))).alias("axis_values"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("axis_pos", "label"))), lambda x: x["label"]), "_").alias("tail"))
    return rows.select(F.col("value_pos").cast("long").alias("point"), F.concat_ws("__", F.lit(sweep), "tail").alias("name"), "axis_values")


#: Sweep strategies by name.
STRATEGIES: dict[str, Callable[[DataFrame, str], DataFrame]] = {"grid": expand}


def findings(axes: DataFrame, strategy: str = "grid") -> DataFrame:
    """(severity, rule, message) of everything wrong with a sweep; empty when it may be expanded."""
    spark = axes.sparkSession
    say = lambda df, rule, message: df.select(F.lit("error").alias("severity"), F.lit(rule).alias("rule"), message.alias("message"))
    values = axes.filter("label IS NOT NULL")
    keys = values.select("axis", F.explode(F.map_keys("overrides")).alias("key")).distinct()
    other = keys.select(F.col("axis").alias("axis_b"), "key")
    checks = [
        say(values.filter(~valid_label(F.col("label"))), "label", F.concat_ws("", F.lit("bad label "), "axis", F.lit("="), "label")),
        say(values.groupBy("axis", "label").count().filter("count > 1"), "repeated_label", F.concat_ws("", F.lit("repeated label "), "axis", F.lit("="), "label")),
        say(axes.groupBy("axis").agg(F.count("label").alias("n")).filter("n = 0"), "empty_axis", F.concat(F.lit("no values: "), "axis")),
        say(axes.groupBy("axis").agg(F.count_distinct("axis_pos").alias("n")).filter("n > 1"), "repeated_axis", F.concat(F.lit("repeated axis: "), "axis")),
        say(axes.select("axis").distinct().filter("axis IS NULL OR trim(axis) = ''"), "axis_name", F.lit("axis without a name")),
        say(keys.join(other, "key").filter("axis < axis_b"), "shared_key", F.concat_ws("", F.lit("key "), "key", F.lit(" set by "), "axis", F.lit(" and "), "axis_b")),
        say(values.filter("overrides IS NULL"), "overrides", F.concat_ws("", F.lit("no overrides: "), "axis", F.lit("="), "label")),
        say(axes.agg(F.count("*").alias("n")).filter("n = 0"), "no_axes", F.lit("a sweep needs an axis")),
    ]
    if strategy not in STRATEGIES:
        why = "reserved" if strategy in RESERVED else "unknown"
        checks.append(spark.createDataFrame([("error", "strategy", f"{why} strategy: {strategy}")], "severity string, rule string, message string"))
    return reduce(DataFrame.unionByName, checks)


def route(overrides: DataFrame, key: str = "key") -> DataFrame:
    """Adds ``target`` and ``path``: where an override goes by its first part."""
    head = F.get(F.split(key, "\\."), F.lit(0))
    target = choose((head.isin("extractor", "extraction"), "extraction"), (head.isin("train", "model", "data", "training"), "training"), (head.isin("backtest", "backtesting"), "backtesting"), (head.isin("export", "signal_export"), "signal_export"), (head == "experiment", "experiment"), otherwise="training")
    stripped = F.regexp_replace(key, "^(extractor|extraction|training|backtest|backtesting|export|signal_export)\\.", "")
    return overrides.withColumn("target", target).withColumn("path", F.when(target.isin("training", "experiment") & ~F.col(key).startswith("training."), F.col(key)).otherwise(stripped))


def apply_overrides(existing: DataFrame, wanted: DataFrame, known: DataFrame, path: str = "path", value: str = "value") -> DataFrame:
    """(path, old, new, status): applied, added, same, conflict (a value stands above or below the path) or unknown."""
    old = existing.select(path, F.col(value).alias("old"), F.lit(True).alias("_there"))
    allowed = known.select(path, F.lit(True).alias("_known"))
    joined = wanted.select(path, F.col(value).alias("new")).join(old, path, "left").join(allowed, path, "left")
    # prefixes of a path are its parents: an equi-join finds scalars that stand where an object is needed
    parents = wanted.select(F.col(path).alias("child"), F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.size(F.split(path, "\\.")) - 1, F.lit(1))), lambda n: F.array_join(F.slice(F.split(path, "\\."), F.lit(1), n), "."))).alias("parent")).filter("child <> parent")
    clash = parents.join(existing.select(F.col(path).alias("parent")), "parent", "left_semi").select(F.col("child").alias(path), F.lit(True).alias("_clash")).distinct()
    status = choose((F.col("_clash"), "conflict"), (F.col("_there") & F.col("old").eqNullSafe(F.col("new")), "same"), (F.col("_there"), "applied"), (F.col("_known"), "added"), otherwise="unknown")
    return joined.join(clash, path, "left").withColumn("status", status).select(path, "old", "new", "status")


def set_path(document: dict, path: str, value: object, strict: bool = False) -> dict:
    """Driver side: assign at a dotted path, making objects on the way; ``strict`` refuses to replace a scalar by an object."""
    here = document
    *parents, last = path.split(".")
    for part in parents:
        if not isinstance(here.get(part), dict):
            if strict and part in here:
                raise ValueError(f"{part!r} in {path!r} is no object")
            here[part] = {}
        here = here[part]
    here[last] = value
    return document


def get_path(document: Mapping, path: str) -> object:
    """Driver side: the value at a dotted path, None when any part is missing."""
    for part in path.split("."):
        if not isinstance(document, Mapping) or part not in document:
            return None
        document = document[part]
    return document


def inherit(documents: Mapping[str, Mapping], name: str, base: str = "_base", limit: int = 10) -> dict:
    """Driver side: a document merged over its bases, nearest last; a cycle or too long a chain is an error."""
    chain: list[str] = []
    while name is not None:
        if name in chain or len(chain) >= limit:
            raise ValueError(f"inheritance does not end: {' > '.join([*chain, name])}")
        chain.append(name)
        name = documents[name].get(base)

    def merge(a: dict, b: Mapping) -> dict:
        out = dict(a)
        for k, v in b.items():
            if k != base:
                out[k] = merge(out[k], v) if isinstance(v, Mapping) and isinstance(out.get(k), Mapping) else v
        return out

    return reduce(lambda a, n: merge(a, documents[n]), reversed(chain), {})
