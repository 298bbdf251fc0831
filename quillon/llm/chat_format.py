"""Chat formatting: link tool calls with their results.

Calls and results meet by hash join on (conversation, identifier).  Calls are
ordered topologically by level, the longest chain of calls that each one waits
for; ties keep the order of turns.  Arguments are validated against JSON
schemas, and each linked exchange is serialised as canonical JSON: keys sorted
by code point, no blanks, UTF-8 kept.  Nothing gathers a whole conversation in
one row or task, so a conversation of any length is only many rows; a chain of
n calls is settled in about log2(n) rounds.
"""

from __future__ import annotations

import json
import re
from collections.abc import Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillon.llm import frames

CALLS = "conv_id long, turn long, seq int, call_id string, name string, arguments string, after array<string>"
RESULTS = "conv_id long, turn long, seq int, call_id string, content string"
#: Calls and links of a conversation that one task orders at most.
GROUP_ROWS = 50_000
#: JSON nested deeper than this is taken as text.
MAX_DEPTH = 100
_CALL = re.compile(r"<tool_call>(.*?)</tool_call>", re.DOTALL)
_RESULT = re.compile(r"<tool_result>(.*?)</tool_result>", re.DOTALL)
_SURROGATE = re.compile("[\ud800-\udfff]")
_KINDS = {"string": str, "object": dict, "array": list, "boolean": bool, "null": type(None)}
#: The schema keywords that are checked, and those that tell about a schema only.
KEYWORDS = frozenset(("type", "enum", "minimum", "maximum", "minLength", "maxLength", "required", "properties", "additionalProperties", "items"))
NOTES = frozenset(("title", "description", "default", "examples", "$schema", "$id", "$comment"))

# --- JSON -------------------------------------------------------------------


def load(text: str) -> object:
    """The value of a JSON text.  ValueError for other text, and for what is nested deeper than MAX_DEPTH."""
    try:
        value = json.loads(text)
    except RecursionError:
        raise ValueError("too deep") from None
    level, depth = [value], 0
    while level:
        depth += 1
        if depth > MAX_DEPTH + 1:
            raise ValueError("too deep")
        level = [x for v in level if isinstance(v, (dict, list)) for x in (v.values() if isinstance(v, dict) else v)]
    return value


def utf8(text: str | None) -> str | None:
    """The text with lone surrogates, which UTF-8 cannot hold, written as \\udXXX."""
    return text if text is None else _SURROGATE.sub(lambda m: f"\\u{ord(m.group()):04x}", text)


def canonical(value: object) -> str:
    """Canonical JSON: sorted keys, no blanks, no escapes but the necessary; not-a-number and infinities become null.

    Whole floats below 2**53 are written as integers.
    """

    def clean(x):
        if isinstance(x, float):
            if x != x or x in (float("inf"), float("-inf")):
                return None
            return int(x) if x.is_integer() and abs(x) < 2**53 else x
        if isinstance(x, dict):
            return {str(k): clean(v) for k, v in x.items()}
        return [clean(v) for v in x] if isinstance(x, list) else x

    return utf8(json.dumps(clean(value), sort_keys=True, separators=(",", ":"), ensure_ascii=False))


def _is(value: object, kind: str) -> bool:
    number = isinstance(value, (int, float)) and not isinstance(value, bool)
    if kind == "number":
        return number
    if kind == "integer":
        return number and (isinstance(value, int) or value.is_integer())
    return isinstance(value, _KINDS[kind])


def _same(a: object, b: object) -> bool:
    """JSON equality: true is not 1, 1 is 1.0."""
    return canonical(a) == canonical(b)


def check_schema(schema: Mapping, at: str = "$") -> None:
    """ValueError for keywords or types that :func:`violations` does not know."""
    if unknown := sorted(set(schema) - KEYWORDS - NOTES):
        raise ValueError(f"{at}: schema keywords not supported: {', '.join(unknown)}")
    for kind in _kinds(schema):
        if kind not in _KINDS and kind not in ("number", "integer"):
            raise ValueError(f"{at}: not a type: {kind}")
    for k, s in schema.get("properties", {}).items():
        check_schema(s, f"{at}.{k}")
    for k in ("items", "additionalProperties"):
        if isinstance(schema.get(k), Mapping):
            check_schema(schema[k], f"{at}.{k}")


def _kinds(schema: Mapping) -> tuple[str, ...]:
    kind = schema.get("type", ())
    return (kind,) if isinstance(kind, str) else tuple(kind)


def violations(value: object, schema: Mapping, at: str = "$") -> list[str]:
    """Where ``value`` breaks a JSON schema (its KEYWORDS; the type may be a list of types)."""
    kinds = _kinds(schema)
    if kinds and not any(_is(value, k) for k in kinds):
        return [f"{at}: not {' or '.join(kinds)}"]
    out = []
    if "enum" in schema and not any(_same(value, x) for x in schema["enum"]):
        out.append(f"{at}: not in enum")
    if _is(value, "number"):
        if value < schema.get("minimum", value):
            out.append(f"{at}: below minimum")
        if value > schema.get("maximum", value):
            out.append(f"{at}: above maximum")
    if isinstance(value, str) and not schema.get("minLength", 0) <= len(value) <= schema.get("maxLength", len(value)):
        out.append(f"{at}: length")
    if isinstance(value, dict):
        known, more = schema.get("properties", {}), schema.get("additionalProperties", True)
        out += [f"{at}.{k}: missing" for k in schema.get("required", ()) if k not in value]
        for k in sorted(value):
            if k in known:
                out += violations(value[k], known[k], f"{at}.{k}")
            elif more is False:
                out.append(f"{at}.{k}: unknown")
            elif isinstance(more, Mapping):
                out += violations(value[k], more, f"{at}.{k}")
    if isinstance(value, list) and "items" in schema:
        out += [e for i, v in enumerate(value) for e in violations(v, schema["items"], f"{at}[{i}]")]
    return out


# --- marked-up texts --------------------------------------------------------


def parse(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results marked up in the texts of (conv_id, turn, role, text).

    ``<tool_call>{"id", "name", "arguments", "after"}</tool_call>`` counts in
    messages of any role but tool; ``<tool_result>{"id", "content"}</tool_result>``
    in messages of role tool.  Marked text that is no JSON object, is nested
    deeper than MAX_DEPTH, or has no id, is left out.
    """

    def found(batch: pa.RecordBatch, pattern: re.Pattern, tool: bool):
        for row in frames.rows(batch):
            if (row["role"] == "tool") == tool:
                for seq, text in enumerate(pattern.findall(row["text"] or "")):
                    try:
                        item = load(text)
                    except ValueError:
                        continue
                    if isinstance(item, dict) and item.get("id") is not None:
                        yield row["conv_id"], row["turn"], seq, _text(item["id"]), item

    def calls(batches):
        for batch in frames.pieces(batches):
            rows = []
            for *place, x in found(batch, _CALL, False):
                after = x.get("after")
                rows.append((*place, _text(x.get("name")), canonical(x.get("arguments", {})), [_text(a) for a in after if a is not None] if isinstance(after, list) else []))
            yield _batch(rows, CALLS)

    def results(batches):
        for batch in frames.pieces(batches):
            yield _batch([(*place, canonical(x.get("content"))) for *place, x in found(batch, _RESULT, True)], RESULTS)

    source = messages.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    return source.mapInArrow(calls, CALLS), source.mapInArrow(results, RESULTS)


def _text(value: object) -> str | None:
    return utf8(value) if isinstance(value, str) or value is None else canonical(value)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    arrow = _ARROW[schema]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(arrow)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)


_ARROW = {
    CALLS: pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("seq", pa.int32()), ("call_id", pa.string()), ("name", pa.string()), ("arguments", pa.string()), ("after", pa.list_(pa.string()))]),
    RESULTS: pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("seq", pa.int32()), ("call_id", pa.string()), ("content", pa.string())]),
}

# --- order ------------------------------------------------------------------


def _first(df: DataFrame, name: str) -> DataFrame:
    """A written table with ``first``: true in the one row of each identifier that counts, the least by (turn, seq).

    Of rows at one place the least by their other columns counts, of equal
    rows any one.  The least is found by a pre-aggregated minimum, so an
    identifier with many rows is no large group.
    """
    place = F.struct("turn", "seq", *[c for c in df.columns if c not in ("conv_id", "call_id", "turn", "seq")])
    rows = frames.written(df.withColumn("_row", F.monotonically_increasing_id()), name)
    least = frames.written(rows.groupBy("conv_id", "call_id").agg(F.min(F.struct(place, "_row"))["_row"].alias("_least")), name)
    return rows.join(least, ["conv_id", "call_id"]).withColumn("first", F.col("_row") == F.col("_least")).drop("_row", "_least")


def levels(calls: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(conv_id, call_id, level) of distinct calls: 0 without known predecessors, else one more than the highest predecessor's.

    Calls on a cycle, or behind one, get no row.  Unknown identifiers in
    ``after`` are ignored.  A conversation of at most ``group_rows`` calls and
    links is ordered by one task, a larger one by joins (:func:`_rounds`); the
    result is the same.
    """
    key = ["conv_id", "call_id"]
    nodes = calls.select(*key).distinct()
    edges = calls.select(*key, F.explode("after").alias("needs")).distinct()
    edges = edges.join(nodes.withColumnRenamed("call_id", "needs"), ["conv_id", "needs"], "left_semi").select(*key, "needs")
    rows = frames.written(nodes.withColumn("needs", F.lit(None).cast("string")).unionByName(edges), "call-links")
    large = rows.groupBy("conv_id").agg(F.count("*").alias("n")).filter(F.col("n") > group_rows).select("conv_id")
    large = frames.written(large, "large-conversations")
    some = large.limit(1).count()
    alone = rows.join(large, "conv_id", "left_anti") if some else rows
    out = alone.repartition("conv_id").sortWithinPartitions("conv_id").mapInArrow(_sorted_out, "conv_id long, call_id string, level long")
    return out.unionByName(_rounds(rows.join(large, "conv_id", "left_semi"))) if some else out


def _sorted_out(batches):
    """Levels for sorted rows (conv_id, call_id, needs; needs null for the call itself), one conversation in memory at a time."""

    def close():
        waits, open_, level = {}, {}, {}
        for call, needs in held:
            if needs is None:
                open_.setdefault(call, 0)
            else:
                waits.setdefault(needs, []).append(call)
                open_[call] = open_.get(call, 0) + 1
        now = [call for call, n in open_.items() if not n]
        depth = 0
        while now:
            level.update(dict.fromkeys(now, depth))
            depth += 1
            after = []
            for done in now:
                for call in waits.get(done, ()):
                    open_[call] -= 1
                    if not open_[call]:
                        after.append(call)
            now = after
        if level:
            yield pa.RecordBatch.from_arrays([pa.array([at] * len(level), pa.int64()), pa.array(list(level), pa.string()), pa.array(list(level.values()), pa.int64())], names=["conv_id", "call_id", "level"])

    held, at, made = [], None, []
    for batch in batches:
        for conv, call, needs in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if conv != at:
                made += close() if held else ()
                held, at = [], conv
                if len(made) >= 500:
                    yield from pa.Table.from_batches(made).combine_chunks().to_batches()
                    made = []
            held.append((call, needs))
    made += close() if held else ()
    if made:
        yield from pa.Table.from_batches(made).combine_chunks().to_batches()


def _rounds(rows: DataFrame) -> DataFrame:
    """Levels of (conv_id, call_id, needs; needs null for the call itself) by joins, whatever the size of a conversation.

    In each round the calls that wait for one other call are chained by pointer
    doubling: each learns the end of its chain, a call that is settled or waits
    for several, and its distance.  Calls that wait for several then wait for
    the ends of those chains, with distances; of two ways to one end the longer
    counts.  A chain of n calls takes log2(n) joins, and each round settles one
    level of what is left at least.
    """
    spark = rows.sparkSession
    key = ["conv_id", "call_id"]
    nodes = rows.filter("needs IS NULL").select(*key)
    edges = frames.written(rows.filter("needs IS NOT NULL").withColumn("far", F.lit(1).cast("long")), "call-edges")
    settled = [frames.written(nodes.join(edges, key, "left_anti").select(*key, F.lit(0).cast("long").alias("level")), "call-levels")]
    frontier = settled[0]  # settled in the last round; edges lead to these and to unsettled calls only
    while edges.count():
        chained = _chains(edges)
        # Every edge to the end of its chain, and to ground (needs null) where that end is settled.
        via = chained.select("conv_id", F.col("call_id").alias("needs"), F.col("needs").alias("end"), F.col("far").alias("more"))
        ends = edges.join(via, ["conv_id", "needs"], "left").select(*key, F.coalesce("end", "needs").alias("needs"), _farther("far", "more"))
        known = frontier.select("conv_id", F.col("call_id").alias("needs"), "level")
        met = ends.join(known, ["conv_id", "needs"], "left")
        met = met.select(*key, F.when(F.col("level").isNull(), F.col("needs")).alias("needs"), _farther("far", "level"))
        met = frames.written(met.groupBy(*key, "needs").agg(F.max("far").alias("far")), "call-edges")
        frames.forget(spark, chained)
        counts = met.groupBy(*key).agg(F.count("needs").alias("open"), F.max("far").alias("level"))
        new = frames.written(counts.filter("open = 0").select(*key, "level"), "call-levels")
        if not new.count():
            break  # all that is left is on a cycle or behind one
        settled.append(new)
        # Ground edges of unsettled calls stay as edges to a call of their own that is settled at level 0.
        left = met.join(new, key, "left_anti")
        ground = F.concat(F.lit("\x00"), "call_id")
        frames.forget(spark, edges)
        edges = frames.written(left.select(*key, F.coalesce("needs", ground).alias("needs"), "far"), "call-edges")
        grounds = left.filter("needs IS NULL").select("conv_id", ground.alias("call_id"), F.lit(0).cast("long").alias("level"))
        frontier = frames.written(new.unionByName(grounds), "call-frontier")
        frames.forget(spark, met)
    out = settled[0]
    for more in settled[1:]:
        out = out.unionByName(more)
    return out


def _farther(far: str, more: str) -> Column:
    """A sum of distances; on a cycle, where it would grow for ever, it stops."""
    return F.least(F.col(far) + F.coalesce(more, F.lit(0)), F.lit(1 << 40)).alias("far")


def _chains(edges: DataFrame) -> DataFrame:
    """Of calls that wait for one call: the end of their chain as ``needs``, and the distance to it.

    Chains that close to a cycle come back as far as they were followed, which
    keeps them unsettled.
    """
    key = ["conv_id", "call_id"]
    ways = edges.groupBy(*key).agg(F.count("*").alias("n"), F.max("needs").alias("needs"), F.max("far").alias("far"))
    chain = frames.written(ways.filter("n = 1").drop("n"), "chains")
    rounds = max(1, chain.count()).bit_length()
    for _ in range(rounds):
        ahead = chain.select("conv_id", F.col("call_id").alias("needs"), F.col("needs").alias("end"), F.col("far").alias("more"))
        moved = chain.join(ahead, ["conv_id", "needs"], "left")
        step = moved.select(*key, F.coalesce("end", "needs").alias("needs"), _farther("far", "more"), F.col("end").isNotNull().alias("went"))
        old, chain = chain, frames.written(step, "chains")
        frames.forget(edges.sparkSession, old)
        went = chain.filter("went").limit(1).count()
        chain = chain.drop("went")
        if not went:
            break
    return chain


# --- linking ----------------------------------------------------------------


def link(calls: DataFrame, results: DataFrame, schemas: Mapping[str, Mapping]) -> DataFrame:
    """Linked exchanges, one row for each call and for each result without a call.

    conv_id, call_id, turn, result_turn, status, level, errors (array) and
    canonical_json.  status: ``linked``; ``unanswered`` (no result);
    ``orphan`` (a result without a call, turn null); ``early`` (the result
    stands before its call); ``repeated`` (a later call or result under an
    identifier already used, also one at the same place).  level is null for
    orphans, repeats and calls on a cycle.  A call of an unknown tool or with
    arguments that are no JSON object (or are nested deeper than MAX_DEPTH) has
    that as its error.  Calls and results without conversation, turn or
    identifier link to nothing: unanswered and orphan.  Null contents are JSON
    null.  Input columns beyond CALLS and RESULTS are not looked at.  A schema
    with keywords beyond KEYWORDS and NOTES raises ValueError.
    """
    for schema in schemas.values():
        check_schema(schema)
    none = F.array().cast("array<string>")
    c = calls.select("conv_id", "turn", "seq", "call_id", "name", "arguments", F.coalesce("after", none).alias("after"))
    r = results.select("conv_id", "turn", "seq", "call_id", "content")
    c, r = c.withColumn("_named", _named()), r.withColumn("_named", _named())
    nameless_calls, nameless_results = c.filter("NOT _named").drop("_named"), r.filter("NOT _named").drop("_named")
    c = frames.written(_first(c.filter("_named").drop("_named"), "calls"), "calls")
    r = frames.written(_first(r.filter("_named").drop("_named"), "results"), "results")
    known = c.filter("first").drop("first")
    answer = r.filter("first").select("conv_id", "call_id", F.col("turn").alias("result_turn"), F.col("seq").alias("result_seq"), "content")
    joined = known.join(answer, ["conv_id", "call_id"], "full_outer")
    early = F.struct("result_turn", "result_seq") < F.struct("turn", "seq")
    status = F.when(F.col("turn").isNull(), "orphan").when(F.col("result_turn").isNull(), "unanswered").when(early, "early").otherwise("linked")
    everything = joined.withColumns({"status": status, "is_call": F.col("turn").isNotNull()}).select(_COLUMNS)
    for rows, kind, of_call in ((c.filter("NOT first"), "repeated", True), (r.filter("NOT first"), "repeated", False), (nameless_calls, "unanswered", True), (nameless_results, "orphan", False)):
        everything = everything.unionByName(_alone(rows, kind, of_call))
    level = levels(known).withColumn("_counts", F.lit(True))
    counts = F.when(F.col("status").isin("linked", "unanswered", "early"), True)
    ordered = everything.withColumn("_counts", counts).join(level, ["conv_id", "call_id", "_counts"], "left")

    def run(batch: pa.RecordBatch) -> dict:
        errors, texts = [], []
        for x in frames.rows(batch):
            bad, arguments = [], None
            if x["is_call"]:
                arguments, bad = _arguments(x["arguments"], x["name"], schemas)
            try:
                content = load(x["content"]) if x["content"] is not None else None
            except ValueError:
                content = x["content"]
            errors.append([utf8(e) for e in bad])
            texts.append(canonical({"arguments": arguments, "id": x["call_id"], "name": x["name"], "result": content, "status": x["status"], "valid": not bad}))
        return {"errors": pa.array(errors, pa.list_(pa.string())), "canonical_json": texts}

    fields = [("errors", T.ArrayType(T.StringType())), ("canonical_json", T.StringType())]
    kept = ["conv_id", "call_id", "turn", "seq", "result_turn", "status", "level", "name", "arguments", "content", "is_call"]
    return frames.map_batches(ordered.withColumn("level", F.col("level").cast("int")), fields, run, keep=kept).drop("name", "arguments", "content", "is_call")


_COLUMNS = ["conv_id", "call_id", "turn", "seq", "result_turn", "name", "arguments", "content", "status", "is_call"]


def _arguments(text: str | None, name: str | None, schemas: Mapping[str, Mapping]) -> tuple[object, list[str]]:
    """The arguments' value and what is wrong with them."""
    try:
        value = load(text) if text else None
    except ValueError:
        value = text
    if not isinstance(value, dict):
        return value, ["$: not object"]
    return value, violations(value, schemas[name]) if name in schemas else ["unknown tool"]


def _alone(rows: DataFrame, status: str, of_call: bool) -> DataFrame:
    """Calls or results that nothing is linked with, in the columns of the others."""
    void = lambda kind, name: F.lit(None).cast(kind).alias(name)
    if of_call:
        own = [F.col("turn"), F.col("seq"), void("long", "result_turn"), F.col("name"), F.col("arguments"), void("string", "content")]
    else:
        own = [void("long", "turn"), F.col("seq"), F.col("turn").alias("result_turn"), void("string", "name"), void("string", "arguments"), F.col("content")]
    return rows.select("conv_id", "call_id", *own, F.lit(status).alias("status"), F.lit(of_call).alias("is_call"))


def _named() -> Column:
    return F.col("conv_id").isNotNull() & F.col("call_id").isNotNull() & F.col("turn").isNotNull()


def in_order(linked: DataFrame) -> DataFrame:
    """Rows of :func:`link` sorted by conversation and topological order; what has no level stands at the end."""
    return linked.orderBy("conv_id", F.asc_nulls_last("level"), F.asc_nulls_last("turn"), "seq", "result_turn", "call_id")
