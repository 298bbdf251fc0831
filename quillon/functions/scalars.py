"""Scalar functions: versions, names, paths, labels, error kinds, templates.

Column functions return Columns; the few that work on configuration held by
the driver take and return Python values and say so.
"""

from __future__ import annotations

import difflib
import os
import posixpath
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillon.functions.semantics import choose, non_empty

# --- versions ---------------------------------------------------------------


def version_part(v: Column, part: int) -> Column:
    """The number at ``part`` (0: major) of a dotted version, 0 when absent."""
    digits = F.regexp_extract(F.get(F.split(v, "\\."), F.lit(part)), "^[0-9]+", 0)
    return F.coalesce(F.when(digits != "", digits).cast("int"), F.lit(0))


def minor_differs(a: Column, b: Column) -> Column:
    """Whether major or minor differ; a change of patch does not count."""
    return (version_part(a, 0) != version_part(b, 0)) | (version_part(a, 1) != version_part(b, 1))


def version_key(v: Column) -> Column:
    """An array that orders versions: numbers, then a pre-release before its release."""
    release = F.when(F.regexp_extract(v, "^[0-9.]+", 0) == v, 1).otherwise(0)
    return F.array(*[version_part(v, k) for k in range(3)], release)


# --- names ------------------------------------------------------------------


def fold_name(c: Column) -> Column:
    """SmoothedReturn, smoothed-return and smoothed_return fold to one name."""
    return F.lower(F.regexp_replace(F.trim(c), "[_-]", ""))


def fold_strategy(c: Column) -> Column:
    return F.lower(F.replace(c, F.lit("-"), F.lit("_")))


def treatment_label(axes: Column, name: Column) -> Column:
    """``k=v__k=v`` over the sorted axis map, or the name when the map is empty or null."""
    pairs = F.array_sort(F.transform(F.map_entries(axes), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return F.when(F.size(axes) > 0, F.array_join(pairs, "__")).otherwise(name)


def grid_name(sweep: Column, labels: Sequence[Column]) -> Column:
    return F.concat_ws("__", sweep, F.concat_ws("_", *labels))


def valid_label(c: Column) -> Column:
    return F.coalesce(c.rlike("^[a-zA-Z0-9_-]+$"), F.lit(False))


def next_version_name(name: Column) -> Column:
    """``x`` -> ``x_v2``, ``x_v3`` -> ``x_v4``."""
    stem, number = F.regexp_extract(name, "^(.+)_v([0-9]+)$", 1), F.regexp_extract(name, "^(.+)_v([0-9]+)$", 2)
    return F.when(number == "", F.concat(name, F.lit("_v2"))).otherwise(F.concat(stem, F.lit("_v"), (F.nullif(number, F.lit("")).cast("int") + 1).cast("string")))


def short_hash(*hashes: Column, n: int = 12) -> Column:
    """The first ``n`` characters of the first hash that is neither null nor empty."""
    return F.substring(F.coalesce(*[non_empty(h) for h in hashes]), 1, n)


def is_sha256(c: Column) -> Column:
    return F.coalesce(c.rlike("^[a-f0-9]{64}$"), F.lit(False))


def require_sha256(value: str, what: str = "hash") -> str:
    """Driver side: the hash itself, or ValueError; nothing is corrected silently."""
    if not re.fullmatch("[a-f0-9]{64}", value):
        raise ValueError(f"{what} must be 64 lower-case hex digits: {value!r}")
    return value


def close_match(name: str, known: Sequence[str], cutoff: float = 0.7) -> str | None:
    """Driver side: the known name most like ``name``, for a typo's message."""
    return next(iter(difflib.get_close_matches(name, known, 1, cutoff)), None)


# --- text -------------------------------------------------------------------


def tail_lines(c: Column, n: int) -> Column:
    lines = F.split(c, "\n")
    return F.array_join(F.slice(lines, F.greatest(F.size(lines) - n + 1, F.lit(1)), F.lit(n)), "\n")


def last_match(c: Column, pattern: str, group: int = 1) -> Column:
    """The group of the last match in a text, null without one."""
    return F.try_element_at(F.regexp_extract_all(c, F.lit(pattern), F.lit(group)), F.lit(-1))


#: Kinds of failure, tested in this order by words in the message and the error output.
ERROR_WORDS = (
    ("oom", ("cuda out of memory", "oom", "killed")),
    ("gpu_acquire_timeout", ("timeout", "gpu")),
    ("assertion", ("assertion", "assert")),
    ("contract_error", ("contract", "version", "schema")),
    ("validation_error", ("validation", "invalid")),
    ("subprocess_nonzero", ("subprocess",)),
    ("io_error", ("io", "file not found")),
)
#: Failures worth another attempt, and those that are not.
TRANSIENT = ("oom", "gpu_acquire_timeout", "broken_process_pool", "subprocess_nonzero", "io_error")
FATAL = ("validation_error", "assertion", "contract_error", "config_invalid", "unknown")


def error_kind(message: Column, stderr: Column, by_substring: bool = False) -> Column:
    """The kind of failure that a message and its error output tell of.

    Words are matched at word borders ('io' is not found in 'function'); with
    ``by_substring`` anywhere, as older records were classified.
    """
    message, text = F.coalesce(message, F.lit("")), F.lower(F.concat_ws("\n", message, stderr))

    def has(word: str, where: Column = text) -> Column:
        return where.contains(word) if by_substring else where.rlike(rf"\b{re.escape(word)}\b")

    words = dict(ERROR_WORDS)
    any_of = lambda kind: _any(has(w) for w in words[kind])
    return choose(
        (any_of("oom"), "oom"),
        (has("timeout") & has("gpu"), "gpu_acquire_timeout"),
        (any_of("assertion"), "assertion"),
        (has("contract") & (has("version") | has("schema")), "contract_error"),
        (any_of("validation_error"), "validation_error"),
        (has("subprocess", F.lower(message)), "subprocess_nonzero"),
        (any_of("io_error"), "io_error"),
        otherwise="unknown",
    )


def _any(conditions) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out


# --- paths and slots --------------------------------------------------------

#: Configuration slots that hold paths, by the folder they are relative to.
TRAINER_SLOTS = tuple(f"stages.training.{form}.data.{leaf}" for form in ("overrides", "trainer_config") for leaf in ("data_dir", "feature_sets_dir"))
ROOT_SLOTS = (
    "stages.extraction.output_dir", "stages.extraction.config", "stages.raw_analysis.output_dir", "stages.raw_analysis.data_dir", "stages.dataset_analysis.output_dir",
    "stages.dataset_analysis.data_dir", "stages.validation.output_dir", "stages.training.output_dir", "stages.training.script", "stages.post_training_gate.output_dir",
    "stages.signal_export.output_dir", "stages.signal_export.checkpoint", "stages.signal_export.script", "stages.signal_export.config", "stages.backtesting.data_dir",
    "stages.backtesting.signals_dir", "stages.backtesting.model_checkpoint", "stages.backtesting.script", "stages.backtesting.params_file",
)


def slot_base(slot: Column) -> Column:
    """What a configuration slot's path is relative to: trainer_cwd, pipeline_root or none."""
    return choose((slot.isin(*TRAINER_SLOTS), "trainer_cwd"), (slot.isin(*ROOT_SLOTS), "pipeline_root"), otherwise="none")


def rebase(path: str, root: str, cwd: str) -> str:
    """Driver side: a path relative to ``root`` rewritten relative to ``cwd``; absolute paths stay."""
    return path if os.path.isabs(path) else posixpath.relpath(posixpath.join(root, path), cwd)


def under_root(root: str, path: str) -> str:
    """Driver side: the normalised path, or ValueError when it would leave ``root``."""
    full = posixpath.normpath(posixpath.join(root, path))
    if full != posixpath.normpath(root) and not full.startswith(posixpath.normpath(root) + "/"):
        raise ValueError(f"{path!r} leaves {root!r}")
    return full


# --- numbers ----------------------------------------------------------------


def feature_count(levels: Column, derived: Column, order_flow: Column, signals: Column) -> Column:
    """Four columns a level, and 8, 36 and 14 for the groups that are on."""
    part = lambda flag, n: F.when(flag, n).otherwise(0)
    return 4 * levels + part(derived, 8) + part(order_flow, 36) + part(signals, 14)


def block_length(n: Column, least_blocks: int = 5) -> Column:
    """The cube root of n rounded up, lowered until there are at least ``least_blocks`` blocks."""
    cube = F.ceil(F.pow(n.cast("double"), F.lit(1.0 / 3.0)) - 1e-9).cast("long")
    return F.when(F.floor(n / F.greatest(cube, F.lit(1))) < least_blocks, F.greatest(F.lit(1), F.floor(n / least_blocks))).otherwise(cube).cast("long")


def as_fraction(usd: Column, capital: float) -> Column:
    """Money as a share of capital; the capital must be finite and positive."""
    if not 0 < capital < float("inf"):
        raise ValueError(f"capital must be finite and positive: {capital!r}")
    return usd / F.lit(capital)


def overdue(field: Column, written: Column, cutoff: str) -> Column:
    """A record written on or after ``cutoff`` that lacks ``field``."""
    return field.isNull() & (written >= F.lit(cutoff))


def types_match(scored: Column, fitted: Column) -> Column:
    """True or false when both names are known, else null."""
    return F.when(non_empty(scored).isNull() | non_empty(fitted).isNull(), F.lit(None).cast("boolean")).otherwise(fold_name(scored) == fold_name(fitted))


def position_of(values: Column, value: Column) -> Column:
    """0-based place of a value in an array, null when it is not there."""
    return F.nullif(F.array_position(values, value), F.lit(0)) - 1


# --- driver-side configuration ----------------------------------------------

_REFERENCE = re.compile(r"\$\{([^}]+)\}")


def resolve(document: object, extra: Mapping[str, object] | None = None, builtin: Mapping[str, object] | None = None, deferred: Sequence[str] = (), passes: int = 5) -> object:
    """Driver side: replace ``${a.b}`` by builtin values, then extra ones, then the document's own, until nothing changes.

    References whose first part is in ``deferred``, and unknown ones, are left.  A string that is one reference takes
    the value's own type.
    """
    extra, builtin = extra or {}, builtin or {}

    def look(path: str, root: object):
        for source in (builtin, extra):
            if path in source:
                return source[path]
        for part in path.split("."):
            if not isinstance(root, Mapping) or part not in root:
                return None
            root = root[part]
        return root

    def once(x: object, root: object) -> object:
        if isinstance(x, Mapping):
            return {k: once(v, root) for k, v in x.items()}
        if isinstance(x, list):
            return [once(v, root) for v in x]
        if not isinstance(x, str):
            return x
        value = lambda m: None if m[1].split(".")[0] in deferred else look(m[1], root)
        if (m := _REFERENCE.fullmatch(x)) and not isinstance(value(m), (type(None), Mapping, list)):
            return value(m)
        return _REFERENCE.sub(lambda m: m[0] if isinstance(v := value(m), (type(None), Mapping, list)) else str(v), x)

    for _ in range(passes):
        new = once(document, document)
        if new == document:
            break
        document = new
    return document


def unresolved(document: object, at: str = "") -> list[tuple[str, str]]:
    """Driver side: (path, reference) of every ``${...}`` that is left."""
    if isinstance(document, Mapping):
        return [x for k, v in document.items() for x in unresolved(v, f"{at}.{k}" if at else str(k))]
    if isinstance(document, list):
        return [x for i, v in enumerate(document) for x in unresolved(v, f"{at}[{i}]")]
    return [(at, name) for name in _REFERENCE.findall(document)] if isinstance(document, str) else []


def references(text: Column) -> Column:
    """The names of all ``${...}`` in a string column."""
    return F.regexp_extract_all(text, F.lit(r"\$\{([^}]+)\}"), F.lit(1))


def json_text(c: Column) -> Column:
    """A string as JSON text, quoted and escaped; null as null."""
    quoted = F.to_json(F.array(c))
    return F.when(c.isNull(), "null").otherwise(F.substring(quoted, F.lit(2), F.length(quoted) - 2))


def failure_policy(text: str) -> tuple[str, int]:
    """Driver side: ``continue``, ``abort`` or ``retry:N`` as (policy, retries); blanks around and case do not matter."""
    text = text.strip().lower()
    if text in ("continue", "abort"):
        return text, 0
    if m := re.fullmatch(r"retry:([1-9][0-9]*)", text):
        return "retry", int(m[1])
    raise ValueError(f"not a failure policy: {text!r}")


def truthy(text: str | None) -> bool:
    """Driver side: whether a setting's text means yes."""
    return (text or "").strip().lower() in ("1", "true", "yes", "on")


def finite_tree(value: object) -> object:
    """Driver side: NaN and infinities of a document as null."""
    if isinstance(value, float):
        return value if value - value == 0 else None
    if isinstance(value, Mapping):
        return {k: finite_tree(v) for k, v in value.items()}
    return [finite_tree(v) for v in value] if isinstance(value, list) else value
