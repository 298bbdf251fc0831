"""Comparisons and choices whose missing values behave as experiment records need.

Three absences are told apart: a missing key and null are null columns, a
not-a-number is a value that satisfies no comparison.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, Window
from pyspark.sql import functions as F


def is_finite(c: Column) -> Column:
    """True for a number that is neither null, NaN nor infinite; never null."""
    d = c.cast("double")
    return F.coalesce(~F.isnan(d) & (F.abs(d) != F.lit(float("inf"))), F.lit(False))


def finite(c: Column) -> Column:
    """The number itself, or null when it is not finite."""
    return F.when(is_finite(c), c)


def _holds(c: Column, *sides: Column) -> Column:
    for side in sides:
        c = c & ~F.isnan(side.cast("double"))
    return F.coalesce(c, F.lit(False))


def gt(a: Column, b: Column) -> Column:
    """a > b; false when either is null or NaN."""
    return _holds(a > b, a, b)


def ge(a: Column, b: Column) -> Column:
    return _holds(a >= b, a, b)


def lt(a: Column, b: Column) -> Column:
    return _holds(a < b, a, b)


def le(a: Column, b: Column) -> Column:
    return _holds(a <= b, a, b)


def ratio(a: Column, b: Column, floor: float = 0.0) -> Column:
    """a / b, null when |b| is not above ``floor``."""
    return F.when(F.abs(b) > floor, F.try_divide(a, b))


def first_finite(named: Sequence[tuple[str, Column]]) -> tuple[Column, Column]:
    """(name, value) of the first finite column in the given order; nulls if there is none."""
    value = F.coalesce(*[finite(c) for _, c in named])
    name = F.coalesce(*[F.when(is_finite(c), F.lit(n)) for n, c in named])
    return name, value


def first_by(partition: Sequence[str], *order: Column) -> Column:
    """Row number 1 marks the row that comes first; callers end ``order`` with an ordinal so ties are settled."""
    return F.row_number().over(Window.partitionBy(*partition).orderBy(*order))


def non_empty(c: Column) -> Column:
    """The string, or null when it is empty."""
    return F.nullif(c, F.lit(""))


def choose(*cases: tuple[Column, object], otherwise: object = None) -> Column:
    """An ordered CASE."""
    out = None
    for condition, value in cases:
        out = F.when(condition, value) if out is None else out.when(condition, value)
    return out.otherwise(F.lit(otherwise)) if out is not None else F.lit(otherwise)
