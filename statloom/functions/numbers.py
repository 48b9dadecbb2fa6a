"""Ratios, rounding and sums whose result does not depend on row order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .cols import ColumnLike, as_col


def ratio(a: ColumnLike, b: ColumnLike) -> Column:
    """a / b, NULL on a zero or missing divisor."""
    return F.try_divide(as_col(a), as_col(b))


def scaled(c: ColumnLike, k: float) -> Column:
    return as_col(c) * F.lit(k)


def round_even(c: ColumnLike, digits: int = 0) -> Column:
    """Round half to even."""
    return F.bround(as_col(c), digits)


def coalesce_to(c: ColumnLike, default: ColumnLike | float | int) -> Column:
    fallback = default if isinstance(default, Column) else F.lit(default)
    return F.coalesce(as_col(c), fallback)


def units(c: ColumnLike, digits: int) -> Column:
    """An amount as a whole number of its smallest unit; raises if it has more decimals than `digits`."""
    exact = as_col(c) * F.lit(10**digits)
    whole = F.round(exact, 0)
    off = F.abs(exact - whole) > F.lit(1e-4) + F.abs(exact) * F.lit(1e-12)
    message = F.concat(F.lit("amount with more decimals than "), F.lit(digits), F.lit(": "), as_col(c).cast("string"))
    return F.when(off, F.raise_error(message)).otherwise(whole).cast("bigint")


def total(c: ColumnLike, digits: int | None = None) -> Column:
    """Sum of an amount.

    With `digits`, each amount is taken as a whole number of its smallest unit and
    summed as a 64-bit integer: partial sums then combine exactly, so a later rounding
    gives the same result under any partitioning. Without, the sum keeps the input type.
    An amount with more decimals raises, so none is rounded before the sum. An overflow
    raises under ANSI mode instead of wrapping.
    """
    if digits is None:
        return F.sum(as_col(c))
    unit = 10**digits
    return F.sum(units(c, digits)) / F.lit(float(unit))
