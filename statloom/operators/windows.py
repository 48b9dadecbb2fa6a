"""Growth, rolling figures and picks along a series.

A series holds one row per period, so its window partition is bounded by the calendar,
not by the facts behind it. All windows are keyed by series; wide frames are rolled in
long form and put back together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.cols import named
from ..functions.numbers import ratio
from .numbering import CHUNK_ROWS, numbered


def _along(keys: Sequence[str], time: str):
    return Window.partitionBy(*[named(k) for k in keys]).orderBy(named(time))


def growth(value: str, keys: Sequence[str], time: str, n: int) -> Column:
    return ratio(named(value), F.lag(named(value), n).over(_along(keys, time))) - F.lit(1.0)


def yoy(
    df: DataFrame, keys: Sequence[str], time: str, value: str, n: int, name: str = "GrowthRate",
    calendar: str | None = None,
) -> DataFrame:
    """Growth over the value n rows back; a gap in the series shifts it.

    `calendar="month"` looks up the period exactly n months back instead: a frame of one period in
    the window of the series, so it takes one shuffle, missing keys are a series of their own, and a
    period that is not there gives NULL. A series has one row for each period.
    """
    if calendar is None:
        return df.withColumn(name, growth(value, keys, time, n))
    months = {"month": 1, "quarter": 3, "year": 12}[calendar] * n
    number = F.year(named(time)) * 12 + F.month(named(time))
    at = Window.partitionBy(*[named(k) for k in keys]).orderBy(number).rangeBetween(-months, -months)
    return df.withColumn(name, ratio(named(value), F.first(named(value)).over(at)) - F.lit(1.0))


def yoy_many(
    df: DataFrame, keys: Sequence[str], time: str, values: Sequence[str], n: int,
    name: str = "{col}Growth",
) -> DataFrame:
    """Growth of several measures over one shared window."""
    return df.withColumns({name.format(col=v): growth(v, keys, time, n) for v in values})


def _rolling(keys: Sequence[str], time: str, value: str, k: int, how: str) -> Column:
    frame = _along(keys, time).rowsBetween(-(k - 1), 0)
    fn = {"sum": F.sum, "mean": F.avg}[how]
    return F.when(F.count(named(value)).over(frame) == k, fn(named(value)).over(frame))


def roll_sum(
    df: DataFrame, keys: Sequence[str], time: str, value: str, k: int, name: str
) -> DataFrame:
    """Right-aligned sum of k rows; NULL until k rows are there or if one is missing."""
    return df.withColumn(name, _rolling(keys, time, value, k, "sum"))


def roll_mean(
    df: DataFrame, keys: Sequence[str], time: str, value: str, k: int, name: str
) -> DataFrame:
    """Right-aligned mean of k rows, with the same rule for missing values."""
    return df.withColumn(name, _rolling(keys, time, value, k, "mean"))


def roll_wide(
    df: DataFrame, time: str, cols: Sequence[str], k: int, how: str, suffix: str
) -> DataFrame:
    """Roll every listed column of a wide frame, adding `<col><suffix>`."""
    cells = F.array(*[
        F.struct(F.lit(c).alias("__s"), named(c).cast("double").alias("__v")) for c in cols])
    long = df.select(named(time), F.inline(cells))
    rolled = long.withColumn("__r", _rolling(["__s"], time, "__v", k, how))
    pick = lambda c, v: F.max(F.when(F.col("__s") == c, F.col(v)))
    return rolled.groupBy(named(time)).agg(
        *[pick(c, "__v").alias(c) for c in cols],
        *[pick(c, "__r").alias(c + suffix) for c in cols])


def make_unique(df: DataFrame, col: str, order: str, rows: int = CHUNK_ROWS) -> DataFrame:
    """Give the second, third, ... row of a name the suffix -1, -2, ... in `order`."""
    n = numbered(df, [col], order, "__k", rows=rows)
    suffixed = F.concat(named(col), F.lit("-"), (F.col("__k") - 1).cast("string"))
    return n.withColumn(col, F.when(F.col("__k") > 1, suffixed).otherwise(named(col))).drop("__k")


def pick_spread(
    df: DataFrame, group: Sequence[str], order: str, rows: int = CHUNK_ROWS
) -> DataFrame:
    """First, middle and last row of each group by `order`, each once."""
    n = numbered(df, group, order, "__k", size="__n", rows=rows)
    middle = F.ceil(F.col("__n") / 2)
    hit = (F.col("__k") == 1) | (F.col("__k") == middle) | (F.col("__k") == F.col("__n"))
    return n.where(hit).withColumnsRenamed({"__k": "position"}).drop("__n")
