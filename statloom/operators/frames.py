"""Projection, filtering, ordering and row binding."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.cols import ColumnLike, as_col, named
from .joins import natural_join
from ..sources.workspace import stage
from .numbering import numbered

# -- projection ---------------------------------------------------------------------


def project(
    df: DataFrame,
    first: Sequence[str] = (),
    drop: Sequence[str] = (),
    everything: bool = True,
    span: tuple[int, int] | None = None,
) -> DataFrame:
    """Reorder to `first` (+ the rest), tolerate absent names in `drop`, or cut by position.

    `span` holds 1-based first and last column positions of the input.
    """
    names = list(df.columns)
    if span is not None:
        names = names[span[0] - 1 : span[1]]
    names = [n for n in names if n not in set(drop)]
    rest = [n for n in names if n not in set(first)] if everything else []
    return df.select(*[named(n) for n in [*first, *rest]])


def rename_by(
    df: DataFrame,
    names: Mapping[str, str] | None = None,
    positions: Mapping[int, str] | None = None,
    fn: Callable[[str], str] | None = None,
) -> DataFrame:
    """Rename by old name, by 1-based position, or by a function over all names."""
    positions = positions or {}
    names = names or {}
    out = []
    for i, old in enumerate(df.columns, start=1):
        new = positions.get(i, names.get(old, old))
        out.append(fn(new) if fn else new)
    return df.toDF(*out)


def mutate(df: DataFrame, **exprs: Column) -> DataFrame:
    """Add columns one after the other, so that later ones may use earlier ones."""
    for name, expr in exprs.items():
        df = df.withColumn(name, expr)
    return df


def across(
    df: DataFrame, cols: Sequence[str], fn: Callable[[Column], Column], name: str = "{col}"
) -> DataFrame:
    """Apply one function to many columns in a single projection."""
    return df.withColumns({name.format(col=c): fn(named(c)) for c in cols})


# -- predicates -------------------------------------------------------------------------


def filter_all(df: DataFrame, *conds: Column) -> DataFrame:
    """Rows for which every condition is true."""
    return df.where(reduce(lambda a, b: a & b, conds))


def filter_rlike(df: DataFrame, col: ColumnLike, pattern: str, keep: bool = True) -> DataFrame:
    hit = as_col(col).rlike(pattern)
    return df.where(hit if keep else ~hit)


def until(df: DataFrame, date_col: ColumnLike, as_of: ColumnLike, unit: str = "month") -> DataFrame:
    """Drop periods from the one holding `as_of` onward: they are not published yet."""
    return df.where(as_col(date_col) < F.trunc(as_col(as_of), unit))


# -- ordering ---------------------------------------------------------------------------


def sort_order(*keys: str) -> list[Column]:
    """Order by several keys, `-name` for descending, missing values always last."""
    return [
        named(k[1:]).desc_nulls_last() if k.startswith("-") else named(k).asc_nulls_last()
        for k in keys
    ]


def sort_na_last(df: DataFrame, *keys: str) -> DataFrame:
    """Sort by several keys, `-name` for descending, missing values always last."""
    return df.orderBy(*sort_order(*keys))


def in_ranges(df: DataFrame, *keys: str) -> DataFrame:
    """Rows in ranges of an order, one task each, and in order within them.

    Files written from it hold the order from the first part to the last. The other columns
    break ties, so rows that are equal in the keys can still be dealt to several tasks.
    """
    listed = {k.lstrip("-") for k in keys}
    ties = [f.name for f in df.schema if f.name not in listed and f.dataType.typeName() not in ("map", "variant")]
    order = sort_order(*keys, *ties)
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def head_n(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """First n rows of an ordering; each task keeps only its own first n."""
    return sort_na_last(df, *keys).limit(n)


def nth(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """The n-th row of an ordering; none if there are fewer. The other columns break ties.

    Rows are written in ranges of the order. The sizes of the ranges, one number each, tell which
    one holds the row, and only that one is read and sorted, so n may be in the billions.
    """
    placed = stage(in_ranges(df, *keys).withColumn("__range", F.spark_partition_id()), "ranges", ["__range"])
    before = 0
    for r in placed.groupBy("__range").agg(F.count("*").alias("size")).orderBy("__range").collect():
        if n <= before + r["size"]:
            listed = {k.lstrip("-") for k in keys}
            rows = placed.where(F.col("__range") == r["__range"]).drop("__range")
            order = [*keys, *[f.name for f in df.schema if f.name not in listed and f.dataType.typeName() not in ("map", "variant")]]
            return sort_na_last(rows, *order).offset(n - 1 - before).limit(1)
        before += r["size"]
    return df.limit(0)


def top_partners(
    df: DataFrame, k: int, by: Sequence[str], value: str, name: str, residual: str | None = None
) -> DataFrame:
    """Largest k rows of each group; residual aggregates are left out of the ranking.

    The rank filter lets Spark cut each group to k rows before the shuffle, so a large
    group never reaches one task whole. Ties go to the smaller name.
    """
    if residual:
        df = df.where(~named(residual))
    w = Window.partitionBy(*[named(b) for b in by]).orderBy(
        named(value).desc_nulls_last(), named(name).asc_nulls_last()
    )
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def with_level_rank(
    df: DataFrame, col: str, levels: Sequence[str] | None = None, order: str | None = None,
    name: str = "level_rank",
) -> DataFrame:
    """Rank of an ordered category, by its given levels or by first appearance in `order`.

    Levels outside the list rank NULL. First appearance is found with one row per label,
    so neither a frequent label nor a long label list meets in one task.
    """
    if levels is not None:
        place = F.array_position(F.array(*[F.lit(v) for v in levels]), named(col)).cast("int")
        return df.withColumn(name, F.nullif(place, F.lit(0)))
    first = df.groupBy(named(col)).agg(F.min(named(order)).alias("__first"))
    ranks = numbered(first.withColumn("__all", F.lit(1)), ["__all"], "__first", name)
    return natural_join(df, ranks.select(named(col), F.col(name).cast("int").alias(name)), "left", [col])


# -- row binding ----------------------------------------------------------------------


def union_all(dfs: Sequence[DataFrame]) -> DataFrame:
    """Bind rows by name; columns missing on one side are NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def union_labeled(parts: Mapping[str, DataFrame], col: str) -> DataFrame:
    """Bind rows and record which part each came from."""
    return union_all([df.withColumn(col, F.lit(label)) for label, df in parts.items()])


def splice(old: DataFrame, new: DataFrame, date_col: str, cut: str) -> DataFrame:
    """Old vintage before the cut-over date, new vintage from it."""
    at = F.lit(cut).cast("date")
    return union_all([old.where(named(date_col) < at), new.where(named(date_col) >= at)])


def by_periodicity(df: DataFrame, kinds: Sequence[str], col: str = "PeriodType") -> dict[str, DataFrame]:
    """One frame per kind of period, without the kind column."""
    return {k: df.where(named(col) == k).drop(col) for k in kinds}


def names_setdiff(df: DataFrame, names: Sequence[str]) -> list[str]:
    """Column names outside `names`, in column order."""
    return [c for c in df.columns if c not in set(names)]
