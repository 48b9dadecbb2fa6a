"""Joins on shared names, with missing keys matching each other."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cols import ColumnLike, as_col, named

LITERAL_LIMIT = 1_000


def natural_join(
    a: DataFrame, b: DataFrame, how: str = "left", keys: Sequence[str] | None = None,
    unique_keys: bool = False,
) -> DataFrame:
    """Join on all shared column names (or `keys`); NULL keys match NULL keys.

    No side is hinted: Spark broadcasts one only when its known size is under the
    session's limit, and splits oversized partitions of shuffled ones. Spark cannot split
    a hot key in a full outer join, so a full join is built as a left join plus the
    unmatched right rows. Where both sides are known to hold one row per key
    (`unique_keys`), no key can be hot and one plain full join reads each side once.
    """
    keys = list(keys or [c for c in a.columns if c in b.columns])
    extra = [c for c in b.columns if c not in keys]
    right = b.select(*[named(k).alias(f"__b_{k}") for k in keys], *[named(c) for c in extra])
    cond = reduce(
        lambda x, y: x & y, [named(k).eqNullSafe(named(f"__b_{k}")) for k in keys])
    mine = [c for c in a.columns if c not in keys]
    cols_a = [named(k) for k in keys]
    if how == "full" and unique_keys:
        both = a.join(right, cond, "full")
        mark = [F.coalesce(named(k), named(f"__b_{k}")).alias(k) for k in keys]
        return both.select(*mark, *[named(c) for c in [*mine, *extra]])
    if how == "full":
        left = a.join(right, cond, "left").select(*cols_a, *[named(c) for c in [*mine, *extra]])
        only_b = right.join(a.select(*cols_a), cond, "left_anti").select(
            *[named(f"__b_{k}").alias(k) for k in keys], *[named(c) for c in extra])
        return left.unionByName(only_b, allowMissingColumns=True)
    if how == "right":
        joined = a.join(right, cond, "right")
        return joined.select(*[named(f"__b_{k}").alias(k) for k in keys],
                             *[named(c) for c in [*mine, *extra]])
    return a.join(right, cond, how).select(*cols_a, *[named(c) for c in [*mine, *extra]])


def join_all(parts: Sequence[DataFrame], keys: Sequence[str], how: str = "left") -> DataFrame:
    """Chain of joins on the same keys; the key partitioning carries through the chain."""
    return reduce(lambda a, b: natural_join(a, b, how, list(keys)), parts)


def label_lookup(code: ColumnLike, table: Mapping[str, str], default: Column) -> Column:
    """Label of a code from a fixed table, else the default.

    The table is a literal inside the plan, so its size is fixed and checked here.
    """
    if len(table) > LITERAL_LIMIT:
        raise ValueError("table too large for a literal lookup; use label_join")
    entries = F.create_map(*[F.lit(x) for x in chain.from_iterable(table.items())])
    return F.coalesce(F.try_element_at(entries, as_col(code)), default)


def label_join(
    df: DataFrame, code: str, labels: DataFrame, label: str, default: Column, key: str | None = None,
) -> DataFrame:
    """Add the label of a code from a table of any size, else the default.

    `labels` has the code in `key` (or under the same name) and the label in `label`; a code
    with two labels raises. No side is hinted. A missing code has the label of the missing key.
    """
    twice = F.raise_error(F.lit("a code has two labels"))
    one = labels.groupBy(named(key or code).alias("__code")).agg(
        F.when(F.count_distinct(named(label)) > 1, twice).otherwise(F.first(named(label), ignorenulls=True)).alias("__label"))
    both = df.join(one, named(code).eqNullSafe(F.col("__code")), "left")
    return both.withColumn(label, F.coalesce(F.col("__label"), default)).drop("__code", "__label")


def pending(wanted: DataFrame, landed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What is wanted and has not landed yet."""
    return natural_join(wanted, landed.select(*[named(k) for k in keys]), "left_anti", list(keys))


def members(df: DataFrame, allowed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys occur in `allowed`."""
    return natural_join(df, allowed.select(*[named(k) for k in keys]), "left_semi", list(keys))
