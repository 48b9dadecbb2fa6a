"""Label rules: recoding, first-match classification and dot hierarchies."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from .cols import ColumnLike, as_col
from .text import remove_all, squish


def recode(c: ColumnLike, mapping: Mapping[str, str]) -> Column:
    """Replace the labels named in `mapping`, keep all others."""
    col = as_col(c)
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return F.coalesce(F.try_element_at(table, col), col)


def classify(rules: Sequence[tuple[Column, str | Column]], default: str | Column | None) -> Column:
    """First rule that holds wins, else the default."""
    (cond, value), *rest = rules
    lit = lambda v: v if isinstance(v, Column) else F.lit(v)
    out = F.when(cond, lit(value))
    for cond, value in rest:
        out = out.when(cond, lit(value))
    return out.otherwise(lit(default))


def geo_level(c: ColumnLike) -> Column:
    """Administrative level from leading dots."""
    col = as_col(c)
    return classify(
        [(col.rlike(r"^\.{4,}"), "Province"), (col.rlike(r"^\.{2,}"), "Region")], "National"
    )


def depth(c: ColumnLike) -> Column:
    """Number of leading dots."""
    return F.length(F.regexp_extract(as_col(c), r"^(\.*)", 1))


def strip_dots(c: ColumnLike) -> Column:
    return squish(remove_all(c, r"^\.+"))


def in_set(c: ColumnLike, values: Sequence[str]) -> Column:
    """Membership that is false, not NULL, for a missing value."""
    return F.coalesce(as_col(c).isin(*values), F.lit(False))


def match_index(c: ColumnLike, values: Sequence[str]) -> Column:
    """Position of the value in the list from 1; NULL when absent."""
    where = F.array_position(F.array(*[F.lit(v) for v in values]), as_col(c)).cast("int")
    return F.nullif(where, F.lit(0))
