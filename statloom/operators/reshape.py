"""Wide-to-long and back, filled-down headers and stitched column chunks."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cols import literal, named, quoted
from ..functions.dates import header_year
from ..functions.text import as_double, parse_number, remove_first, squish
from .numbering import CHUNK_ROWS, carried_down

HAS_YEAR = re.compile(r"\d{4}")


Derive = Callable[[Column], Column]


# what a function tells of a header, as a SQL literal: it depends on nothing else
_known_facts: WeakKeyDictionary[Derive, dict[str, str]] = WeakKeyDictionary()


def _header_facts(
    df: DataFrame, cols: Sequence[str], derived: Mapping[str, Derive]
) -> dict[str, dict[str, str]]:
    """What each header tells, as SQL literals: worked out once per distinct header, not per cell or table."""
    known = {k: _known_facts.setdefault(fn, {}) for k, fn in derived.items()}
    new = sorted({c for c in cols for k in derived if c not in known[k]})
    if new:
        heads = df.sparkSession.createDataFrame([(c,) for c in new], "h string")
        facts = heads.select("h", *[fn(F.col("h")).alias(k) for k, fn in derived.items()])
        types = dict(facts.dtypes)
        for r in facts.collect():
            for k in derived:
                known[k][r["h"]] = literal(r[k], types[k])
    return {c: {k: known[k][c] for k in derived} for c in cols}


def _melt(
    df: DataFrame, ids: Sequence[str], cols: Sequence[str], name: str, value: str,
    cast: Derive | None, derived: Mapping[str, Derive] | None = None,
    only: Mapping[str, str] | None = None,
) -> DataFrame:
    """One row per (row, column), with `derived` columns computed from the header alone.

    Generating rows, unlike `unpivot`, keeps the frame's partitioning by its id columns,
    so a window over them needs no second shuffle. Columns whose header does not tell what `only` asks
    for are left before that, so their cells are never made rows, nor read from a file by columns.
    """
    facts = _header_facts(df, cols, derived or {})
    wanted = [c for c in cols if all(facts[c][k] == literal(v) for k, v in (only or {}).items())]
    cells = ", ".join(
        "named_struct(" + ", ".join(
            [literal(name), literal(c), literal(value), quoted(c), *[x for k, v in facts[c].items() for x in (literal(k), v)]]) + ")"
        for c in wanted or cols[:1])
    long = df.selectExpr(*[quoted(i) for i in ids], f"inline(array({cells}))")
    if not wanted:
        long = long.where(F.lit(False))
    return long.withColumn(value, cast(named(value))) if cast else long


def period_columns(names: Sequence[str]) -> list[str]:
    """Names that hold a four-digit year."""
    return [n for n in names if HAS_YEAR.search(n)]


def period_label(header: Column) -> Column:
    """Header text without the year that `header_year` reads."""
    return squish(F.when(header.startswith("At "), remove_first(header, r"\s*\d{4}\s*$"))
                  .otherwise(remove_first(header, r"\s*\d{4}\s*")))


PERIOD_PARTS: Mapping[str, Derive] = {"Yr": header_year, "PeriodLabel": period_label}


def unpivot_periods(
    df: DataFrame, value: str = "Value", derived: Mapping[str, Derive] = PERIOD_PARTS,
    only: Mapping[str, str] | None = None,
) -> DataFrame:
    """Long form of a wide period table: header, number, and what the header tells.

    By default that is the year and the period label. Empty cells stay, as NULL. `only` names
    what a header must tell, such as a period type, for its column to be taken.
    """
    periods = period_columns(df.columns)
    if not periods:
        raise ValueError("no period columns")
    ids = [c for c in df.columns if c not in periods]
    return _melt(df, ids, periods, "PeriodRaw", value, parse_number, derived, only)


def unpivot_except(
    df: DataFrame, ids: Sequence[str], name: str, value: str, cast: Derive | None = as_double,
    derived: Mapping[str, Derive] | None = None,
) -> DataFrame:
    """Long form over every column but `ids`."""
    cols = [c for c in df.columns if c not in set(ids)]
    return _melt(df, ids, cols, name, value, cast, derived)


def pivot_wide(
    df: DataFrame, keys: Sequence[str], names: str, value: str, levels: Sequence[str] | None = None,
    others: str = "raise",
) -> DataFrame:
    """One column per level. With the levels given, no job is spent finding them.

    Nothing is lost silently: a name outside the levels raises, unless `others` is "drop",
    and so do two values in one cell.
    """
    if levels is None:
        levels = [r[0] for r in df.select(named(names)).where(named(names).isNotNull()).distinct().orderBy(names).collect()]
    levels = list(levels)
    known = named(names).isin(levels)
    if others == "drop":
        df = df.where(known)
    else:
        message = F.concat(F.lit("name outside the levels: "), F.coalesce(named(names).cast("string"), F.lit("NULL")))
        df = df.withColumn(names, F.when(known, named(names)).otherwise(F.raise_error(message)))
    twice = F.raise_error(F.lit("two values in one cell"))
    return df.groupBy(*[named(k) for k in keys]).pivot(names, levels).agg(
        F.when(F.count(named(value)) > 1, twice).otherwise(F.first(named(value), ignorenulls=True)))


def combine_categories(
    df: DataFrame, keys: Sequence[str], names: str, value: str,
    formulas: Mapping[str, Callable[[Mapping[str, Column]], Column]], levels: Sequence[str],
    others: str = "raise",
) -> DataFrame:
    """Wide, arithmetic between categories, and back to long under the new names."""
    wide = pivot_wide(df, keys, names, value, levels, others)
    cells = {lv: named(lv) for lv in levels}
    made = wide.select(*[named(k) for k in keys], *[fn(cells).alias(n) for n, fn in formulas.items()])
    return _melt(made, keys, list(formulas), names, value, None)


def fill_down(
    df: DataFrame, col: str, order: str, keys: Sequence[str] = (), rows: int = CHUNK_ROWS
) -> DataFrame:
    """Carry a group header over the rows below it."""
    return carried_down(df, keys, order, col, rows)


def split_header_rows(
    df: DataFrame, label: str, order: str, keys: Sequence[str] = (), rows: int = CHUNK_ROWS
) -> DataFrame:
    """Rows whose label holds digits are year headers; the others are months under them.

    Adds `Period` (`1995 Jan`); header rows themselves, which carry the yearly average,
    are dropped.
    """
    header = named(label).rlike(r"\d")
    marked = df.where(named(label).isNotNull()).withColumn("Year", F.when(header, named(label)))
    filled = carried_down(marked, keys, order, "Year", rows)
    period = F.concat(F.col("Year"), F.lit(" "), F.substring(named(label), 1, 3))
    return filled.where(~header).withColumn("Period", period)


def stitch_columns(parts: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Put column chunks of the same rows side by side, matched on their keys.

    Stacked and folded by key: one shuffle with map-side folding for any number of parts,
    and missing keys match each other. A key that a part has twice raises, and so do parts
    that share a value column.
    """
    owner = [(c, i) for i, p in enumerate(parts) for c in p.columns if c not in set(keys)]
    if len({c for c, _ in owner}) < len(owner):
        raise ValueError("two parts share a value column")
    stacked = parts[0].withColumn("__part", F.lit(0))
    for i, p in enumerate(parts[1:], 1):
        stacked = stacked.unionByName(p.withColumn("__part", F.lit(i)), allowMissingColumns=True)
    twice = F.raise_error(F.lit("a part has a key twice"))
    return stacked.groupBy(*[named(k) for k in keys]).agg(*[
        F.when(F.count_if(F.col("__part") == i) > 1, twice).otherwise(F.max(named(c))).alias(c)
        for c, i in owner])


def split_range(
    df: DataFrame, ids: Sequence[str], spans: Sequence[tuple[str, str]]
) -> list[DataFrame]:
    """Several outputs, each the id columns plus one range of columns by name."""
    names = list(df.columns)
    outs = []
    for a, b in spans:
        cols = names[names.index(a) : names.index(b) + 1]
        outs.append(df.select(*[named(i) for i in ids], *[named(c) for c in cols]))
    return outs
