"""National accounts: blocks of landed sheets and per-capita tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cols import named
from ..functions.dates import yq
from ..functions.text import as_double, extract, remove_all, remove_first, squish, title
from ..operators.frames import filter_rlike, union_labeled, with_level_rank
from ..operators.reshape import unpivot_except
from ..operators.windows import yoy
from ..sources.scan import grid_block

LESS = "Less : "
AFTER_COMMA = ",.+"
DISCREPANCY = "discrepancy"


def as_date(header: Column) -> Column:
    return header.cast("date")


@dataclass(frozen=True)
class Block:
    """Rows of a sheet that hold one valuation of a table; the sheet is named where there are several."""

    valuation: str
    skip: int
    n: int
    sheet: str | None = None


def build_accounts(
    grid: DataFrame | Mapping[str, DataFrame], blocks: Sequence[Block], periods: Sequence[str], label: str,
    time: str = "Quarter", lag: int = 4, drop: str | None = None, strip: str = LESS, rank: str | None = None,
) -> DataFrame:
    """Stack the blocks under their valuation, with growth along each series.

    `periods` are the ISO start dates of the value columns. Growth is taken per row of the
    sheet, so two rows of one label do not mix; rows matching `drop` go, and labels are cleaned, only afterwards.
    `grid` is one sheet or, where blocks name theirs, sheets by name; blocks of two sheets may have the same
    rows. `rank` adds the place of each label by first appearance, block after block.
    """
    parts = {}
    for i, b in enumerate(blocks):
        sheet = grid if isinstance(grid, DataFrame) else grid[b.sheet]
        rows = grid_block(sheet, b.skip, b.n, [label, *periods]).where(named(label).isNotNull())
        parts[b.valuation] = unpivot_except(
            rows, ["row_idx", label], "Header", "MillionPesos", as_double,
            {time: as_date}).withColumn("__place", F.lit(i << 32) + F.col("row_idx"))
    long = union_labeled(parts, "Valuation")
    grown = yoy(long, ["Valuation", label, "row_idx"], time, "MillionPesos", lag)
    if drop:
        grown = filter_rlike(grown, label, drop, keep=False)
    cleaned = grown.withColumn(label, squish(remove_all(label, strip)))
    out = [label, time, "MillionPesos", "Valuation", "GrowthRate"]
    if rank is None:
        return cleaned.select(*out)
    return with_level_rank(cleaned, label, order="__place", name=rank).select(*out, rank)


def build_per_capita(wide: DataFrame) -> DataFrame:
    """Per-capita output and income: measure and valuation are parts of one label."""
    rows = filter_rlike(wide, "Industry", "Gross")
    long = unpivot_except(rows, ["Industry"], "name", "Pesos", as_double,
                          {"Quarter": lambda h: yq(extract(h, r"\d{4} Q\d"))})
    tidy = long.select(
        remove_first(extract("Industry", "Per.+at"), " at").alias("Industry"),
        "Quarter",
        title(remove_first("Industry", r"Per.+at\s")).alias("Valuation"), "Pesos")
    return yoy(tidy, ["Industry", "Valuation"], "Quarter", "Pesos", 4)
