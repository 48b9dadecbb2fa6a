"""Row numbers and carried values that hold no whole group in one task.

A plain window sends every row of a group to one task. Here each group is cut into
`chunks` (a column that grows with the order), work is done inside (group, chunk), and
one small row per chunk is carried on. Where the order is sparse there may be as many chunks
as rows, so the chunk rows are cut into blocks in the same way, and only one row per block is
windowed over the whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.cols import named
from ..sources.workspace import stage

CHUNK_ROWS = 65_536


def chunk_of(order: str, rows: int = CHUNK_ROWS) -> Column:
    """Chunk number of an integer order column (a row index or id)."""
    return F.floor(named(order) / F.lit(rows)).cast("bigint")


def _join_same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    renamed = right.toDF(*[f"__r_{c}" if c in keys else c for c in right.columns])
    cond = [named(k).eqNullSafe(named(f"__r_{k}")) for k in keys]
    return left.join(renamed, cond, "left").drop(*[f"__r_{k}" for k in keys])


def _block_windows(keys: Sequence[str]):
    """Columns of a block, the window over a group's blocks, and the window over a block's chunks."""
    blocks = [*keys, "__block"]
    return (blocks, Window.partitionBy(*[named(k) for k in keys]).orderBy("__block"),
            Window.partitionBy(*[named(c) for c in blocks]).orderBy("__chunk"))


def numbered(
    df: DataFrame, keys: Sequence[str], order: str, name: str, size: str | None = None,
    rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Row number within `keys` by the unique integer column `order`.

    `size` also adds the number of rows of the group.
    """
    cells = [*keys, "__chunk"]
    cut = df.withColumn("__chunk", chunk_of(order, rows))
    blocks, over_blocks, over_chunks = _block_windows(keys)
    counts = cut.groupBy(*[named(c) for c in cells]).agg(F.count("*").alias("__n")).withColumn(
        "__block", chunk_of("__chunk", rows))
    starts = (
        counts.groupBy(*[named(c) for c in blocks]).agg(F.sum("__n").alias("__rows"))
        .withColumn("__start", F.coalesce(F.sum("__rows").over(
            over_blocks.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("__size", F.sum("__rows").over(
            over_blocks.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
        .drop("__rows")
    )
    offsets = _join_same(counts, starts, blocks).withColumn("__before", F.col("__start") + F.coalesce(
        F.sum("__n").over(over_chunks.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop(
        "__n", "__block", "__start")
    inside = Window.partitionBy(*[named(c) for c in cells]).orderBy(named(order))
    out = _join_same(cut, offsets, cells).withColumn(
        name, F.row_number().over(inside) + F.col("__before"))
    if size:
        out = out.withColumn(size, F.col("__size"))
    return out.drop("__chunk", "__before", "__size")


def carried_down(
    df: DataFrame, keys: Sequence[str], order: str, col: str, rows: int = CHUNK_ROWS
) -> DataFrame:
    """Replace missing values of `col` by the last one seen above in `order`."""
    cells = [*keys, "__chunk"]
    cut = df.withColumn("__chunk", chunk_of(order, rows))
    blocks, over_blocks, over_chunks = _block_windows(keys)
    seen = named(col).isNotNull()
    lasts = cut.groupBy(*[named(c) for c in cells]).agg(
        F.max_by(named(col), F.when(seen, named(order))).alias("__last")).withColumn(
        "__block", chunk_of("__chunk", rows))
    starts = (
        lasts.groupBy(*[named(c) for c in blocks])
        .agg(F.max_by("__last", F.when(F.col("__last").isNotNull(), F.col("__chunk"))).alias("__of_block"))
        .withColumn("__start", F.last("__of_block", ignorenulls=True).over(
            over_blocks.rowsBetween(Window.unboundedPreceding, -1)))
        .drop("__of_block")
    )
    carry = _join_same(lasts, starts, blocks).withColumn("__carry", F.coalesce(
        F.last("__last", ignorenulls=True).over(over_chunks.rowsBetween(Window.unboundedPreceding, -1)),
        F.col("__start"))).drop("__last", "__block", "__start")
    inside = (Window.partitionBy(*[named(c) for c in cells]).orderBy(named(order))
              .rowsBetween(Window.unboundedPreceding, 0))
    return (
        _join_same(cut, carry, cells)
        .withColumn(col, F.coalesce(F.last(named(col), ignorenulls=True).over(inside), F.col("__carry")))
        .drop("__chunk", "__carry")
    )


def ranked(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, parts: int | None = None
) -> DataFrame:
    """Row number within `keys` by any order, also of texts; rows equal in keys and order are numbered in any way.

    Rows are dealt to ranges of (keys, order) and written down with the number of their range. A
    group that spans several ranges is counted in each, and what stands in the ranges before is added: one
    row per group and range is windowed over a group, and no task holds more rows of it than a range has.
    """
    cols = [*keys, *order]
    by = [named(c).asc_nulls_last() for c in cols]
    dealt = df.repartitionByRange(parts, *by) if parts else df.repartitionByRange(*by)
    placed = stage(dealt.withColumn("__chunk", F.spark_partition_id()), "ranked")
    cells = [*keys, "__chunk"]
    counts = placed.groupBy(*[named(c) for c in cells]).agg(F.count("*").alias("__n"))
    over = Window.partitionBy(*[named(k) for k in keys]).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(*[named(c) for c in cells], F.coalesce(F.sum("__n").over(over), F.lit(0)).alias("__before"))
    inside = Window.partitionBy(*[named(c) for c in cells]).orderBy(*[named(o).asc_nulls_last() for o in order])
    return _join_same(placed, before, cells).withColumn(
        name, F.row_number().over(inside) + F.col("__before")).drop("__chunk", "__before")
