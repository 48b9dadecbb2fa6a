"""JSON metadata and list columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .cols import ColumnLike, as_col, named

DIMS_SCHEMA = "struct<variables:array<struct<code:string,values:array<string>>>>"


def json_dims(c: ColumnLike) -> Column:
    """Array of (code, size) for the dimensions listed in a metadata document."""
    variables = F.from_json(as_col(c), DIMS_SCHEMA)["variables"]
    return F.transform(
        variables, lambda v: F.struct(v["code"].alias("code"), F.size(v["values"]).alias("size"))
    )


def explode_list(df: DataFrame, col: str, name: str) -> DataFrame:
    """One row per list element, other columns repeated."""
    keep = [named(c) for c in df.columns if c != col]
    return df.select(*keep, F.explode(named(col)).alias(name))
