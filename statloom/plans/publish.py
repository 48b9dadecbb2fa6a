"""Compile the curated bundle, and inspect raw record files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.aggs import code_profile
from ..operators.frames import union_all
from ..operators.windows import pick_spread
from ..sources.leading import headers
from ..sources.scan import scan_columns, scan_vintages
from ..sources.sinks import distinct_labels, publish_version
from .trade import TABLE_ORDER

# fixed values: the tables that go into the dashboard bundle
DASHBOARD_TABLES = [
    "SNA2000_Quarterly_Exp", "SNA2000_Quarterly_Ind", "SNA2000_Quarterly_PC",
    "inflation_small", "inflation_main", "inflation_core", "deflators",
    "labor",
    "ngcor", "ngdebt", "tax_types",
    "crops_annual", "livestock_annual", "fisheries_annual",
    "value_production_quarterly", "self_sufficiency_annual", "prices_monthly",
    "trade_annual", "trade_by_partner", "trade_by_region", "trade_by_commodity",
    "trade_semiconductors",
]


def compile_dashboard(tables: Mapping[str, DataFrame], folder: str) -> list[str]:
    """Write the dashboard tables of a bundle and nothing else, as a new version of what is published."""
    order = {
        n: keys for n, keys in TABLE_ORDER.items()
        if n in tables and {k.lstrip("-") for k in keys} <= set(tables[n].columns)}
    publish_version(tables, DASHBOARD_TABLES, folder, order)
    return list(DASHBOARD_TABLES)


def header_signatures(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Per file: number of columns and the header as text."""
    rows = [(p.rsplit("/", 1)[-1], len(h), " | ".join(h)) for p, h in headers(spark, paths).items()]
    return spark.createDataFrame(rows, "file string, ncol int, columns string")


def spread_of(spark: SparkSession, files: Mapping[str, Sequence[str]]) -> list[str]:
    """Oldest, middle and newest file of each direction, by name."""
    rows = [(d, i, p) for d, paths in files.items() for i, p in enumerate(sorted(paths))]
    listed = spark.createDataFrame(rows, "direction string, place bigint, path string")
    return sorted(r.path for r in pick_spread(listed, ["direction"], "place").collect())


def inspect(
    spark: SparkSession, files: Mapping[str, Sequence[str]], code: str = "Commodity Code"
) -> dict[str, DataFrame]:
    """Structure of record files by direction: headers, country labels, shape of the codes.

    Headers and labels cover every file; codes are profiled for a spread of vintages. Rows
    of a file have no lasting order in Spark, so the sample codes are the first by text.
    """
    every = [p for paths in files.values() for p in paths]
    parts = [
        scan_columns(spark, p, [code]).withColumn("file", F.lit(p.rsplit("/", 1)[-1]))
        for p in spread_of(spark, files)]
    return {
        "signatures": header_signatures(spark, every),
        "labels": distinct_labels(scan_vintages(spark, files), "country"),
        "codes": code_profile(union_all(parts), code, "file", code),
    }
