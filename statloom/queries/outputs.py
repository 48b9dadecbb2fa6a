"""The seven trade tables as files: written in order, described, counted while written, published."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import trade as T
from ..sources import scan as S
from ..sources import sinks as K
from ..sources.workspace import fresh_dir
from .common import COMMODITY, PARTNER, ctes
from .contents import COLUMNS, contents, contents_sql
from .domain import ANNUAL_SQL, COMMODITY_SQL, GROUP_SQL, MINERAL_SQL, PARTNER_SQL, REGION_SQL, SEMI_SQL
from .registry import query
from .scans import bundle, landed_vintages

TRADE_SQL = {
    "trade_annual": ANNUAL_SQL, "trade_by_partner": PARTNER_SQL, "trade_by_region": REGION_SQL,
    "trade_by_commodity": COMMODITY_SQL, "trade_by_partner_group": GROUP_SQL, "trade_semiconductors": SEMI_SQL,
    "trade_minerals": MINERAL_SQL,
}


@query("s15_write_tables", contents_sql(TRADE_SQL))
def s15(spark: SparkSession, sf: str) -> DataFrame:
    """From files to tables to files: records land as CSV, the tables are built and written, and read back."""
    tables = T.build_trade(S.scan_vintages(spark, landed_vintages(spark, sf)))
    folder = fresh_dir(spark, "csv")
    K.write_tables(tables, folder, order=T.TABLE_ORDER)
    return contents({n: S.scan_typed(spark, f"{folder}/{n}.csv", t.schema) for n, t in tables.items()})


NOTES = {
    ("", "value_usd"): "current USD", ("trade_annual", "balance"): "exports less imports",
    ("trade_annual", "total_trade"): "exports plus imports", ("trade_by_partner", "is_resid"): "label of no single country",
    ("", "code"): "6 digits from the HS era on",
}


def dictionary_sql() -> str:
    """The dictionary, from the columns in their published order."""
    order = {
        "trade_annual": "year Exports Imports balance total_trade",
        "trade_by_partner": "year direction country region is_europe is_asean is_resid value_usd",
        "trade_by_region": "year direction region value_usd",
        "trade_by_commodity": "year direction classification code chapter chapter_label group value_usd",
        "trade_by_partner_group": "year direction country group value_usd",
        "trade_semiconductors": "year direction country value_usd",
        "trade_minerals": "year direction country mineral_type value_usd",
    }
    rows = []
    for name, cols in order.items():
        kinds = dict(c.split(":") for c in COLUMNS[name].split())
        for i, c in enumerate(cols.split(), start=1):
            note = NOTES.get((name, c), NOTES.get(("", c)))
            rows.append(f"('{name}', {i}, '{c}', '{kinds[c]}', {'NULL' if note is None else repr(note)})")
    return f'SELECT * FROM (VALUES {", ".join(rows)}) t("table", position, "column", type, note)'


@query("s18_data_dictionary", ctes(PARTNER, COMMODITY) + dictionary_sql() + """
UNION ALL
SELECT 'coverage', 0, NULL, NULL, 'Coverage: ' || min(year) || '-' || max(year) ||
  '; commodity by HS classification from ' || (SELECT min(year) FROM commodity WHERE classification = 'HS')
  || ' onward, PSCC before that.'
FROM partner""")
def s18(spark: SparkSession, sf: str) -> DataFrame:
    tables = bundle(spark, sf)
    cover = K.coverage_text(tables["trade_annual"], tables["trade_by_commodity"])
    return K.data_dictionary(spark, tables, NOTES).unionByName(cover.select(
        F.lit("coverage").alias("table"), F.lit(0).alias("position"),
        F.lit(None).cast("string").alias("column"), F.lit(None).cast("string").alias("type"),
        F.col("coverage").alias("note")))


@query("s19_output_inventory", "\nUNION ALL\n".join(
    f"SELECT '{n}.csv' AS file, count(*) AS rows, true AS has_size FROM ({sql})" for n, sql in TRADE_SQL.items()))
def s19(spark: SparkSession, sf: str) -> DataFrame:
    tables, folder = bundle(spark, sf), fresh_dir(spark, "inventory")
    written = K.write_tables(tables, folder, order=T.TABLE_ORDER)
    found = K.output_inventory(tables, folder, written=written)
    return found.select("file", "rows", F.col("MB").isNotNull().alias("has_size"))
