"""Consumer prices: vintages to inflation tables, sheet re-assembly, deflators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cols import ColumnLike, named
from ..functions.dates import parse_date
from ..functions.labels import recode
from ..functions.numbers import ratio
from ..functions.text import as_double, normalise_label, strip_code_prefix
from ..operators.frames import rename_by, union_all, until
from ..operators.joins import natural_join
from ..operators.reshape import fill_down, split_header_rows, stitch_columns, unpivot_except
from ..operators.windows import yoy

SERIES = ["Geolocation", "Commodity"]

# fixed values: headings of the small and main tables, and display names in display order
SMALL_NAMES = {
    "ALL ITEMS": "Headline",
    "CORE": "Core",
    "FOOD AND NON-ALCOHOLIC BEVERAGES": "Food",
    "NON-FOOD": "Non-Food",
}
SMALL_LEVELS = ["Headline", "Core", "Food", "Non-Food"]
MAIN_COMMODITIES = [
    "ALL ITEMS", "FOOD AND NON-ALCOHOLIC BEVERAGES",
    "ALCOHOLIC BEVERAGES, TOBACCO AND OTHER VEGETABLE-BASED TOBACCO PRODUCTS",
    "NON-FOOD", "CLOTHING AND FOOTWEAR",
    "HOUSING, WATER, ELECTRICITY, GAS AND OTHER FUELS",
    "FURNISHINGS, HOUSEHOLD EQUIPMENT AND ROUTINE HOUSEHOLD MAINTENANCE",
    "HEALTH", "TRANSPORT", "COMMUNICATION", "RECREATION AND CULTURE", "EDUCATION",
    "RESTAURANTS AND MISCELLANEOUS GOODS AND SERVICES",
]
NATIONAL = "PHILIPPINES"
LATE_PLACE_WORD = "Bansamoro "  # in place names of the latest vintage only


def align_places(vintage: DataFrame, word: str = LATE_PLACE_WORD) -> DataFrame:
    """Place names of a late vintage as the earlier ones spell them."""
    return vintage.withColumn("Geolocation", normalise_label("Geolocation", word))


def _tidy(wide: DataFrame, as_of: ColumnLike | None) -> DataFrame:
    df = rename_by(wide, names={"Commodity Description": "Commodity"})
    long = unpivot_except(
        df, SERIES, "Period", "CPI", as_double, {"Month": lambda h: parse_date(h, "%Y %b")}
    ).where(F.col("Month").isNotNull())
    if as_of is not None:
        long = until(long, "Month", as_of)
    return long.select(*SERIES, "Month", "CPI")


def build_inflation(vintages: Sequence[DataFrame], as_of: Column | None) -> DataFrame:
    """Monthly index and its change over the year, from column-wise vintages.

    Yearly averages (`Ave` columns) are no months and drop out; months from that of
    `as_of` on are not published and drop out too.
    """
    keys = [c for c in vintages[0].columns if c in ("Geolocation", "Commodity Description", "Commodity")]
    wide = stitch_columns(vintages, keys) if len(vintages) > 1 else vintages[0]
    return yoy(_tidy(wide, as_of), SERIES, "Month", "CPI", 12, "Inflation")


def build_core(wide: DataFrame, all_items: str = "0 - ALL ITEMS") -> DataFrame:
    """Core inflation from its own table."""
    rows = _tidy(wide, None).where(F.col("Commodity") == all_items)
    return yoy(rows, SERIES, "Month", "CPI", 12, "Inflation").withColumn("Commodity", F.lit("CORE"))


def build_core_from_sheet(grid: DataFrame, label: str, value: str) -> DataFrame:
    """Core inflation from a landed sheet whose year headers sit between the month rows."""
    rows = split_header_rows(grid, label, "row_idx")
    tidy = rows.select(
        F.lit(NATIONAL).alias("Geolocation"), F.lit("CORE").alias("Commodity"),
        parse_date("Period", "%Y %b").alias("Month"), as_double(named(value)).alias("CPI"))
    return yoy(tidy.where(F.col("Month").isNotNull()), SERIES, "Month", "CPI", 12, "Inflation")


def small_table(large: DataFrame, core: DataFrame) -> DataFrame:
    """Headline, core, food and non-food at national level, with their display rank."""
    plain = large.withColumn("Commodity", strip_code_prefix("Commodity")).where(
        (F.col("Geolocation") == NATIONAL)
        & F.col("Commodity").isin(*[c for c in SMALL_NAMES if c != "CORE"]))
    both = union_all([plain, core]).withColumn("Commodity", recode("Commodity", SMALL_NAMES))
    rank = F.array_position(F.array(*[F.lit(x) for x in SMALL_LEVELS]), F.col("Commodity"))
    return both.withColumn("CommodityRank", rank.cast("int"))


def main_table(large: DataFrame) -> DataFrame:
    """Thirteen headings for the nation and its regions, not for provinces."""
    plain = large.withColumn("Commodity", strip_code_prefix("Commodity"))
    return plain.where(
        ~F.col("Geolocation").rlike(r"^\.{4}") & F.col("Commodity").isin(*MAIN_COMMODITIES))


def build_cpi_items(items: DataFrame, sheet: DataFrame, order: str = "row_idx") -> DataFrame:
    """Item list beside the sheet values, the sheet's place names filled down first."""
    filled = fill_down(sheet, "Geolocation", order).drop(order)
    return natural_join(items.drop("Weights"), filled, "left")


def build_deflators(nominal: DataFrame, real: DataFrame, cpi: DataFrame) -> DataFrame:
    """Nominal over real output in percent, beside the price index of each year."""
    both = natural_join(nominal, real, "left", ["Year"])
    deflator = both.select("Year", (ratio("NominalGDP", "RealGDP") * 100).alias("GDPDeflator"))
    return natural_join(deflator, cpi, "right", ["Year"])
