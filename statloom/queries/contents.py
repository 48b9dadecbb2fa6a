"""Contents of whole tables as one row each, the same in Spark and in SQL.

A row of a table becomes a text of its cells (amounts in millionths), the text an md5 number, and
the numbers are summed, so neither order nor files matter.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.cols import named

# columns of the published tables, in the order of their names, and their types
COLUMNS = {
    "trade_annual": "Exports:double Imports:double balance:double total_trade:double year:int",
    "trade_by_partner": "country:string direction:string is_asean:boolean is_europe:boolean is_resid:boolean region:string "
                        "value_usd:double year:int",
    "trade_by_region": "direction:string region:string value_usd:double year:int",
    "trade_by_commodity": "chapter:string chapter_label:string classification:string code:string direction:string group:string "
                          "value_usd:double year:int",
    "trade_by_partner_group": "country:string direction:string group:string value_usd:double year:int",
    "trade_semiconductors": "country:string direction:string value_usd:double year:int",
    "trade_minerals": "country:string direction:string mineral_type:string value_usd:double year:int",
    "SNA2000_Quarterly_Exp": "Expenditure:string GrowthRate:double MillionPesos:double Quarter:date Valuation:string",
    "SNA2000_Quarterly_Ind": "GrowthRate:double Industry:string MillionPesos:double Quarter:date Valuation:string",
    "SNA2000_Quarterly_PC": "GrowthRate:double Industry:string Pesos:double Quarter:date Valuation:string",
    "inflation_small": "CPI:double Commodity:string CommodityRank:int Geolocation:string Inflation:double Month:date",
    "inflation_main": "CPI:double Commodity:string Geolocation:string Inflation:double Month:date",
    "inflation_core": "CPI:double Commodity:string Geolocation:string Inflation:double Month:date",
    "deflators": "CPI:bigint GDPDeflator:double Year:int",
    "labor": "Employed:bigint LFSRound:string Period:date Population15YearsOld:bigint Round:string",
    "ngcor": "BIRRevenues:double BIRRevenues4Q:double BOCRevenuesnet:double BOCRevenuesnet4Q:double Expenditures:double "
             "Expenditures4Q:double Grants:double Grants4Q:double NominalGDP:double NominalGDP4Q:double Quarter:date "
             "SurplusDeficit:double SurplusDeficit4Q:double",
    "ngdebt": "DebtService4Q:double DebtServiceInterestPayment:double DomesticDebt:double ExternalDebt:double Month:date "
              "NominalGDP:double NominalGDP4Q:double Quarter:date TotalObligations:double",
    "tax_types": "BIRRevenues4Q:double Collection:double Effort:double Goal:double NominalGDP4Q:double Quarter:date Share:double "
                 "TaxType:string Year:date",
    "crops_annual": "Area:double AreaGrowth:double Commodity:string Geolocation:string Level:string Volume:double "
                    "VolumeGrowth:double Year:date Yield:double YieldGrowth:double",
    "livestock_annual": "Depth:int Indicator:string Item:string Value:double Year:date",
    "fisheries_annual": "Geolocation:string Indicator:string Level:string Subsector:string Value:double Year:date",
    "value_production_quarterly": "GrowthRate:double MillionPesos:double Quarter:date Subsector:string Valuation:string",
    "self_sufficiency_annual": "Commodity:string Indicator:string Ratio:double Year:date",
    "prices_monthly": "Commodity:string Geolocation:string Level:string Month:date Pesos:double PriceType:string Series:string",
}


def contents_sql(tables: dict[str, str]) -> str:
    """One row for each of the named SQL texts: table, rows, content."""

    def one(name: str, sql: str) -> str:
        cells = []
        for item in COLUMNS[name].split():
            col, kind = item.split(":")
            cell = f'CAST(round("{col}" * 1e6) AS BIGINT)' if kind == "double" else f'"{col}"'
            cells.append(f"coalesce(CAST({cell} AS VARCHAR), '~')")
        return (f"SELECT '{name}' AS \"table\", count(*) AS rows, "
                f"coalesce(sum(CAST('0x' || substr(md5(concat_ws('|', {', '.join(cells)})), 1, 12) AS BIGINT)), 0)::VARCHAR AS content "
                f"FROM ({sql})")

    return "\nUNION ALL\n".join(one(name, sql) for name, sql in tables.items())


def contents(tables: dict[str, DataFrame]) -> DataFrame:
    def one(name: str, df: DataFrame) -> DataFrame:
        cells = []
        for col, kind in sorted(df.dtypes):
            cell = F.round(named(col) * 1e6).cast("bigint") if kind == "double" else named(col)
            cells.append(F.coalesce(cell.cast("string"), F.lit("~")))
        number = F.conv(F.substring(F.md5(F.concat_ws("|", *cells)), 1, 12), 16, 10).cast("decimal(20,0)")
        return df.agg(F.lit(name).alias("table"), F.count(F.lit(1)).alias("rows"),
                      F.coalesce(F.sum(number), F.lit(0)).cast("string").alias("content"))

    return reduce(DataFrame.unionByName, [one(n, df) for n, df in tables.items()])
