"""Public finance: cash operations, debt and tax tables joined with quarterly output."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cols import named
from ..functions.dates import parse_date, quarter_start
from ..functions.numbers import ratio
from ..functions.text import as_double, as_int, extract, ident, remove_first
from ..operators.aggs import to_quarter_end, to_quarter_sum
from ..operators.frames import splice
from ..operators.reshape import combine_categories, pivot_wide, unpivot_except
from ..operators.windows import roll_sum, roll_wide

GDP = "NominalGDP"

# fixed values: the debt lines that are read, and the sums published from them
DEBT_LINES = [
    "Total Obligations", "Actual Obligations", "Domestic Debt", "External Debt",
    "Domestic Guaranteed Obligations", "External Guaranteed Obligations",
]
DEBT_TABLE_LINES = ["Actual Obligations", "Domestic Debt", "External Debt"]
DEBT_SERVICE = "Debt Service - Interest Payment"
DEBT_SUMS: Mapping[str, tuple[str, ...]] = {
    "TotalObligations": ("Total Obligations",),
    "DomesticDebt": ("Domestic Debt", "Domestic Guaranteed Obligations"),
    "ExternalDebt": ("External Debt", "External Guaranteed Obligations"),
}


def monthly_long(raw: DataFrame) -> DataFrame:
    """Particulars by month from a table with one column per month (`January 1995`)."""
    long = unpivot_except(
        raw, ["Particulars"], "Period", "MillionPesos", as_double,
        {"Month": lambda h: parse_date(h, "%B %Y")})
    return long.select("Particulars", "Month", "MillionPesos")


def quarterly_wide(
    monthly: DataFrame, particulars: Sequence[str], digits: int | None = None
) -> DataFrame:
    """Monthly flows summed to quarters, one column per particular."""
    clean = monthly.withColumn("Particulars", ident("Particulars"))
    sums = to_quarter_sum(clean, ["Particulars"], "Month", "MillionPesos", digits=digits)
    return pivot_wide(sums, ["Quarter"], "Particulars", "MillionPesos", list(particulars))


def build_ngcor(
    monthly: DataFrame, gdp: DataFrame, particulars: Sequence[str], how: str = "mean",
    digits: int | None = None,
) -> DataFrame:
    """Quarterly cash operations beside output, each also as a four-quarter figure.

    `how` is the four-quarter rule, mean or sum. Quarters without output are dropped last.
    With `digits`, quarterly sums are exact at that precision.
    """
    wide = quarterly_wide(monthly, particulars, digits).join(gdp.select("Quarter", GDP), "Quarter", "left")
    rolled = roll_wide(wide, "Quarter", [*particulars, GDP], 4, how, "4Q")
    return rolled.where(F.col(GDP) > 0)


def _debt_sums(long: DataFrame) -> DataFrame:
    def add(names: tuple[str, ...]):
        def formula(cells: Mapping[str, Column]) -> Column:
            out = cells[names[0]]
            for n in names[1:]:
                out = out + cells[n]
            return out
        return formula

    formulas = {new: add(parts) for new, parts in DEBT_SUMS.items()}
    combined = combine_categories(
        long, ["Month"], "Particulars", "MillionPesos", formulas, DEBT_LINES)
    wide = pivot_wide(combined, ["Month"], "Particulars", "MillionPesos", list(DEBT_SUMS))
    return wide.withColumn("Quarter", quarter_start("Month")).select(
        "Month", "Quarter", *DEBT_SUMS)


def debt_service(monthly: DataFrame) -> DataFrame:
    """Interest payments per quarter and over four quarters."""
    name = "DebtServiceInterestPayment"
    rows = monthly.where(F.col("Particulars") == DEBT_SERVICE)
    wide = to_quarter_sum(rows, [], "Month", "MillionPesos").withColumnRenamed("MillionPesos", name)
    return roll_sum(wide.withColumn("__one", F.lit(1)), ["__one"], "Quarter", name, 4,
                    "DebtService4Q").drop("__one")


def ngdebt_quarterly(monthly: DataFrame, gdp: DataFrame, since: int) -> DataFrame:
    """Debt stocks at quarter ends since a year, with output and debt service.

    The four-quarter output is rolled over the rows of this table, so it starts in its
    fourth quarter.
    """
    rows = to_quarter_end(monthly.where(F.col("Particulars").isin(*DEBT_LINES)), "Month").drop("Quarter")
    wide = _debt_sums(rows).where(F.year("Quarter") >= since)
    both = (wide.join(gdp.select("Quarter", GDP), "Quarter", "left")
            .join(debt_service(monthly), "Quarter", "left").withColumn("__one", F.lit(1)))
    return roll_sum(both, ["__one"], "Month", GDP, 4, GDP + "4Q").drop("__one").where(F.col(GDP) > 0)


def debt_table(monthly: DataFrame, gdp: DataFrame, since: int = 1993) -> DataFrame:
    """Actual obligations, domestic and external debt at quarter ends since a year, beside output.

    The four-quarter output is rolled over the rows of this table; quarters without output stay.
    """
    rows = to_quarter_end(monthly.where(F.col("Particulars").isin(*DEBT_TABLE_LINES)), "Month").drop("Quarter")
    names = [n.replace(" ", "") for n in DEBT_TABLE_LINES]
    wide = pivot_wide(rows.withColumn("Particulars", ident("Particulars")), ["Month"], "Particulars", "MillionPesos", names)
    placed = wide.withColumn("Quarter", quarter_start("Month")).where(F.year("Quarter") >= since)
    both = placed.join(gdp.select("Quarter", GDP), "Quarter", "left").withColumn("__one", F.lit(1))
    return roll_sum(both, ["__one"], "Month", GDP, 4, GDP + "4Q").select("Month", "Quarter", *names, GDP, GDP + "4Q")


def annual_long(raw: DataFrame, first: int) -> DataFrame:
    """Year-end stocks from a table with one column per year."""
    long = unpivot_except(raw, ["Particulars"], "Year", "MillionPesos", as_double)
    year = as_int("Year")
    return long.where(F.col("Particulars").isin(*DEBT_LINES) & (year >= first)).select(
        "Particulars", F.make_date(year, F.lit(12), F.lit(1)).alias("Month"), "MillionPesos")


def ngdebt_annual(
    yearly: DataFrame, monthly: DataFrame, gdp: DataFrame, until_year: int
) -> DataFrame:
    """Year-end debt up to a year; here output is rolled over its own full series."""
    wide = _debt_sums(yearly).where(F.year("Quarter") <= until_year)
    output = roll_sum(gdp.select("Quarter", GDP).withColumn("__one", F.lit(1)),
                      ["__one"], "Quarter", GDP, 4, GDP + "4Q").drop("__one")
    return wide.join(output, "Quarter", "left").join(debt_service(monthly), "Quarter", "left")


def build_ngdebt(
    yearly: DataFrame, monthly: DataFrame, gdp: DataFrame, cut_year: int
) -> DataFrame:
    """Annual stocks before the cut-over year, quarterly ones from it."""
    annual = ngdebt_annual(yearly, monthly, gdp, cut_year - 1)
    quarterly = ngdebt_quarterly(monthly, gdp, cut_year - 1)
    cols = ["Month", "Quarter", *DEBT_SUMS, GDP, GDP + "4Q",
            "DebtServiceInterestPayment", "DebtService4Q"]
    return splice(annual.select(*cols), quarterly.select(*cols), "Month", f"{cut_year}-01-01")


def build_tax(raw: DataFrame, ngcor: DataFrame, particulars: Sequence[str]) -> DataFrame:
    """Tax collections with effort (of output) and share (of revenue).

    The year is taken out of each header; yearly figures stand at October 1 and meet the
    fourth quarter. Four-quarter means times four are yearly totals. Collections come in
    thousands and output in millions; the ratios keep the published units.
    """
    df = raw.withColumnRenamed("Tax Classification", "TaxType")
    long = unpivot_except(df, ["TaxType"], "Header", "Thousands", as_double, {
        "Year": lambda h: F.make_date(extract(h, r"\d{4}").cast("int"), F.lit(10), F.lit(1)),
        "Particular": lambda h: remove_first(h, r"\d{4}\s"),
    })
    wide = pivot_wide(long, ["TaxType", "Year"], "Particular", "Thousands", list(particulars))
    fourth = ngcor.where(F.quarter("Quarter") == 4).select("Quarter", "BIRRevenues4Q", GDP + "4Q")
    joined = wide.withColumn("Quarter", F.col("Year")).join(fourth, "Quarter", "left")
    return joined.withColumns({
        "Effort": ratio("Collection", named(GDP + "4Q") * 4),
        "Share": ratio("Collection", F.col("BIRRevenues4Q") * 4)})
