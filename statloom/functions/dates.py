"""Period labels and calendar parts. Dates are always the first day of the period."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .cols import ColumnLike, as_col
from .text import extract

MONTH_NAMES = [
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
]
MONTH_RX = "|".join(MONTH_NAMES)

# strftime-style formats found in headers, and the Spark pattern of each
DATE_PATTERNS = {
    "%Y %b": "yyyy MMM",
    "%B %Y": "MMMM yyyy",
    "%Y-%m-%d": "yyyy-MM-dd",
}


def parse_date(c: ColumnLike, fmt: str) -> Column:
    """Parse by format; text that does not fit becomes NULL."""
    text = F.trim(as_col(c))
    if fmt == "%Y":
        return F.make_date(extract(text, r"^\d{4}$").cast("int"), F.lit(1), F.lit(1))
    return F.try_to_date(text, DATE_PATTERNS[fmt])


def yq(c: ColumnLike) -> Column:
    """`2000 Q1` or `2000Q1` to the first day of that quarter."""
    rx = r"^\s*(\d{4})\D*([1-4])\s*$"
    return quarter_date(extract(c, rx, 1).cast("int"), extract(c, rx, 2).cast("int"))


def quarter_date(year: ColumnLike, quarter: ColumnLike) -> Column:
    return F.make_date(as_col(year), (as_col(quarter) - 1) * 3 + 1, F.lit(1))


def quarter_start(c: ColumnLike) -> Column:
    return F.trunc(as_col(c), "quarter")


def header_year(c: ColumnLike) -> Column:
    """The year in a period header.

    Normally the first four-digit number; a header that starts with a price basis
    (`At Constant 2018 Prices 2003`) carries its year at the end.
    """
    col = as_col(c)
    return (
        F.when(col.startswith("At "), extract(col, r"(\d{4})\s*$", 1))
        .otherwise(extract(col, r"\d{4}"))
        .cast("int")
    )


def period_type(label: ColumnLike) -> Column:
    """Kind of period, by the first rule that fits."""
    c = as_col(label)
    return (
        F.when(c.rlike(r"^Quarter|^Q\d"), "Quarter")
        .when(c.rlike("^Semester"), "Semester")
        .when(c.rlike("to "), "Cumulative")
        .when(c.rlike(MONTH_RX), "Month")
        .when(c.isin("", "Annual"), "Annual")
        .otherwise("Other")
    )


def period_month(label: ColumnLike) -> Column:
    """First month of the period (1-12); NULL where the label fixes none."""
    c = as_col(label)
    kind = period_type(c)
    digit = extract(c, r"\d").cast("int")
    names = F.array(*[F.lit(m) for m in MONTH_NAMES])
    return (
        F.when(kind == "Quarter", (digit - 1) * 3 + 1)
        .when(kind == "Semester", (digit - 1) * 6 + 1)
        .when(kind == "Month", F.array_position(names, F.regexp_extract(c, MONTH_RX, 0)).cast("int"))
        .when(kind == "Annual", F.lit(1))
    )


def period_parse(label: ColumnLike, year: ColumnLike) -> Column:
    """Struct of period type, first month and start date.

    A month outside the calendar gives no date; an unknown month counts as January.
    """
    month = period_month(label)
    used = F.coalesce(month, F.lit(1))
    start = F.when(used.between(1, 12), F.make_date(as_col(year), used, F.lit(1)))
    return F.struct(
        period_type(label).alias("period_type"), month.alias("month"), start.alias("date")
    )


def date_seq(first: ColumnLike, last: ColumnLike, unit: str) -> Column:
    """Array of period starts from `first` to `last`; unit month, quarter or year."""
    step = {"month": "interval 1 month", "quarter": "interval 3 months", "year": "interval 1 year"}[unit]
    return F.sequence(as_col(first), as_col(last), F.expr(step))
