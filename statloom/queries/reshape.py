"""Wide-to-long and back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import total
from ..operators import reshape as R
from ..operators.frames import union_labeled
from .common import (
    GRID, LINES, cents, ctes, lines, span, table, wide_monthly,
)
from .registry import query


@query("r1_unpivot_periods", ctes(GRID) + """
SELECT series, strftime(month, '%Y %b') AS "PeriodRaw", amount AS "Value",
       CAST(year(month) AS INTEGER) AS "Yr", strftime(month, '%b') AS "PeriodLabel"
FROM grid""")
def r1(spark: SparkSession, sf: str) -> DataFrame:
    return R.unpivot_periods(wide_monthly(spark, sf))


@query("r2_unpivot_except", ctes(GRID) + """
SELECT series, strftime(month, '%Y %b') AS period, amount FROM grid""")
def r2(spark: SparkSession, sf: str) -> DataFrame:
    return R.unpivot_except(wide_monthly(spark, sf), ["series"], "period", "amount")


@query("r3_pivot_wide", ctes(LINES) + """
SELECT month, max(amount) FILTER (flag = 'A') AS A, max(amount) FILTER (flag = 'N') AS N,
       max(amount) FILTER (flag = 'R') AS R
FROM lines GROUP BY month""")
def r3(spark: SparkSession, sf: str) -> DataFrame:
    return R.pivot_wide(lines(spark, sf), ["month"], "flag", "amount", ["A", "N", "R"])


@query("r4_combine_categories", ctes(LINES) + """,
w AS (SELECT month, max(amount) FILTER (flag = 'A') AS A, max(amount) FILTER (flag = 'N') AS N,
             max(amount) FILTER (flag = 'R') AS R FROM lines GROUP BY month)
SELECT month, 'accepted' AS flag, round(A + N, 2) AS amount FROM w
UNION ALL SELECT month, 'net', round(N - R, 2) FROM w""")
def r4(spark: SparkSession, sf: str) -> DataFrame:
    formulas = {
        "accepted": lambda c: F.round(c["A"] + c["N"], 2), "net": lambda c: F.round(c["N"] - c["R"], 2)}
    return R.combine_categories(lines(spark, sf), ["month"], "flag", "amount", formulas, ["A", "N", "R"])


@query("r5_fill_down", """
SELECT o_orderkey, last_value(CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END IGNORE NULLS)
         OVER (ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS header
FROM orders""")
def r5(spark: SparkSession, sf: str) -> DataFrame:
    sheet = table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).alias("header"))
    return R.fill_down(sheet, "header", "o_orderkey")


@query("r6_split_header_rows", """
WITH sheet AS (
  SELECT o_orderkey, o_totalprice, o_orderstatus = 'F' AS is_header,
         CASE WHEN o_orderstatus = 'F' THEN CAST(year(o_orderdate) AS VARCHAR)
              ELSE strftime(o_orderdate, '%B') END AS label FROM orders),
filled AS (
  SELECT *, last_value(CASE WHEN is_header THEN label END IGNORE NULLS) OVER
         (ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS year FROM sheet)
SELECT o_orderkey, o_totalprice, label, year AS "Year", year || ' ' || substr(label, 1, 3) AS "Period"
FROM filled WHERE NOT is_header""")
def r6(spark: SparkSession, sf: str) -> DataFrame:
    label = F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "yyyy")).otherwise(
        F.date_format("o_orderdate", "MMMM"))
    sheet = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", label.alias("label"))
    return R.split_header_rows(sheet, "label", "o_orderkey")


def chunk(
    spark: SparkSession, sf: str, source: str, date_col: str, key: str, amount: str, name: str,
    levels: list[str],
) -> DataFrame:
    """Yearly sums with one column per year, named after the source."""
    years = F.date_format(date_col, "yyyy")
    rows = table(spark, sf, source).groupBy(F.col(key).alias("label"), years.alias("y")).agg(
        total(amount, 2).alias("v"))
    out = R.pivot_wide(rows, ["label"], "y", "v", levels)
    return out.toDF("label", *[f"{name} {y}" for y in levels])


@query("r7_stitch_columns", f"""
WITH a AS (SELECT o_orderstatus AS label, year(o_orderdate) AS y, {cents('o_totalprice')} AS v
           FROM orders GROUP BY 1, 2),
b AS (SELECT l_returnflag AS label, year(l_shipdate) AS y, {cents('l_extendedprice')} AS v
      FROM lineitem GROUP BY 1, 2),
k AS (SELECT label FROM a UNION SELECT label FROM b)
SELECT k.label, p.period, CASE WHEN p.part = 'orders'
         THEN (SELECT v FROM a WHERE a.label = k.label AND a.y = p.y)
         ELSE (SELECT v FROM b WHERE b.label = k.label AND b.y = p.y) END AS v
FROM k CROSS JOIN (SELECT s.part, y, s.part || ' ' || y AS period
  FROM (VALUES ('orders'), ('lines')) s(part) CROSS JOIN range((SELECT min(y) FROM a), (SELECT max(y) + 1 FROM b)) r(y)) p""")
def r7(spark: SparkSession, sf: str) -> DataFrame:
    last = table(spark, sf, "lineitem").agg(F.max(F.year("l_shipdate"))).first()[0]
    years = [str(y) for y in range(span(spark, sf, "year")[0].year, last + 1)]
    a = chunk(spark, sf, "orders", "o_orderdate", "o_orderstatus", "o_totalprice", "orders", years)
    b = chunk(spark, sf, "lineitem", "l_shipdate", "l_returnflag", "l_extendedprice", "lines", years)
    return R.unpivot_except(R.stitch_columns([a, b], ["label"]), ["label"], "period", "v", None)


@query("r8_split_range", ctes(GRID) + """,
cut AS (SELECT min(month) AS lo, max(month) AS hi FROM grid)
SELECT 'early' AS part, series, strftime(month, '%Y %b') AS period, cell FROM grid
WHERE month < DATE '1998-01-01'
UNION ALL
SELECT 'late', series, strftime(month, '%Y %b'), cell FROM grid WHERE month >= DATE '1998-01-01'""")
def r8(spark: SparkSession, sf: str) -> DataFrame:
    df = wide_monthly(spark, sf)
    periods = R.period_columns(df.columns)
    early, late = R.split_range(
        df, ["series"], [(periods[0], "1997 Dec"), ("1998 Jan", periods[-1])])
    melt = lambda d: R.unpivot_except(d, ["series"], "period", "cell", None)
    return union_labeled({"early": melt(early), "late": melt(late)}, "part").select(
        "part", "series", "period", "cell")
