"""Growth, rolling figures, unique names and picks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import total
from ..operators import windows as W
from ..operators.reshape import pivot_wide, unpivot_periods
from .common import GRID, LINES, MONTH, cents, ctes, lines, table, wide_monthly
from .registry import query


def cells(spark: SparkSession, sf: str) -> DataFrame:
    return unpivot_periods(wide_monthly(spark, sf), "amount", MONTH).drop("PeriodRaw")


@query("w1_yoy", ctes(GRID) + """
SELECT series, month, amount, amount / nullif(lag(amount, 12) OVER w, 0) - 1 AS growth
FROM grid WINDOW w AS (PARTITION BY series ORDER BY month)""")
def w1(spark: SparkSession, sf: str) -> DataFrame:
    return W.yoy(cells(spark, sf), ["series"], "month", "amount", 12, "growth")


@query("w2_yoy_many", ctes(LINES) + """
SELECT flag, month, quantity, amount,
       quantity / nullif(lag(quantity, 4) OVER w, 0) - 1 AS quantityGrowth,
       amount / nullif(lag(amount, 4) OVER w, 0) - 1 AS amountGrowth
FROM lines WINDOW w AS (PARTITION BY flag ORDER BY month)""")
def w2(spark: SparkSession, sf: str) -> DataFrame:
    return W.yoy_many(lines(spark, sf), ["flag"], "month", ["quantity", "amount"], 4)


@query("w3_yoy_single", f"""
WITH one AS (
  SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, {cents('l_extendedprice')} AS amount
  FROM lineitem GROUP BY 1)
SELECT 'all' AS series, o.month, o.amount, o.amount / nullif(b.amount, 0) - 1 AS growth
FROM one o LEFT JOIN one b ON b.month = o.month - INTERVAL 12 MONTH""")
def w3(spark: SparkSession, sf: str) -> DataFrame:
    one = table(spark, sf, "lineitem").groupBy(F.trunc("l_shipdate", "month").alias("month")).agg(
        total("l_extendedprice", 2).alias("amount")).select(
        F.lit("all").alias("series"), "month", "amount")
    return W.yoy(one, ["series"], "month", "amount", 12, "growth", calendar="month")


@query("w4_roll_sum", ctes(GRID) + """
SELECT series, month, amount, CASE WHEN count(amount) OVER w = 4
       THEN round(sum(amount) OVER w, 2) END AS amount4
FROM grid WINDOW w AS (PARTITION BY series ORDER BY month ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)""")
def w4(spark: SparkSession, sf: str) -> DataFrame:
    return W.roll_sum(cells(spark, sf), ["series"], "month", "amount", 4, "amount4").withColumn(
        "amount4", F.round("amount4", 2))


@query("w5_roll_mean", ctes(LINES) + """,
wide AS (SELECT month, sum(amount) FILTER (flag = 'A') AS A, sum(amount) FILTER (flag = 'N') AS N,
                sum(amount) FILTER (flag = 'R') AS R FROM lines GROUP BY month)
SELECT month, A, N, R,
       CASE WHEN count(A) OVER w = 4 THEN round(avg(A) OVER w, 4) END AS A4Q,
       CASE WHEN count(N) OVER w = 4 THEN round(avg(N) OVER w, 4) END AS N4Q,
       CASE WHEN count(R) OVER w = 4 THEN round(avg(R) OVER w, 4) END AS R4Q
FROM wide WINDOW w AS (ORDER BY month ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)""".replace("\n,", ",", 1))
def w5(spark: SparkSession, sf: str) -> DataFrame:
    wide = pivot_wide(lines(spark, sf), ["month"], "flag", "amount", ["A", "N", "R"])
    rolled = W.roll_wide(wide, "month", ["A", "N", "R"], 4, "mean", "4Q")
    return rolled.withColumns({f"{c}4Q": F.round(f"{c}4Q", 4) for c in "ANR"})


@query("w6_make_unique", """
WITH ranked AS (SELECT p_partkey, p_name, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS k
                FROM part)
SELECT p_partkey, CASE WHEN k > 1 THEN p_name || '-' || (k - 1) ELSE p_name END AS p_name FROM ranked""")
def w6(spark: SparkSession, sf: str) -> DataFrame:
    return W.make_unique(table(spark, sf, "part").select("p_partkey", "p_name"), "p_name", "p_partkey")


@query("w7_pick_spread", """
WITH ranked AS (
  SELECT o_orderstatus, o_orderkey, row_number() OVER w AS position,
         count(*) OVER (PARTITION BY o_orderstatus) AS n
  FROM orders WINDOW w AS (PARTITION BY o_orderstatus ORDER BY o_orderkey))
SELECT o_orderstatus, o_orderkey, position FROM ranked WHERE position IN (1, (n + 1) // 2, n)""")
def w7(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "orders").select("o_orderstatus", "o_orderkey")
    return W.pick_spread(df, ["o_orderstatus"], "o_orderkey")
