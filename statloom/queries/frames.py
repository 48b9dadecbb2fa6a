"""Projection, predicates, ordering and row binding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import labels as L
from ..functions.numbers import total
from ..operators import frames as O
from ..operators.reshape import unpivot_periods
from .common import GRID, LINES, MONTH, MONTHLY, cents, ctes, lines, monthly, table, wide_monthly
from .registry import query


@query("p1_project", """
SELECT p_name, p_brand, p_partkey, p_type, p_size FROM part""")
def p1(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    cut = O.project(part, span=(1, 5))
    return O.project(cut, first=["p_name", "p_brand"], drop=["p_retailprice", "p_absent"])


@query("p2_rename", """
SELECT s_suppkey AS "id_", s_name AS "label_", s_nationkey AS "s_nationkey_", s_acctbal AS "balance_"
FROM supplier""")
def p2(spark: SparkSession, sf: str) -> DataFrame:
    return O.rename_by(table(spark, sf, "supplier"), names={"s_acctbal": "balance"},
                       positions={1: "id", 2: "label"}, fn=lambda n: f"{n}_")


@query("p3_mutate", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       l_extendedprice * (1 - l_discount) AS net,
       l_extendedprice * (1 - l_discount) * (1 + l_tax) AS gross,
       l_extendedprice * (1 - l_discount) * (1 + l_tax) > 50000 AS is_large
FROM lineitem""")
def p3(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_discount", "l_tax")
    out = O.mutate(
        df, net=F.col("l_extendedprice") * (1 - F.col("l_discount")),
        gross=F.col("net") * (1 + F.col("l_tax")), is_large=F.col("gross") > 50000)
    return O.project(out, drop=["l_extendedprice", "l_discount", "l_tax"])


@query("p4_across", ctes(LINES) + """
SELECT flag, month, quantity, amount, quantity / 1000 AS quantityThousands,
       amount / 1000 AS amountThousands
FROM lines""")
def p4(spark: SparkSession, sf: str) -> DataFrame:
    return O.across(lines(spark, sf), ["quantity", "amount"], lambda c: c / 1000, "{col}Thousands")


@query("p5_filter", """
SELECT o_orderkey, o_orderstatus, CAST(o_orderdate AS DATE) AS order_date FROM orders
WHERE o_totalprice > 0 AND o_orderstatus IN ('F', 'O') AND o_orderpriority IS NOT NULL
  AND o_orderdate > TIMESTAMP '1997-01-01'""")
def p5(spark: SparkSession, sf: str) -> DataFrame:
    df = O.filter_all(
        table(spark, sf, "orders"), F.col("o_totalprice") > 0, F.col("o_orderstatus").isin("F", "O"),
        F.col("o_orderpriority").isNotNull(), F.col("o_orderdate") > F.lit("1997-01-01").cast("timestamp_ntz"))
    return df.select("o_orderkey", "o_orderstatus", F.to_date("o_orderdate").alias("order_date"))


@query("p6_filter_rlike", """
SELECT p_partkey, p_name, p_brand FROM part
WHERE regexp_matches(p_name, 'ring|bolt|widget') AND NOT starts_with(p_brand, 'Brand#1')""")
def p6(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand")
    return O.filter_rlike(O.filter_rlike(df, "p_name", "ring|bolt|widget"), "p_brand", "^Brand#1", keep=False)


@query("p7_until", ctes(MONTHLY) + """
SELECT series, month, amount FROM monthly WHERE month < DATE '2000-07-01'""")
def p7(spark: SparkSession, sf: str) -> DataFrame:
    return O.until(monthly(spark, sf), "month", F.lit("2000-07-19").cast("date")).drop("n")


@query("p8_recode", """
SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'Headline' WHEN '2-HIGH' THEN 'Food'
  ELSE o_orderpriority END AS label
FROM orders""")
def p8(spark: SparkSession, sf: str) -> DataFrame:
    names = {"1-URGENT": "Headline", "2-HIGH": "Food"}
    return table(spark, sf, "orders").select("o_orderkey", L.recode("o_orderpriority", names).alias("label"))


@query("p9_level_rank", """
WITH seen AS (
  SELECT p_type, dense_rank() OVER (ORDER BY min(p_partkey)) AS by_appearance FROM part GROUP BY p_type)
SELECT p_partkey, p_type, CASE p_type WHEN 'SMALL' THEN 1 WHEN 'MEDIUM' THEN 2 WHEN 'LARGE' THEN 3 END
         AS by_levels, CAST(by_appearance AS INTEGER) AS by_appearance
FROM part JOIN seen USING (p_type)""")
def p9(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "part").select("p_partkey", "p_type")
    ranked = O.with_level_rank(df, "p_type", ["SMALL", "MEDIUM", "LARGE"], name="by_levels")
    return O.with_level_rank(ranked, "p_type", order="p_partkey", name="by_appearance")


@query("p10_classify", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CASE WHEN l_quantity >= 40 THEN 'bulk' WHEN l_discount >= 0.08 THEN 'discounted'
            WHEN l_returnflag = 'R' THEN 'returned' ELSE 'plain' END AS kind
FROM lineitem""")
def p10(spark: SparkSession, sf: str) -> DataFrame:
    kind = L.classify([
        (F.col("l_quantity") >= 40, "bulk"), (F.col("l_discount") >= 0.08, "discounted"),
        (F.col("l_returnflag") == "R", "returned")], "plain")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", kind.alias("kind"))


GRID_ROWS = GRID + """,
cells AS (SELECT series, month, amount FROM grid)"""


def grid_rows(spark: SparkSession, sf: str) -> DataFrame:
    return unpivot_periods(wide_monthly(spark, sf), "amount", MONTH).drop("PeriodRaw")


@query("o1_sort_na_last", ctes(GRID_ROWS) + """
SELECT series, month, amount FROM cells ORDER BY month ASC, amount DESC NULLS LAST, series""")
def o1(spark: SparkSession, sf: str) -> DataFrame:
    return O.sort_na_last(grid_rows(spark, sf), "month", "-amount", "series")


@query("o2_head_nth", """
(SELECT 'head' AS pick, o_orderkey, o_totalprice FROM orders
 ORDER BY o_totalprice DESC, o_orderkey LIMIT 6)
UNION ALL
(SELECT 'nth', o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey
 LIMIT 1 OFFSET 9)""")
def o2(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    keys = ("-o_totalprice", "o_orderkey")
    return O.union_labeled({"head": O.head_n(df, 6, *keys), "nth": O.nth(df, 10, *keys)}, "pick").select(
        "pick", "o_orderkey", "o_totalprice")


@query("u1_union_all", ctes(MONTHLY, LINES) + """
SELECT series, month, amount, CAST(NULL AS DOUBLE) AS quantity FROM monthly
UNION ALL SELECT flag, month, amount, quantity FROM lines""")
def u1(spark: SparkSession, sf: str) -> DataFrame:
    return O.union_all([
        monthly(spark, sf).drop("n"), lines(spark, sf).withColumnRenamed("flag", "series")])


@query("u2_union_labeled", ctes(LINES) + """
SELECT flag, month, quantity AS value, 'Volume' AS Indicator FROM lines
UNION ALL SELECT flag, month, amount, 'Value' FROM lines""")
def u2(spark: SparkSession, sf: str) -> DataFrame:
    df = lines(spark, sf)
    pick = lambda c: df.select("flag", "month", F.col(c).alias("value"))
    return O.union_labeled({"Volume": pick("quantity"), "Value": pick("amount")}, "Indicator")


@query("u3_splice", f"""
SELECT CAST(date_trunc('year', o_orderdate) AS DATE) AS period, {cents('o_totalprice')} AS amount
FROM orders GROUP BY 1 HAVING period < DATE '1998-01-01'
UNION ALL
SELECT CAST(date_trunc('quarter', o_orderdate) AS DATE), {cents('o_totalprice')}
FROM orders GROUP BY 1 HAVING CAST(date_trunc('quarter', o_orderdate) AS DATE) >= DATE '1998-01-01'""")
def u3(spark: SparkSession, sf: str) -> DataFrame:
    def by(unit: str) -> DataFrame:
        return table(spark, sf, "orders").groupBy(F.trunc("o_orderdate", unit).alias("period")).agg(
            total("o_totalprice", 2).alias("amount"))

    return O.splice(by("year"), by("quarter"), "period", "1998-01-01")


@query("u4_distinct", """
SELECT DISTINCT l_partkey, l_suppkey FROM lineitem""")
def u4(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select("l_partkey", "l_suppkey").distinct()


@query("u5_by_periodicity", f"""
SELECT 'Annual' AS frame, CAST(date_trunc('year', o_orderdate) AS DATE) AS date,
       {cents('o_totalprice')} AS amount FROM orders GROUP BY 2
UNION ALL
SELECT 'Quarter', CAST(date_trunc('quarter', o_orderdate) AS DATE), {cents('o_totalprice')}
FROM orders GROUP BY 2""")
def u5(spark: SparkSession, sf: str) -> DataFrame:
    def by(unit: str, kind: str) -> DataFrame:
        return table(spark, sf, "orders").groupBy(F.trunc("o_orderdate", unit).alias("date")).agg(
            total("o_totalprice", 2).alias("amount")).withColumn("PeriodType", F.lit(kind))

    mixed = O.union_all([by("year", "Annual"), by("quarter", "Quarter"), by("month", "Month")])
    frames = O.by_periodicity(mixed, ["Annual", "Quarter"])
    return O.union_labeled(frames, "frame").select("frame", "date", "amount")


@query("u6_setdiff", """
SELECT c_custkey, c_acctbal, c_mktsegment FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)""")
def u6(spark: SparkSession, sf: str) -> DataFrame:
    customer = table(spark, sf, "customer")
    keep = O.names_setdiff(customer, ["c_name", "c_nationkey"])
    never = customer.select("c_custkey").subtract(
        table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey")))
    return customer.select(*keep).join(never, "c_custkey", "left_semi")
