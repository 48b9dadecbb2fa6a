"""Joins over series and records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import total
from ..operators import joins as J
from ..plans.trade import chapter_label
from .common import HEADINGS, cents, chapter_label_sql, ctes, sql_list, table
from .registry import query

# volumes at returned/kept flags and values by status, months only partly shared
VOL = f"""vol AS (
  SELECT nullif(l_returnflag, 'N') AS k, CAST(date_trunc('month', l_shipdate) AS DATE) AS month,
         {cents('l_quantity')} AS volume FROM lineitem GROUP BY 1, 2)"""
VAL = f"""val AS (
  SELECT CASE o_orderstatus WHEN 'F' THEN 'A' WHEN 'O' THEN NULL ELSE o_orderstatus END AS k,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
         {cents('o_totalprice')} AS amount FROM orders GROUP BY 1, 2)"""


def vol(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").groupBy(
        F.nullif(F.col("l_returnflag"), F.lit("N")).alias("k"),
        F.trunc("l_shipdate", "month").alias("month")).agg(total("l_quantity", 2).alias("volume"))


def val(spark: SparkSession, sf: str) -> DataFrame:
    status = F.col("o_orderstatus")
    k = F.when(status == "F", "A").when(status == "O", None).otherwise(status)
    return table(spark, sf, "orders").groupBy(
        k.alias("k"), F.trunc("o_orderdate", "month").alias("month")).agg(
        total("o_totalprice", 2).alias("amount"))


NATURAL = """
SELECT coalesce(vol.k, val.k) AS k, coalesce(vol.month, val.month) AS month, volume, amount
FROM vol {how} JOIN val ON vol.k IS NOT DISTINCT FROM val.k AND vol.month = val.month"""


@query("j1_natural_left", ctes(VOL, VAL) + NATURAL.format(how="LEFT"))
def j1(spark: SparkSession, sf: str) -> DataFrame:
    return J.natural_join(vol(spark, sf), val(spark, sf), "left")


@query("j2_natural_full", ctes(VOL, VAL) + NATURAL.format(how="FULL"))
def j2(spark: SparkSession, sf: str) -> DataFrame:
    return J.natural_join(vol(spark, sf), val(spark, sf), "full", unique_keys=True)


@query("j3_natural_right", ctes(VOL, VAL) + NATURAL.format(how="RIGHT"))
def j3(spark: SparkSession, sf: str) -> DataFrame:
    return J.natural_join(vol(spark, sf), val(spark, sf), "right")


@query("j4_key_left", f"""
WITH t AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, {cents('o_totalprice')} AS ordered
           FROM orders GROUP BY 1),
s AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, {cents('l_extendedprice')} AS shipped,
             count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY 1)
SELECT year, ordered, shipped, parts FROM t LEFT JOIN s USING (year)""")
def j4(spark: SparkSession, sf: str) -> DataFrame:
    ordered = table(spark, sf, "orders").groupBy(F.year("o_orderdate").alias("year")).agg(
        total("o_totalprice", 2).alias("ordered"))
    shipped = table(spark, sf, "lineitem").groupBy(F.year("l_shipdate").alias("year")).agg(
        total("l_extendedprice", 2).alias("shipped"), F.count_distinct("l_partkey").alias("parts"))
    return J.join_all([ordered, shipped], ["year"])


HEADING_OF = f"{sql_list(HEADINGS)}[p_partkey % {len(HEADINGS)} + 1]"


@query("j5_label_lookup", f"""
SELECT p_partkey, substr({HEADING_OF}, 1, 2) AS chapter,
       {chapter_label_sql(f"substr({HEADING_OF}, 1, 2)")} AS chapter_label
FROM part""")
def j5(spark: SparkSession, sf: str) -> DataFrame:
    heading = F.element_at(
        F.array(*[F.lit(h) for h in HEADINGS]), (F.col("p_partkey") % len(HEADINGS) + 1).cast("int"))
    return table(spark, sf, "part").select(
        "p_partkey", F.substring(heading, 1, 2).alias("chapter")).withColumn(
        "chapter_label", chapter_label("chapter"))


@query("j6_join_all", f"""
WITH a AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, {cents('o_totalprice')} AS ordered
           FROM orders GROUP BY 1),
b AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, {cents('l_extendedprice')} AS shipped
      FROM lineitem GROUP BY 1),
c AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, {cents('l_quantity')} AS returned
      FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1)
SELECT month, ordered, shipped, returned FROM a LEFT JOIN b USING (month) LEFT JOIN c USING (month)""")
def j6(spark: SparkSession, sf: str) -> DataFrame:
    items = table(spark, sf, "lineitem")
    month = F.trunc("l_shipdate", "month").alias("month")
    return J.join_all([
        table(spark, sf, "orders").groupBy(F.trunc("o_orderdate", "month").alias("month")).agg(
            total("o_totalprice", 2).alias("ordered")),
        items.groupBy(month).agg(total("l_extendedprice", 2).alias("shipped")),
        items.where(F.col("l_returnflag") == "R").groupBy(month).agg(
            total("l_quantity", 2).alias("returned")),
    ], ["month"])


@query("j7_anti_semi", """
SELECT 'pending' AS kind, c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)
UNION ALL
SELECT 'member', c_custkey FROM customer WHERE c_custkey IN
  (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')""")
def j7(spark: SparkSession, sf: str) -> DataFrame:
    wanted = table(spark, sf, "customer").select("c_custkey")
    orders = table(spark, sf, "orders").withColumnRenamed("o_custkey", "c_custkey")
    missing = J.pending(wanted, orders, ["c_custkey"])
    member = J.members(wanted, orders.where(F.col("o_orderstatus") == "P"), ["c_custkey"])
    return missing.select(F.lit("pending").alias("kind"), "c_custkey").unionByName(
        member.select(F.lit("member").alias("kind"), "c_custkey"))
