"""Marginals, rollups, downsampling, audits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import round_even, total
from ..operators import aggs as A
from ..operators.frames import top_partners, union_all
from ..plans import trade as T
from ..plans import trade_values as V
from .common import (
    ANNUAL, COMMODITY, FACT, MONTHLY, PARTNER, cents, ctes, monthly, sql_in, table, trade_fact,
)
from .registry import query

def marginal_specs() -> dict[str, A.Marginal]:
    """The five marginals of the trade records: partners, commodities, partners by chapter, and two slices of products."""
    return {
        "partner": A.Marginal(["year", "direction", "country"]),
        "commodity": A.Marginal(["year", "direction", "classification", "code"]),
        "partner_chapter": A.Marginal(["year", "direction", "country", "chapter"], F.col("classification") == "HS"),
        "semiconductors": A.Marginal(["year", "direction", "country"], T.semi_heading("heading")),
        "minerals": A.Marginal(["year", "direction", "country", "heading"], T.mineral_heading("heading")),
    }


MARGINAL_SQL = f"""
coded AS (
  SELECT *, CASE WHEN length(code) >= 10 THEN 'HS' ELSE 'PSCC' END AS classification,
         CASE WHEN length(code) >= 10 THEN substr(code, 1, 4) END AS heading FROM fact WHERE value > 0),
marginal AS (
  SELECT 'partner' AS marginal, year, direction, country, CAST(NULL AS VARCHAR) AS classification, CAST(NULL AS VARCHAR) AS code,
         CAST(NULL AS VARCHAR) AS chapter, CAST(NULL AS VARCHAR) AS heading, {cents('value')} AS value FROM coded GROUP BY ALL
  UNION ALL SELECT 'commodity', year, direction, NULL, classification, code, NULL, NULL, {cents('value')} FROM coded GROUP BY ALL
  UNION ALL SELECT 'partner_chapter', year, direction, country, NULL, NULL, substr(heading, 1, 2), NULL, {cents('value')}
  FROM coded WHERE classification = 'HS' GROUP BY ALL
  UNION ALL SELECT 'semiconductors', year, direction, country, NULL, NULL, NULL, NULL, {cents('value')}
  FROM coded WHERE heading IN {sql_in(V.SEMI_PREFIXES)} GROUP BY ALL
  UNION ALL SELECT 'minerals', year, direction, country, NULL, NULL, NULL, heading, {cents('value')}
  FROM coded WHERE substr(heading, 1, 2) IN {sql_in(V.MINERAL_CHAPTERS)} OR heading IN {sql_in(V.MINERAL_HEADINGS)} GROUP BY ALL)"""


def five_marginals(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """All five from one pass over the records."""
    rows = trade_fact(spark, sf).where(F.col("value") > 0).withColumns({
        "classification": T.classification("code"),
        "heading": F.when(T.classification("code") == "HS", F.substring("code", 1, 4)),
    })
    rows = rows.withColumn("chapter", F.substring("heading", 1, 2))
    return A.marginals(rows, marginal_specs(), "value", 2)


@query("a1_marginals", ctes(FACT, MARGINAL_SQL) + """
SELECT * FROM marginal""")
def a1(spark: SparkSession, sf: str) -> DataFrame:
    return union_all([df.withColumn("marginal", F.lit(n)) for n, df in five_marginals(spark, sf).items()])


def partner(spark: SparkSession, sf: str) -> DataFrame:
    return T.partner_table(T.trade_leaf(trade_fact(spark, sf)))


@query("a2_rollup_from", ctes(PARTNER) + """
SELECT year, direction, region, sum(value_usd) AS value_usd FROM partner GROUP BY ALL""")
def a2(spark: SparkSession, sf: str) -> DataFrame:
    return A.rollup_from(partner(spark, sf), ["year", "direction", "region"])


@query("a3_annual_balance", f"""
WITH d AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS year,
             CASE l_linestatus WHEN 'O' THEN 'Exports' ELSE 'Imports' END AS direction,
             round_even({cents('l_extendedprice')}, 0) AS v FROM lineitem GROUP BY 1, 2),
w AS (SELECT year, sum(v) FILTER (direction = 'Exports') AS Exports,
             sum(v) FILTER (direction = 'Imports') AS Imports FROM d GROUP BY year)
SELECT year, Exports, Imports, Exports - Imports AS balance, Exports + Imports AS total_trade FROM w""")
def a3(spark: SparkSession, sf: str) -> DataFrame:
    direction = F.when(F.col("l_linestatus") == "O", "Exports").otherwise("Imports")
    sums = table(spark, sf, "lineitem").groupBy(
        F.year("l_shipdate").alias("year"), direction.alias("direction")).agg(
        round_even(total("l_extendedprice", 2)).alias("value_usd"))
    return A.annual_balance(sums)


@query("a4_to_quarter_sum", f"""
SELECT o_orderpriority || '/' || o_orderstatus AS series,
       CAST(date_trunc('quarter', o_orderdate) AS DATE) AS "Quarter", {cents('o_totalprice')} AS amount
FROM orders GROUP BY 1, 2""")
def a4(spark: SparkSession, sf: str) -> DataFrame:
    return A.to_quarter_sum(monthly(spark, sf), ["series"], "month", "amount", digits=2)


@query("a5_to_quarter_end", ctes(MONTHLY) + """
SELECT series, month, amount, n, CAST(date_trunc('quarter', month) AS DATE) AS "Quarter"
FROM monthly WHERE month(month) IN (3, 6, 9, 12)""")
def a5(spark: SparkSession, sf: str) -> DataFrame:
    return A.to_quarter_end(monthly(spark, sf), "month")


@query("a6_n_distinct", """
WITH x AS (SELECT *, nullif(l_returnflag, 'N') AS flag FROM lineitem)
SELECT l_linestatus, count(DISTINCT l_partkey) AS parts,
       count(DISTINCT flag) + max(CAST(flag IS NULL AS BIGINT)) AS flags
FROM x GROUP BY l_linestatus""")
def a6(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "lineitem").withColumn("flag", F.nullif(F.col("l_returnflag"), F.lit("N")))
    return df.groupBy("l_linestatus").agg(
        A.n_distinct("l_partkey").alias("parts"), A.n_distinct("flag").alias("flags"))


@query("a6_distinct_sketches", ctes(FACT) + """
SELECT year, count(DISTINCT code) AS codes, true AS merged_near, true AS parts_near FROM fact GROUP BY year""")
def a6_sketches(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct codes of a year, exactly and from merged sketches of its directions: both within 4 standard errors."""
    rows = trade_fact(spark, sf)
    parts = rows.groupBy("year", "direction").agg(A.distinct_sketch("code").alias("sketch"), A.n_distinct("code").alias("codes"))
    near = lambda estimate, exact: F.abs(estimate - exact) <= F.greatest(F.lit(1.0), exact * 4 * 0.013)
    parts = parts.withColumn("near", near(A.sketch_count("sketch"), F.col("codes")))
    merged = parts.groupBy("year").agg(A.sketch_count(A.merged_sketch("sketch")).alias("estimate"), F.every("near").alias("parts_near"))
    exact = rows.groupBy("year").agg(A.n_distinct("code").alias("codes"))
    return exact.join(merged, "year").select("year", "codes", near(F.col("estimate"), F.col("codes")).alias("merged_near"), "parts_near")


@query("a7_share_where", """
SELECT l_suppkey, round(CAST(coalesce(sum(CAST(l_extendedprice AS DECIMAL(18,2)))
         FILTER (l_returnflag = 'R'), 0) AS DOUBLE)
       / CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE), 9) AS share
FROM lineitem GROUP BY l_suppkey""")
def a7(spark: SparkSession, sf: str) -> DataFrame:
    share = A.share_where(F.col("l_returnflag") == "R", "l_extendedprice")
    return table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.round(share, 9).alias("share"))


@query("a8_arg_max", """
WITH y AS (SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS year, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS q
           FROM lineitem GROUP BY 1, 2)
SELECT l_suppkey, arg_min(year, (-q) * 10000 + year) AS best_year, min(q) AS least, max(q) AS most,
       arg_max(q, year) AS latest
FROM y GROUP BY l_suppkey""")
def a8(spark: SparkSession, sf: str) -> DataFrame:
    y = table(spark, sf, "lineitem").groupBy("l_suppkey", F.year("l_shipdate").alias("year")).agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("q"))
    return y.groupBy("l_suppkey").agg(
        A.arg_max("year", "q").alias("best_year"), F.min("q").alias("least"), F.max("q").alias("most"),
        F.max_by("q", "year").alias("latest"))


@query("a9_code_profile", """
WITH u AS (SELECT CAST(year(o_orderdate) AS VARCHAR) AS file, CAST(o_custkey AS VARCHAR) AS code,
             min(o_orderkey) AS f FROM orders GROUP BY 1, 2),
h AS (SELECT file, length(code) AS len, count(*) AS n FROM u GROUP BY 1, 2),
s AS (SELECT *, row_number() OVER (PARTITION BY file ORDER BY f, code) AS k FROM u)
SELECT file, CAST(sum(n) AS BIGINT) AS n_codes, string_agg(len || ':' || n, ', ' ORDER BY len) AS length_dist,
       (SELECT string_agg(code, ', ' ORDER BY k) FROM s WHERE s.file = h.file AND k <= 6) AS samples
FROM h GROUP BY file""")
def a9(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "orders").select(
        F.date_format("o_orderdate", "yyyy").alias("file"), F.col("o_custkey").cast("string").alias("code"),
        "o_orderkey")
    return A.code_profile(df, "code", "file", "o_orderkey")


@query("a10_coverage_audit", ctes(PARTNER, COMMODITY, ANNUAL) + """
SELECT a.year, round_even(Exports / 1e9, 1) AS "exports_B", round_even(Imports / 1e9, 1) AS "imports_B",
       countries, codes, round_even(100.0 * total / (Exports + Imports), 1) AS commodity_cover
FROM annual a
LEFT JOIN (SELECT year, count(DISTINCT country) AS countries FROM partner GROUP BY year) p USING (year)
LEFT JOIN (SELECT year, count(DISTINCT code) AS codes, sum(value_usd) AS total
           FROM commodity GROUP BY year) c USING (year)""")
def a10(spark: SparkSession, sf: str) -> DataFrame:
    t = T.build_trade(trade_fact(spark, sf))
    return A.coverage_audit(t["trade_annual"], t["trade_by_partner"], t["trade_by_commodity"])


@query("a11_reconcile", ctes(FACT, MARGINAL_SQL) + """,
p AS (SELECT year, direction, country, round_even(value, 0) AS v FROM marginal WHERE marginal = 'partner'),
c AS (SELECT year, direction, code, round_even(value, 0) AS v FROM marginal WHERE marginal = 'commodity'),
g AS (SELECT year, direction, country, chapter, round_even(value, 0) AS v FROM marginal WHERE marginal = 'partner_chapter'),
h AS (SELECT year, direction, code, round_even(value, 0) AS v FROM marginal WHERE marginal = 'commodity' AND classification = 'HS'),
sides AS (
  SELECT 'partner and commodity' AS pair, year, direction, sum(v) FILTER (s = 1) AS left_total, sum(v) FILTER (s = 2) AS right_total, count(*) AS n
  FROM (SELECT year, direction, v, 1 AS s FROM p UNION ALL SELECT year, direction, v, 2 FROM c) GROUP BY ALL
  UNION ALL
  SELECT 'chapter and code', year, direction, sum(v) FILTER (s = 1), sum(v) FILTER (s = 2), count(*)
  FROM (SELECT year, direction, v, 1 AS s FROM g UNION ALL SELECT year, direction, v, 2 FROM h) GROUP BY ALL)
SELECT pair, year, direction, left_total, right_total,
       abs(coalesce(left_total, 0) - coalesce(right_total, 0)) AS gap,
       abs(coalesce(left_total, 0) - coalesce(right_total, 0)) <= 0.5 * n AS agrees
FROM sides""")
def a11(spark: SparkSession, sf: str) -> DataFrame:
    """Partners against commodities, and partner chapters against HS codes: both from the marginals' one pass."""
    parts = {n: df.withColumn("value", round_even("value")) for n, df in five_marginals(spark, sf).items()}
    by, none = ["year", "direction"], None
    pairs = {
        "partner and commodity": (parts["partner"], parts["commodity"]),
        "chapter and code": (parts["partner_chapter"], parts["commodity"].where("classification = 'HS'")),
    }
    return union_all([
        A.reconcile(a, b, by, "value", none).withColumn("pair", F.lit(n)) for n, (a, b) in pairs.items()])


SHARES = """,
shares AS (SELECT year, coalesce(sum(value_usd) FILTER (is_resid), 0) / nullif(sum(value_usd), 0) AS share FROM partner GROUP BY year)"""


@query("a11_residual_share", ctes(PARTNER) + SHARES + """
SELECT year, share FROM shares""")
def a11_shares(spark: SparkSession, sf: str) -> DataFrame:
    return A.residual_share(partner(spark, sf))


@query("a11_residual_summary", ctes(PARTNER) + SHARES + """
SELECT max(share) AS max_share, (SELECT min(year) FROM shares WHERE share = (SELECT max(share) FROM shares)) AS max_year,
       max(year) AS last_year, arg_max(share, year) AS last_share FROM shares""")
def a11_summary(spark: SparkSession, sf: str) -> DataFrame:
    return A.residual_summary(A.residual_share(partner(spark, sf)))


@query("o3_top_partners", ctes(PARTNER) + """
SELECT year, direction, country, value_usd, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY year, direction ORDER BY value_usd DESC, country)
                 AS INTEGER) AS rank
  FROM partner WHERE NOT is_resid)
WHERE rank <= 5""")
def o3(spark: SparkSession, sf: str) -> DataFrame:
    top = top_partners(partner(spark, sf), 5, ["year", "direction"], "value_usd", "country", "is_resid")
    return top.select("year", "direction", "country", "value_usd", "rank")
