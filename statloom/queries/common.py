"""Inputs of the registered queries, derived from the given tables, in Spark and in SQL.

The SQL texts are common table expressions to be put behind WITH.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import parse_date
from ..functions.numbers import total
from ..plans import trade_values as V


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def ctes(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def sql_list(values: Sequence[str]) -> str:
    return "[" + ", ".join(sql_text(v) for v in values) + "]"


def sql_in(values: Sequence[str]) -> str:
    return "(" + ", ".join(sql_text(v) for v in values) + ")"


def sql_text(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def cents(col: str) -> str:
    """Exact sum of an amount with two decimals."""
    return f"CAST(sum(CAST({col} AS DECIMAL(18,2))) AS DOUBLE)"


# -- monthly series: orders by priority and status -------------------------------------

MONTHLY = f"""monthly AS (
  SELECT o_orderpriority || '/' || o_orderstatus AS series,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
         {cents('o_totalprice')} AS amount, count(*) AS n
  FROM orders GROUP BY 1, 2)"""

GRID = MONTHLY + """,
months AS (
  SELECT CAST(unnest(generate_series((SELECT min(month) FROM monthly),
         (SELECT max(month) FROM monthly), INTERVAL 1 MONTH)) AS DATE) AS month),
grid AS (
  SELECT s.series, m.month, y.amount, CAST(CAST(y.amount AS DECIMAL(18,2)) AS VARCHAR) AS cell
  FROM (SELECT DISTINCT series FROM monthly) s CROSS JOIN months m
  LEFT JOIN monthly y ON y.series = s.series AND y.month = m.month)"""


def monthly(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    return orders.groupBy(
        F.concat_ws("/", "o_orderpriority", "o_orderstatus").alias("series"),
        F.trunc("o_orderdate", "month").alias("month"),
    ).agg(total("o_totalprice", 2).alias("amount"), F.count("*").alias("n"))


def span(
    spark: SparkSession, sf: str, unit: str = "month", name: str = "orders",
    col: str = "o_orderdate",
) -> list[date]:
    """Calendar of a date column, from the first to the last period."""
    lo, hi = table(spark, sf, name).agg(
        F.trunc(F.min(col), unit), F.trunc(F.max(col), unit)).first()
    step = {"month": 1, "quarter": 3, "year": 12}[unit]
    out, at = [], lo
    while at <= hi:
        out.append(at)
        months = at.year * 12 + at.month - 1 + step
        at = date(months // 12, months % 12 + 1, 1)
    return out


def cell_text(c: Column) -> Column:
    return c.cast("decimal(18,2)").cast("string")


# date of a month column, taken from its header
MONTH = {"month": lambda h: parse_date(h, "%Y %b")}

MONTH_ABBR = {
    "%Y %b": "yyyy MMM",
    "%B %Y": "MMMM yyyy",
}


def wide(
    rows: DataFrame, keys: Sequence[str], month: str, value: Column, labels: Sequence[str],
    label: Column,
) -> DataFrame:
    """One column per label, in the given order."""
    return rows.withColumn("__label", label).withColumn("__value", value).groupBy(*keys).pivot(
        "__label", list(labels)).agg(F.first("__value", ignorenulls=True))


def wide_monthly(spark: SparkSession, sf: str, fmt: str = "%Y %b") -> DataFrame:
    """Monthly series with one text column per month."""
    labels = [d.strftime(fmt) for d in span(spark, sf)]
    rows = monthly(spark, sf)
    return wide(rows, ["series"], "month", cell_text(F.col("amount")), labels,
                F.date_format("month", MONTH_ABBR[fmt]))


# -- line items by month and flag ------------------------------------------------------

LINES = f"""lines AS (
  SELECT l_returnflag AS flag, CAST(date_trunc('month', l_shipdate) AS DATE) AS month,
         {cents('l_quantity')} AS quantity, {cents('l_extendedprice')} AS amount
  FROM lineitem GROUP BY 1, 2)"""


def lines(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").groupBy(
        F.col("l_returnflag").alias("flag"), F.trunc("l_shipdate", "month").alias("month"),
    ).agg(total("l_quantity", 2).alias("quantity"), total("l_extendedprice", 2).alias("amount"))


# -- quarterly output ------------------------------------------------------------------

GDP = f"""gdp AS (
  SELECT CAST(date_trunc('quarter', l_shipdate) AS DATE) AS Quarter,
         {cents('l_extendedprice')} AS NominalGDP
  FROM lineitem GROUP BY 1)"""


def gdp(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").groupBy(
        F.trunc("l_shipdate", "quarter").alias("Quarter")
    ).agg(total("l_extendedprice", 2).alias("NominalGDP"))


# -- trade records: line items with partner and commodity labels -------------------------

# raw labels given to the nations, in the spellings that the country rules must handle
COUNTRY_LABELS = [
    "United States of America 1/", "Japan (excludes  Okinawa)", "China, People's Republic of",
    "Korea, Republic of", "Korea, Dem. People's Rep. (North)", "Hong Kong 2/",
    "Taiwan, Republic of China", "Germany, Federal Republic of", "Germany, Opt. Ctry",
    "Viet Nam", "Singapore", "Lao People's Dem. Rep.", "Netherlands", "Netherlands Antilles",
    "Romania", "Oman", "British Indian Ocean Territory", "India", "Saudi Arabia",
    "United Arab Emirates, N.E.S.", "Australia.", "Canada", "South and Southeast Asia, N.E.S.",
    "Brazil", "U.K.",
]

# first four digits given to the harmonised codes: all groups, all minerals, an unlisted chapter
HEADINGS = [
    "0105", "0203", "0811", "1006", "1511", "1701", "2203", "2402", "2501", "2601", "2710",
    "2801", "3004", "3901", "4011", "4104", "4407", "4703", "5208", "6109", "6403", "6802",
    "7102", "7108", "7204", "7403", "7502", "7601", "7701", "7801", "7901", "8001", "8471",
    "8541", "8542", "8703", "8802", "9018", "9503", "0000",
]

COUNTRY_OF = f"{sql_list(COUNTRY_LABELS)}[n_nationkey + 1]"

FACT = f"""fact AS (
  SELECT CAST(year(l_shipdate) AS INTEGER) AS year,
         CASE l_linestatus WHEN 'O' THEN 'Exports' ELSE 'Imports' END AS direction,
         {COUNTRY_OF} AS country,
         CASE WHEN year(l_shipdate) >= 1998
              THEN {sql_list(HEADINGS)}[l_partkey % {len(HEADINGS)} + 1]
                   || lpad(CAST(l_partkey % 1000000 AS VARCHAR), 6, '0')
              ELSE lpad(CAST(l_partkey AS VARCHAR), 7, '0') END AS code,
         l_extendedprice AS value
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""


def country_label(nation_key: str = "n_nationkey") -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in COUNTRY_LABELS]), F.col(nation_key) + 1)


def nation_labels(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "nation").select("n_nationkey", country_label().alias("country"))


def trade_fact(spark: SparkSession, sf: str) -> DataFrame:
    """Leaf trade records.

    Orders get their country first, so the line items, the largest table, are shuffled
    once, on the order key.
    """
    who = (
        table(spark, sf, "orders").select("o_orderkey", "o_custkey")
        .join(table(spark, sf, "customer").select("c_custkey", "c_nationkey"),
              F.col("o_custkey") == F.col("c_custkey"))
        .join(nation_labels(spark, sf), F.col("c_nationkey") == F.col("n_nationkey"))
        .select("o_orderkey", "country"))
    year = F.year("l_shipdate")
    part = F.col("l_partkey")
    heading = F.element_at(
        F.array(*[F.lit(h) for h in HEADINGS]), (part % len(HEADINGS) + 1).cast("int"))
    hs = F.concat(heading, F.lpad((part % 1_000_000).cast("string"), 6, "0"))
    return (
        table(spark, sf, "lineitem")
        .select("l_orderkey", "l_partkey", "l_linestatus", "l_shipdate", "l_extendedprice")
        .join(who, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            year.alias("year"),
            F.when(F.col("l_linestatus") == "O", "Exports").otherwise("Imports").alias("direction"),
            "country",
            F.when(year >= 1998, hs).otherwise(F.lpad(part.cast("string"), 7, "0")).alias("code"),
            F.col("l_extendedprice").alias("value")))


def squish_sql(x: str) -> str:
    return f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"


def clean_country_sql(x: str) -> str:
    y = squish_sql(f"upper({x})")
    y = f"regexp_replace({y}, '\\s*\\d+/\\s*$', '', 'g')"
    return squish_sql(f"regexp_replace({y}, '[.,]+$', '', 'g')")


def canon_sql(x: str) -> str:
    """CASE expression over a cleaned label column."""
    out = ["CASE"]
    for rx, exact, unless, also, result in V.COUNTRY_RULES:
        cond = f"regexp_matches({x}, {sql_text(rx)})"
        if exact:
            cond = f"({cond} OR {x} IN {sql_in(exact)})"
        if also:
            cond += f" AND regexp_matches({x}, {sql_text(also)})"
        if unless:
            cond += f" AND NOT regexp_matches({x}, {sql_text(unless)})"
        out.append(f"WHEN {cond} THEN {sql_text(result)}")
    return "\n".join([*out, f"ELSE {x} END"])


def europe_sql(x: str) -> str:
    return (f"(regexp_matches({x}, {sql_text(V.EUROPE_RX)}) AND NOT "
            f"regexp_matches({x}, {sql_text(V.EUROPE_NOT_RX)}))")


def region_sql(x: str) -> str:
    return f"""CASE WHEN {europe_sql(x)} THEN 'Europe'
      WHEN {x} IN {sql_in(V.EAST_ASIA)} THEN 'East Asia' WHEN {x} IN {sql_in(V.ASEAN)} THEN 'ASEAN'
      WHEN {x} IN {sql_in(V.NORTH_AMERICA)} THEN 'North America'
      WHEN {x} IN {sql_in(V.OCEANIA)} THEN 'Oceania'
      WHEN regexp_matches({x}, {sql_text(V.MIDDLE_EAST_RX)}) THEN 'Middle East'
      WHEN regexp_matches({x}, {sql_text(V.SOUTH_ASIA_RX)}) THEN 'South Asia'
      ELSE 'Rest of world' END"""


def residual_sql(x: str) -> str:
    return (f"(regexp_matches(upper({x}), {sql_text(V.RESIDUAL_RX)}) AND NOT "
            f"regexp_matches(upper({x}), {sql_text(V.RESIDUAL_NOT_RX)}))")


def group_sql(chapter: str) -> str:
    whens = " ".join(
        f"WHEN {chapter} BETWEEN {a} AND {b} THEN {sql_text(g)}" for a, b, g in V.CHAPTER_GROUPS)
    return f"CASE {whens} ELSE {sql_text(V.NO_GROUP)} END"


def chapter_label_sql(chapter: str) -> str:
    whens = " ".join(f"WHEN {sql_text(k)} THEN {sql_text(v)}" for k, v in V.CHAPTER_LABELS.items())
    return f"CASE {chapter} {whens} ELSE 'Chapter ' || {chapter} END"


def mineral_sql(code: str) -> str:
    whens = " ".join(
        f"WHEN starts_with({code}, {sql_text(p)}) THEN {sql_text(t)}" for p, t in V.MINERAL_TYPES)
    return f"CASE {whens} ELSE {sql_text(V.OTHER_MINERAL)} END"


# leaf records with every label and flag
LABELLED = FACT + f""",
cleaned AS (SELECT *, {clean_country_sql('country')} AS label FROM fact WHERE value > 0),
canon AS (SELECT * RENAME (country AS raw), {canon_sql('label')} AS country FROM cleaned),
labelled AS (
  SELECT *, {region_sql('country')} AS region, {europe_sql('country')} AS is_europe,
         country IN {sql_in(V.ASEAN)} AS is_asean, {residual_sql('raw')} AS is_resid,
         CASE WHEN length(code) >= 10 THEN 'HS' ELSE 'PSCC' END AS classification,
         CASE WHEN length(code) >= 10 THEN substr(code, 1, 6) ELSE code END AS code_key,
         CASE WHEN length(code) >= 10
              THEN {group_sql("CAST(substr(code, 1, 2) AS INTEGER)")} END AS "group",
         length(code) >= 10 AND substr(code, 1, 4) IN {sql_in(V.SEMI_PREFIXES)} AS is_semi,
         length(code) >= 10 AND (substr(code, 1, 2) IN {sql_in(V.MINERAL_CHAPTERS)}
              OR substr(code, 1, 4) IN {sql_in(V.MINERAL_HEADINGS)}) AS is_mineral
  FROM canon)"""

USD = f"round_even({cents('value')}, 0)"

PARTNER = LABELLED + f""",
partner AS (
  SELECT year, direction, country, region, is_europe, is_asean, is_resid, {USD} AS value_usd
  FROM labelled GROUP BY ALL)"""

COMMODITY = f"""commodity0 AS (
  SELECT year, direction, classification, code_key AS code, {USD} AS value_usd
  FROM labelled GROUP BY ALL),
commodity AS (
  SELECT year, direction, classification, code,
         CASE WHEN classification = 'HS' THEN substr(code, 1, 2) END AS chapter,
         CASE WHEN classification = 'HS' THEN {chapter_label_sql('substr(code, 1, 2)')} END
           AS chapter_label,
         CASE WHEN classification = 'HS'
              THEN {group_sql('TRY_CAST(substr(code, 1, 2) AS INTEGER)')} END AS "group",
         value_usd
  FROM commodity0)"""

ANNUAL = """annual AS (
  SELECT year, sum(value_usd) FILTER (direction = 'Exports') AS Exports,
         sum(value_usd) FILTER (direction = 'Imports') AS Imports
  FROM partner GROUP BY year)"""
