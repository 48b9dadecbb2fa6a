"""Subject tables, from inputs of the published shapes that Spark derives from the tables."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import total
from ..operators.frames import union_all
from ..operators.joins import natural_join
from ..operators.reshape import pivot_wide
from ..plans import accounts as NA
from ..plans import agri as AG
from ..plans import fiscal as FI
from ..plans import prices as PR
from ..plans import publish as PU
from ..plans import social as SO
from ..plans import trade as T
from ..plans import trade_values as V
from ..sources.sinks import read_version
from ..sources.workspace import fresh_dir, stage
from .common import (
    ANNUAL, COMMODITY, COUNTRY_OF, FACT, GDP, LABELLED, PARTNER, USD, canon_sql, cell_text, cents,
    chapter_label_sql, clean_country_sql, country_label, ctes, europe_sql, gdp, group_sql,
    mineral_sql, region_sql, residual_sql, span, sql_in, sql_list, table, trade_fact, wide,
)
from .contents import contents, contents_sql
from .registry import query
from .scans import csv_out, landed_vintages

# -- label and code rules over every customer and every trade record ------------------------

CUSTOMER_LABELS = f"""raw AS (SELECT c_custkey, {COUNTRY_OF} AS raw
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
lab AS (SELECT *, {clean_country_sql('raw')} AS y FROM raw),
can AS (SELECT c_custkey, raw, {canon_sql('y')} AS country FROM lab)"""


def customer_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Customers with the label columns of their country, worked out once per raw label."""
    raw = table(spark, sf, "customer").select("c_custkey", country_label("c_nationkey").alias("raw"))
    return natural_join(raw, T.label_dimension(raw, "raw"), "left", ["raw"])


@query("d1_canon_country", ctes(CUSTOMER_LABELS) + "SELECT c_custkey, country FROM can")
def d1(spark: SparkSession, sf: str) -> DataFrame:
    return customer_labels(spark, sf).select("c_custkey", "country")


@query("d2_region_of", ctes(CUSTOMER_LABELS) + f"""
SELECT c_custkey, {region_sql('country')} AS region, {europe_sql('country')} AS is_europe,
       country IN {sql_in(V.ASEAN)} AS is_asean FROM can""")
def d2(spark: SparkSession, sf: str) -> DataFrame:
    return customer_labels(spark, sf).select("c_custkey", "region", "is_europe", "is_asean")


@query("d3_is_residual", ctes(CUSTOMER_LABELS) + f"""
SELECT c_custkey, {residual_sql('raw')} AS is_resid FROM can""")
def d3(spark: SparkSession, sf: str) -> DataFrame:
    return customer_labels(spark, sf).select("c_custkey", "is_resid")


def codes(spark: SparkSession, sf: str) -> DataFrame:
    return trade_fact(spark, sf).groupBy("code").agg(F.count("*").alias("records"))


CODES = FACT + """,
codes AS (SELECT code, count(*) AS records FROM fact GROUP BY code)"""


@query("d4_hs_era", ctes(CODES) + """
SELECT code, records, CASE WHEN length(code) >= 10 THEN 'HS' ELSE 'pre-HS' END AS era,
       CASE WHEN length(code) >= 10 THEN 'HS' ELSE 'PSCC' END AS classification,
       CASE WHEN length(code) >= 10 THEN substr(code, 1, 6) ELSE code END AS code_key
FROM codes""")
def d4(spark: SparkSession, sf: str) -> DataFrame:
    return codes(spark, sf).select(
        "code", "records", T.hs_era("code").alias("era"),
        T.classification("code").alias("classification"), T.code_key("code").alias("code_key"))


@query("d5_chapter_group", ctes(CODES) + f"""
SELECT code, records, substr(code, 1, 2) AS chapter, {chapter_label_sql('substr(code, 1, 2)')} AS chapter_label,
       {group_sql('CAST(substr(code, 1, 2) AS INTEGER)')} AS "group"
FROM codes""")
def d5(spark: SparkSession, sf: str) -> DataFrame:
    return codes(spark, sf).withColumn("chapter", F.substring("code", 1, 2)).select(
        "code", "records", "chapter", T.chapter_label("chapter").alias("chapter_label"),
        T.chapter_group("chapter").alias("group"))


@query("d6_mineral_type", ctes(CODES) + f"""
SELECT code, records, {mineral_sql('code')} AS mineral_type,
       length(code) >= 10 AND substr(code, 1, 4) IN {sql_in(V.SEMI_PREFIXES)} AS is_semi,
       length(code) >= 10 AND (substr(code, 1, 2) IN {sql_in(V.MINERAL_CHAPTERS)}
         OR substr(code, 1, 4) IN {sql_in(V.MINERAL_HEADINGS)}) AS is_mineral
FROM codes""")
def d6(spark: SparkSession, sf: str) -> DataFrame:
    return codes(spark, sf).select(
        "code", "records", T.mineral_type("code").alias("mineral_type"),
        T.is_semi("code").alias("is_semi"), T.is_mineral("code").alias("is_mineral"))


# -- trade tables -----------------------------------------------------------------------

PARTNER_SQL = ctes(PARTNER) + "SELECT * FROM partner"
COMMODITY_SQL = ctes(LABELLED, COMMODITY) + "SELECT * FROM commodity"
GROUP_SQL = ctes(LABELLED) + f"""
SELECT year, direction, country, "group", {USD} AS value_usd FROM labelled
WHERE classification = 'HS' GROUP BY ALL"""
SEMI_SQL = ctes(LABELLED) + f"""
SELECT year, direction, country, {USD} AS value_usd FROM labelled WHERE is_semi GROUP BY ALL"""
MINERAL_SQL = ctes(LABELLED) + f"""
SELECT year, direction, country, {mineral_sql('code')} AS mineral_type, {USD} AS value_usd
FROM labelled WHERE is_mineral GROUP BY ALL"""
REGION_SQL = ctes(PARTNER) + """
SELECT year, direction, region, sum(value_usd) AS value_usd FROM partner GROUP BY ALL"""
ANNUAL_SQL = ctes(PARTNER, ANNUAL) + """
SELECT year, Exports, Imports, Exports - Imports AS balance, Exports + Imports AS total_trade FROM annual"""


def marginal(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return T.MARGINAL_TABLES[name](T.trade_leaf(trade_fact(spark, sf)))


@query("d7_trade_by_partner", PARTNER_SQL)
def d7_partner(spark: SparkSession, sf: str) -> DataFrame:
    return marginal(spark, sf, "trade_by_partner")


@query("d7_trade_by_commodity", COMMODITY_SQL)
def d7_commodity(spark: SparkSession, sf: str) -> DataFrame:
    return marginal(spark, sf, "trade_by_commodity")


@query("d7_trade_by_partner_group", GROUP_SQL)
def d7_group(spark: SparkSession, sf: str) -> DataFrame:
    return marginal(spark, sf, "trade_by_partner_group")


@query("d7_trade_semiconductors", SEMI_SQL)
def d7_semi(spark: SparkSession, sf: str) -> DataFrame:
    return marginal(spark, sf, "trade_semiconductors")


@query("d7_trade_minerals", MINERAL_SQL)
def d7_minerals(spark: SparkSession, sf: str) -> DataFrame:
    return marginal(spark, sf, "trade_minerals")


@query("d8_trade_by_region", REGION_SQL)
def d8_region(spark: SparkSession, sf: str) -> DataFrame:
    return T.build_region(marginal(spark, sf, "trade_by_partner"))


@query("d8_trade_annual", ANNUAL_SQL)
def d8_annual(spark: SparkSession, sf: str) -> DataFrame:
    return T.build_annual(marginal(spark, sf, "trade_by_partner"))


# -- national accounts ------------------------------------------------------------------

EXPENDITURES = [
    "Household final consumption", "Government final consumption", "Less : Imports of goods",
    "Gross capital formation, net", "Statistical discrepancy",
]
INDUSTRIES = [
    "Agriculture,  forestry and fishing", "Industry", "Services,  and other",
    "Gross Domestic  Product", "Net primary income, rest",
]
BLOCKS = [NA.Block("Constant 2018 Prices", 49, 23), NA.Block("Current Prices", 11, 23)]


def accounts_grid(spark: SparkSession, sf: str, labels: list[str], unit: str) -> DataFrame:
    """A landed sheet: a block of five rows per valuation, a row per priority."""
    periods = [d.isoformat() for d in span(spark, sf, unit)]
    k = F.substring("o_orderpriority", 1, 1).cast("int")
    sums = table(spark, sf, "orders").groupBy(
        k.alias("k"), F.trunc("o_orderdate", unit).cast("string").alias("p")).agg(
        total("o_totalprice", 2).alias("current"), F.count("*").alias("constant"))
    label = F.element_at(F.array(*[F.lit(x) for x in labels]), F.col("k"))
    parts = []
    for value, skip in (("current", 11), ("constant", 49)):
        wide_rows = wide(sums, ["k"], "p", F.col(value).cast("decimal(18,2)").cast("string"), periods, F.col("p"))
        parts.append(wide_rows.select(
            (F.col("k") + skip).alias("row_idx"),
            F.array(label, *[F.col(f"`{p}`") for p in periods]).alias("cells")))
    return union_all(parts)


def accounts(spark: SparkSession, sf: str, kind: str, unit: str) -> DataFrame:
    labels, drop, strip = {
        "Expenditure": (EXPENDITURES, NA.DISCREPANCY, NA.LESS),
        "Industry": (INDUSTRIES, None, NA.AFTER_COMMA),
    }[kind]
    periods = [d.isoformat() for d in span(spark, sf, unit)]
    time, lag = {"quarter": ("Quarter", 4), "year": ("Year", 1)}[unit]
    return NA.build_accounts(accounts_grid(spark, sf, labels, unit), BLOCKS, periods, kind, time, lag,
                             drop=drop, strip=strip)


def accounts_sql(kind: str, unit: str) -> str:
    labels, keep, clean = {
        "Expenditure": (EXPENDITURES, "NOT contains(label, 'discrepancy')", "replace(label, 'Less : ', '')"),
        "Industry": (INDUSTRIES, "true", "regexp_replace(label, ',.+', '')"),
    }[kind]
    time, lag = {"quarter": ("Quarter", 4), "year": ("Year", 1)}[unit]
    return f"""
WITH s AS (
  SELECT {sql_list(labels)}[CAST(substr(o_orderpriority, 1, 1) AS INTEGER)] AS label,
         CAST(date_trunc('{unit}', o_orderdate) AS DATE) AS p, {cents('o_totalprice')} AS cur,
         CAST(count(*) AS DOUBLE) AS con FROM orders GROUP BY 1, 2),
ps AS (SELECT DISTINCT p FROM s), ls AS (SELECT DISTINCT label FROM s),
g AS (SELECT ls.label, ps.p, cur, con FROM ls CROSS JOIN ps LEFT JOIN s ON s.label = ls.label AND s.p = ps.p),
l AS (SELECT label, p, cur AS v, 'Current Prices' AS valuation FROM g
      UNION ALL SELECT label, p, con, 'Constant 2018 Prices' FROM g),
w AS (SELECT *, v / nullif(lag(v, {lag}) OVER (PARTITION BY valuation, label ORDER BY p), 0) - 1 AS growth FROM l)
SELECT trim(regexp_replace({clean}, '\\s+', ' ', 'g')) AS "{kind}", p AS "{time}", v AS "MillionPesos",
       valuation AS "Valuation", growth AS "GrowthRate"
FROM w WHERE {keep}"""


ACCOUNT_KEYS = {
    "d9_accounts_quarterly_exp": ("Expenditure", "quarter"),
    "d9_accounts_quarterly_ind": ("Industry", "quarter"),
    "d9_accounts_annual_ind": ("Industry", "year"),
}
for _name, (_kind, _unit) in ACCOUNT_KEYS.items():
    query(_name, accounts_sql(_kind, _unit))(
        lambda spark, sf, kind=_kind, unit=_unit: accounts(spark, sf, kind, unit))


TWO_SHEETS = [
    NA.Block("Current Prices", 9, 5, "Current_2018based"), NA.Block("Constant 2018 Prices", 9, 5, "Constant_2018based")]


@query("d9_accounts_two_sheets", f"""
WITH a AS ({accounts_sql('Industry', 'year')}),
names AS (SELECT list_transform({sql_list(INDUSTRIES)}, lambda x: trim(regexp_replace(regexp_replace(x, ',.+', ''), '\\s+', ' ', 'g'))) AS l)
SELECT a.*, CAST(list_position(l, "Industry") AS INTEGER) AS "IndustryRank" FROM a, names""")
def d9_two_sheets(spark: SparkSession, sf: str) -> DataFrame:
    """Each valuation on a sheet of its own, in the same rows, and the labels in their published order."""
    landed = accounts_grid(spark, sf, INDUSTRIES, "year")
    sheets = {
        "Current_2018based": landed.where("row_idx < 49").withColumn("row_idx", F.col("row_idx") - 2),
        "Constant_2018based": landed.where("row_idx >= 49").withColumn("row_idx", F.col("row_idx") - 40)}
    periods = [d.isoformat() for d in span(spark, sf, "year")]
    return NA.build_accounts(sheets, TWO_SHEETS, periods, "Industry", "Year", 1, strip=NA.AFTER_COMMA, rank="IndustryRank")


PC_LABELS = [
    "Per Capita Gross Domestic Product at current prices",
    "Per Capita Gross National Income at current prices",
    "Per Capita Household Final Consumption Expenditure at current prices",
    "Per Capita Gross Domestic Product at constant 2018 prices",
    "Per Capita Gross National Income at constant 2018 prices",
]

D10_SQL = f"""
WITH s AS (
  SELECT {sql_list(PC_LABELS)}[CAST(substr(o_orderpriority, 1, 1) AS INTEGER)] AS label,
         CAST(date_trunc('quarter', o_orderdate) AS DATE) AS q, CAST(count(*) AS DOUBLE) AS v
  FROM orders GROUP BY 1, 2),
g AS (SELECT label, q, v FROM (SELECT DISTINCT label FROM s) CROSS JOIN (SELECT DISTINCT q FROM s)
      LEFT JOIN s USING (label, q)),
t AS (SELECT regexp_extract(label, '(Per.+) at', 1) AS "Industry", q AS "Quarter",
        CASE WHEN contains(label, 'current') THEN 'Current Prices' ELSE 'Constant 2018 Prices' END AS "Valuation",
        v AS "Pesos" FROM g WHERE contains(label, 'Gross'))
SELECT *, "Pesos" / nullif(lag("Pesos", 4) OVER (PARTITION BY "Industry", "Valuation" ORDER BY "Quarter"), 0) - 1
  AS "GrowthRate" FROM t"""


@query("d10_per_capita", D10_SQL)
def d10(spark: SparkSession, sf: str) -> DataFrame:
    quarters = span(spark, sf, "quarter")
    heads = [f"{d.year} Q{(d.month + 2) // 3}" for d in quarters]
    label = F.element_at(F.array(*[F.lit(x) for x in PC_LABELS]),
                         F.substring("o_orderpriority", 1, 1).cast("int"))
    head = F.concat(F.date_format("o_orderdate", "yyyy"), F.lit(" Q"), F.quarter("o_orderdate").cast("string"))
    counts = table(spark, sf, "orders").groupBy(label.alias("Industry"), head.alias("h")).agg(
        F.count("*").cast("string").alias("v"))
    rows = pivot_wide(counts, ["Industry"], "h", "v", heads)
    return NA.build_per_capita(rows.fillna("."))


# -- consumer prices --------------------------------------------------------------------

PLACES = {"F": "PHILIPPINES", "O": "..Muslim Mindanao", "P": "....Abra"}
ITEMS = {
    "1-URGENT": "0 - ALL ITEMS", "2-HIGH": "01 - FOOD AND NON-ALCOHOLIC BEVERAGES",
    "3-MEDIUM": "02.900 - NON-FOOD", "4-NOT SPECIFIED": "07 - TRANSPORT", "5-LOW": "99 - OTHER",
}
LATE_FROM = 1998  # year at which the second vintage takes over
AS_OF = "2001-06-15"


def case_of(col: str, mapping: dict[str, str]) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {col} {whens} END"


def map_of(col: str, mapping: dict[str, str]) -> Column:
    out = None
    for k, v in mapping.items():
        out = F.when(F.col(col) == k, v) if out is None else out.when(F.col(col) == k, v)
    return out


CPI = f"""c0 AS (
  SELECT {case_of('o_orderstatus', PLACES)} AS place, {case_of('o_orderpriority', ITEMS)} AS item,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS m, CAST(count(*) AS DOUBLE) AS v
  FROM orders GROUP BY 1, 2, 3),
cm AS (SELECT CAST(unnest(generate_series((SELECT min(m) FROM c0), (SELECT max(m) FROM c0),
         INTERVAL 1 MONTH)) AS DATE) AS m),
cg AS (SELECT k.place, k.item, cm.m, c0.v FROM (SELECT DISTINCT place, item FROM c0) k CROSS JOIN cm
       LEFT JOIN c0 ON c0.place = k.place AND c0.item = k.item AND c0.m = cm.m)"""
LARGE = CPI + f""",
large AS (
  SELECT place AS "Geolocation", item AS "Commodity", m AS "Month", v AS "CPI",
         v / nullif(lag(v, 12) OVER (PARTITION BY place, item ORDER BY m), 0) - 1 AS "Inflation"
  FROM cg WHERE m < DATE '2001-06-01')"""
CORE = CPI + """,
core AS (
  SELECT place AS "Geolocation", 'CORE' AS "Commodity", m AS "Month", v AS "CPI",
         v / nullif(lag(v, 12) OVER (PARTITION BY place ORDER BY m), 0) - 1 AS "Inflation"
  FROM cg WHERE item = '0 - ALL ITEMS')"""


def cpi_cells(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").groupBy(
        map_of("o_orderstatus", PLACES).alias("Geolocation"),
        map_of("o_orderpriority", ITEMS).alias("Commodity Description"),
        F.date_format("o_orderdate", "yyyy MMM").alias("period"),
    ).agg(F.count("*").cast("string").alias("cell"))


def vintage(spark: SparkSession, sf: str, keep: Callable[[int], bool]) -> DataFrame:
    """A wide price table for some years, with the yearly average column of each."""
    months = [d for d in span(spark, sf) if keep(d.year)]
    heads = [d.strftime("%Y %b") for d in months]
    for year in sorted({d.year for d in months}):
        last = max(i for i, h in enumerate(heads) if h.startswith(str(year)))
        heads.insert(last + 1, f"{year} Ave")
    return pivot_wide(cpi_cells(spark, sf), ["Geolocation", "Commodity Description"], "period", "cell", heads, "drop")


def vintages(spark: SparkSession, sf: str) -> list[DataFrame]:
    """Two vintages; the later one spells a place name differently."""
    old = vintage(spark, sf, lambda y: y < LATE_FROM)
    new = vintage(spark, sf, lambda y: y >= LATE_FROM).withColumn(
        "Geolocation", F.replace("Geolocation", F.lit("Muslim"), F.lit("Bansamoro Muslim")))
    return [old, PR.align_places(new)]


def inflation_large(spark: SparkSession, sf: str) -> DataFrame:
    return PR.build_inflation(vintages(spark, sf), F.lit(AS_OF).cast("date"))


@query("d11_inflation_large", ctes(LARGE) + "SELECT * FROM large")
def d11_large(spark: SparkSession, sf: str) -> DataFrame:
    return inflation_large(spark, sf)


D11_CORE = ctes(CORE) + "SELECT * FROM core"


@query("d11_inflation_core", D11_CORE)
def d11_core(spark: SparkSession, sf: str) -> DataFrame:
    return PR.build_core(vintage(spark, sf, lambda y: True))


D11_SMALL = ctes(LARGE + CORE[len(CPI):]) + """,
u AS (SELECT "Geolocation", regexp_replace("Commodity", '^.+-\\s', '') AS c, "Month", "CPI", "Inflation" FROM large
      WHERE "Geolocation" = 'PHILIPPINES'
      UNION ALL SELECT * FROM core)
SELECT "Geolocation", CASE c WHEN 'ALL ITEMS' THEN 'Headline' WHEN 'CORE' THEN 'Core' WHEN 'NON-FOOD' THEN 'Non-Food'
         ELSE 'Food' END AS "Commodity", "Month", "CPI", "Inflation",
       CASE c WHEN 'ALL ITEMS' THEN 1 WHEN 'CORE' THEN 2 WHEN 'NON-FOOD' THEN 4 ELSE 3 END AS "CommodityRank"
FROM u WHERE c IN ('ALL ITEMS', 'CORE', 'NON-FOOD', 'FOOD AND NON-ALCOHOLIC BEVERAGES')"""


@query("d11_inflation_small", D11_SMALL)
def d11_small(spark: SparkSession, sf: str) -> DataFrame:
    return PR.small_table(inflation_large(spark, sf), d11_core(spark, sf))


D11_MAIN = ctes(LARGE) + f"""
SELECT "Geolocation", regexp_replace("Commodity", '^.+-\\s', '') AS "Commodity", "Month", "CPI", "Inflation"
FROM large WHERE NOT starts_with("Geolocation", '....')
  AND regexp_replace("Commodity", '^.+-\\s', '') IN {sql_in(PR.MAIN_COMMODITIES)}"""


@query("d11_inflation_main", D11_MAIN)
def d11_main(spark: SparkSession, sf: str) -> DataFrame:
    return PR.main_table(inflation_large(spark, sf))


@query("d12_cpi_items", f"""
WITH y AS (
  SELECT {case_of('o_orderstatus', PLACES)} AS place, {case_of('o_orderpriority', ITEMS)} AS item,
         count(*) AS n, count(*) FILTER (year(o_orderdate) < 1998) AS early
  FROM orders GROUP BY 1, 2)
SELECT place AS "Geolocation", item AS "Commodity Description", n AS "all_years", early AS "early_years" FROM y""")
def d12(spark: SparkSession, sf: str) -> DataFrame:
    counts = table(spark, sf, "orders").groupBy(
        map_of("o_orderstatus", PLACES).alias("Geolocation"),
        map_of("o_orderpriority", ITEMS).alias("Commodity Description")).agg(
        F.count("*").alias("all_years"),
        F.count(F.when(F.year("o_orderdate") < 1998, 1)).alias("early_years"))
    items = counts.select("Geolocation", "Commodity Description", F.lit(1.0).alias("Weights"))
    # the sheet names a place only in the first row of its block
    place_no = F.array_position(F.array(*[F.lit(p) for p in PLACES.values()]), F.col("Geolocation"))
    item_no = F.array_position(F.array(*[F.lit(i) for i in ITEMS.values()]), F.col("Commodity Description"))
    rows = counts.withColumn("row_idx", (place_no - 1) * len(ITEMS) + item_no)
    first = rows.groupBy("Geolocation").agg(F.min("row_idx").alias("row_idx"), F.lit(True).alias("is_first"))
    sheet = rows.join(first, ["Geolocation", "row_idx"], "left").select(
        "row_idx", F.when(F.col("is_first"), F.col("Geolocation")).alias("Geolocation"),
        "Commodity Description", "all_years", "early_years")
    return PR.build_cpi_items(items, sheet)


D13_SQL = f"""
WITH n AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS y, {cents('l_extendedprice')} AS nominal,
                  {cents('l_quantity')} AS real FROM lineitem GROUP BY 1),
c AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS y, count(*) AS cpi FROM orders GROUP BY 1)
SELECT y AS "Year", nominal / nullif(real, 0) * 100 AS "GDPDeflator", cpi AS "CPI"
FROM c LEFT JOIN n USING (y)"""


@query("d13_deflators", D13_SQL)
def d13(spark: SparkSession, sf: str) -> DataFrame:
    sums = table(spark, sf, "lineitem").groupBy(F.year("l_shipdate").alias("Year")).agg(
        total("l_extendedprice", 2).alias("NominalGDP"), total("l_quantity", 2).alias("RealGDP"))
    cpi = table(spark, sf, "orders").groupBy(F.year("o_orderdate").alias("Year")).agg(
        F.count("*").alias("CPI"))
    return PR.build_deflators(sums.select("Year", "NominalGDP"), sums.select("Year", "RealGDP"), cpi)


# -- labor and poverty ------------------------------------------------------------------

D14_SQL = """
WITH q AS (SELECT date_trunc('quarter', o_orderdate) AS d, count(*) AS n,
                  count(*) FILTER (o_orderstatus = 'O') AS e FROM orders GROUP BY 1),
m AS (SELECT date_trunc('month', o_orderdate) AS d, count(*) AS n,
             count(*) FILTER (o_orderstatus = 'O') AS e FROM orders GROUP BY 1)
SELECT year(d) || ' Q' || quarter(d) AS "LFSRound", 'Quarter' AS "Round", CAST(d AS DATE) AS "Period",
       n AS "Population15YearsOld", e AS "Employed" FROM q
UNION ALL
SELECT strftime(d, '%Y %b'), 'Month', CAST(d AS DATE), n, e FROM m"""


@query("d14_labor", D14_SQL)
def d14(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    d = F.col("o_orderdate")
    heads = {
        "Quarter": F.concat(F.date_format(d, "yyyy"), F.lit(" Q"), F.quarter(d).cast("string")),
        "Month": F.date_format(d, "yyyy MMM"), "Annual": F.date_format(d, "yyyy"),
    }
    raw = union_all([
        orders.groupBy(h.alias("LFS Round"), F.lit(kind).alias("Round")).agg(
            F.count("*").alias("Population 15 Years Old+"),
            F.count(F.when(F.col("o_orderstatus") == "O", 1)).alias("Employed"))
        for kind, h in heads.items()])
    return SO.build_labor(raw)


def poverty_sql(ids: dict[str, str]) -> str:
    cols = ", ".join(f'{e} AS "{n}"' for n, e in ids.items())
    keys = ", ".join(f'"{n}"' for n in ids)
    return f"""
WITH s AS (SELECT {cols}, CAST(date_trunc('year', o_orderdate) AS DATE) AS "Year",
                  CAST(count(*) AS DOUBLE) AS "Value"
           FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)
SELECT {keys}, "Year", "Value" FROM (SELECT DISTINCT {keys} FROM s)
CROSS JOIN (SELECT DISTINCT "Year" FROM s) LEFT JOIN s USING ({keys}, "Year")"""


POVERTY_IDS = {"Indicator": "o_orderstatus", "Series": "o_orderpriority", "Place": "c_mktsegment"}
SECTOR_IDS = {"Indicator": "o_orderstatus", "Series": "c_mktsegment"}


def poverty(spark: SparkSession, sf: str, ids: dict[str, str]) -> DataFrame:
    joined = table(spark, sf, "orders").join(
        table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    counts = joined.groupBy(*[F.col(c).alias(n) for n, c in ids.items()],
                            F.date_format("o_orderdate", "yyyy").alias("y")).agg(
        F.count("*").cast("string").alias("v"))
    years = [str(d.year) for d in span(spark, sf, "year")]
    return SO.build_poverty(pivot_wide(counts, list(ids), "y", "v", years), list(ids))


@query("d15_poverty", poverty_sql(POVERTY_IDS))
def d15(spark: SparkSession, sf: str) -> DataFrame:
    return poverty(spark, sf, POVERTY_IDS)


@query("d15_poverty_sectors", poverty_sql(SECTOR_IDS))
def d15_sectors(spark: SparkSession, sf: str) -> DataFrame:
    return poverty(spark, sf, SECTOR_IDS)


# -- public finance ---------------------------------------------------------------------

CASH = {
    "1-URGENT": "BIR Revenues", "2-HIGH": "BOC Revenues (net)", "3-MEDIUM": "Expenditures",
    "4-NOT SPECIFIED": "Surplus/Deficit", "5-LOW": "Grants",
}
CASH_IDENTS = [re.sub(r"\s|-|/|\(|\)", "", v) for v in CASH.values()]
DEBT = {
    ("F", "A"): "Total Obligations", ("F", "N"): "Actual Obligations", ("F", "R"): "Domestic Debt",
    ("O", "A"): "External Debt", ("O", "N"): "Domestic Guaranteed Obligations",
    ("O", "R"): "External Guaranteed Obligations",
}
CUT_YEAR = 1998


def cash_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Particulars in rows, one column per month (`January 1995`), text cells."""
    heads = [d.strftime("%B %Y") for d in span(spark, sf)]
    rows = table(spark, sf, "orders").groupBy(
        map_of("o_orderpriority", CASH).alias("Particulars"),
        F.date_format("o_orderdate", "MMMM yyyy").alias("h")).agg(
        cell_text(total("o_totalprice", 2)).alias("cell"))
    return pivot_wide(rows, ["Particulars"], "h", "cell", heads)


def _roll(cols: list[str], how: str) -> str:
    fn = {"mean": "avg", "sum": "sum"}[how]
    return ", ".join(
        f'CASE WHEN count("{c}") OVER w = 4 THEN {fn}("{c}") OVER w END AS "{c}4Q"' for c in cols)


def ngcor_ctes(how: str) -> str:
    picks = ", ".join(
        f"CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (o_orderpriority = '{k}') AS DOUBLE) "
        f'AS "{i}"' for k, i in zip(CASH, CASH_IDENTS))
    return f"""{GDP},
cash AS (SELECT CAST(date_trunc('quarter', o_orderdate) AS DATE) AS "Quarter", {picks}
         FROM orders GROUP BY 1),
both_ AS (SELECT cash.*, gdp.NominalGDP FROM cash LEFT JOIN gdp ON gdp.Quarter = cash."Quarter"),
ngcor AS (SELECT * FROM (SELECT *, {_roll([*CASH_IDENTS, 'NominalGDP'], how)} FROM both_
  WINDOW w AS (ORDER BY "Quarter" ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)) WHERE NominalGDP > 0)"""


ROUNDED_4Q = ", ".join(f'round("{c}4Q", 4) AS "{c}4Q"' for c in [*CASH_IDENTS, "NominalGDP"])


def ngcor_sql(how: str) -> str:
    names = ", ".join(f'"{c}"' for c in ["Quarter", *CASH_IDENTS, "NominalGDP"])
    return ctes(ngcor_ctes(how)) + f"SELECT {names}, {ROUNDED_4Q} FROM ngcor"


def ngcor(spark: SparkSession, sf: str, how: str = "mean") -> DataFrame:
    return FI.build_ngcor(FI.monthly_long(cash_raw(spark, sf)), gdp(spark, sf), CASH_IDENTS, how, 2)


def rounded_4q(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 4) for c in df.columns if c.endswith("4Q")})


@query("d16_ngcor_mean", ngcor_sql("mean"))
def d16_mean(spark: SparkSession, sf: str) -> DataFrame:
    return rounded_4q(ngcor(spark, sf, "mean"))


@query("d16_ngcor_sum", ngcor_sql("sum"))
def d16_sum(spark: SparkSession, sf: str) -> DataFrame:
    return rounded_4q(ngcor(spark, sf, "sum"))


def debt_rows(spark: SparkSession, sf: str, unit: str, fmt: str) -> DataFrame:
    """Debt lines per period, from the value of line items by status and flag."""
    rule = None
    for (status, flag), name in DEBT.items():
        hit = (F.col("l_linestatus") == status) & (F.col("l_returnflag") == flag)
        rule = F.when(hit, name) if rule is None else rule.when(hit, name)
    return table(spark, sf, "lineitem").groupBy(
        rule.alias("Particulars"), F.date_format("l_shipdate", fmt).alias("h"),
        F.trunc("l_shipdate", unit).alias("d")).agg(cell_text(total("l_extendedprice", 2)).alias("cell"))


def debt_raw(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Monthly sheet (with debt service) and yearly sheet."""
    months = span(spark, sf, "month", "lineitem", "l_shipdate")
    heads = [d.strftime("%B %Y") for d in months]
    stocks = debt_rows(spark, sf, "month", "MMMM yyyy").select("Particulars", "h", "cell")
    service = table(spark, sf, "lineitem").groupBy(F.date_format("l_shipdate", "MMMM yyyy").alias("h")).agg(
        cell_text(total("l_quantity", 2)).alias("cell")).withColumn("Particulars", F.lit(FI.DEBT_SERVICE))
    monthly_sheet = pivot_wide(stocks.unionByName(service), ["Particulars"], "h", "cell", heads)
    yearly = pivot_wide(debt_rows(spark, sf, "year", "yyyy"), ["Particulars"], "h", "cell",
                        sorted({str(d.year) for d in months}))
    return monthly_sheet, yearly


def debt_sql(unit: str) -> str:
    def pick(name: str) -> str:
        (status, flag), = [k for k, v in DEBT.items() if v == name]
        return (f"CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) FILTER (l_linestatus = '{status}' "
                f"AND l_returnflag = '{flag}') AS DOUBLE)")
    return f"""SELECT CAST(date_trunc('{unit}', l_shipdate) AS DATE) AS m,
      {pick('Total Obligations')} AS t,
      {pick('Domestic Debt')} + {pick('Domestic Guaranteed Obligations')} AS d,
      {pick('External Debt')} + {pick('External Guaranteed Obligations')} AS e
    FROM lineitem GROUP BY 1"""


D17_SQL = ctes(GDP) + f""",
svc AS (SELECT CAST(date_trunc('quarter', l_shipdate) AS DATE) AS q, {cents('l_quantity')} AS s
        FROM lineitem GROUP BY 1),
svc4 AS (SELECT q, s, CASE WHEN count(s) OVER w = 4 THEN sum(s) OVER w END AS s4 FROM svc
         WINDOW w AS (ORDER BY q ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)),
ann AS (SELECT make_date(year(m), 12, 1) AS m, t, d, e FROM ({debt_sql('year')})),
gdp4 AS (SELECT Quarter AS q, NominalGDP AS g, CASE WHEN count(*) OVER w = 4 THEN sum(NominalGDP) OVER w END AS g4
         FROM gdp WINDOW w AS (ORDER BY Quarter ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)),
qtr AS (SELECT m, t, d, e FROM ({debt_sql('month')}) WHERE month(m) IN (3, 6, 9, 12)
        AND year(m) >= {CUT_YEAR - 1}),
qj AS (SELECT m, date_trunc('quarter', m)::DATE AS q, t, d, e, g,
         CASE WHEN count(g) OVER w = 4 THEN sum(g) OVER w END AS g4, s, s4
       FROM qtr LEFT JOIN gdp4 ON gdp4.q = date_trunc('quarter', m) LEFT JOIN svc4 ON svc4.q = date_trunc('quarter', m)
       WINDOW w AS (ORDER BY m ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)),
aj AS (SELECT m, date_trunc('quarter', m)::DATE AS q, t, d, e, g, g4, s, s4
       FROM ann LEFT JOIN gdp4 ON gdp4.q = date_trunc('quarter', m) LEFT JOIN svc4 ON svc4.q = date_trunc('quarter', m)
       WHERE year(m) < {CUT_YEAR}),
un AS (SELECT * FROM aj UNION ALL SELECT * FROM qj WHERE g > 0 AND m >= DATE '{CUT_YEAR}-01-01')
SELECT m AS "Month", q AS "Quarter", t AS "TotalObligations", round(d, 2) AS "DomesticDebt",
       round(e, 2) AS "ExternalDebt", g AS "NominalGDP", round(g4, 2) AS "NominalGDP4Q",
       s AS "DebtServiceInterestPayment", round(s4, 2) AS "DebtService4Q"
FROM un"""


def debt_table_sql() -> str:
    picks = []
    for name in FI.DEBT_TABLE_LINES:
        (status, flag), = [k for k, v in DEBT.items() if v == name]
        picks.append(f"CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) FILTER (l_linestatus = '{status}' "
                     f"""AND l_returnflag = '{flag}') AS DOUBLE) AS "{name.replace(' ', '')}\"""")
    names = ", ".join(f'"{n.replace(" ", "")}"' for n in FI.DEBT_TABLE_LINES)
    return ctes(GDP) + f""",
q AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS m, {', '.join(picks)} FROM lineitem
      WHERE l_linestatus || l_returnflag IN ({', '.join(f"'{s}{r}'" for (s, r), v in DEBT.items() if v in FI.DEBT_TABLE_LINES)}) GROUP BY 1),
j AS (SELECT q.*, date_trunc('quarter', m)::DATE AS qt, NominalGDP AS g FROM q LEFT JOIN gdp ON gdp.Quarter = date_trunc('quarter', m)
      WHERE month(m) IN (3, 6, 9, 12) AND year(m) >= {CUT_YEAR})
SELECT m AS "Month", qt AS "Quarter", {names}, g AS "NominalGDP",
       round(CASE WHEN count(g) OVER w = 4 THEN sum(g) OVER w END, 2) AS "NominalGDP4Q"
FROM j WINDOW w AS (ORDER BY m ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)"""


@query("d17_debt_table", debt_table_sql())
def d17_table(spark: SparkSession, sf: str) -> DataFrame:
    monthly_sheet, _ = debt_raw(spark, sf)
    out = FI.debt_table(FI.monthly_long(monthly_sheet), gdp(spark, sf), CUT_YEAR)
    return out.withColumn("NominalGDP4Q", F.round("NominalGDP4Q", 2))


@query("d17_ngdebt", D17_SQL)
def d17(spark: SparkSession, sf: str) -> DataFrame:
    monthly_sheet, yearly = debt_raw(spark, sf)
    out = FI.build_ngdebt(FI.annual_long(yearly, 1986), FI.monthly_long(monthly_sheet), gdp(spark, sf), CUT_YEAR)
    return out.withColumns({
        c: F.round(c, 2) for c in ("DomesticDebt", "ExternalDebt", "NominalGDP4Q", "DebtService4Q")})


D18_SQL = ctes(ngcor_ctes("mean")) + f""",
tax AS (SELECT p_type AS "TaxType", make_date(year(l_shipdate), 10, 1) AS "Year",
          CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) FILTER (l_linestatus = 'F') AS DOUBLE) AS "Collection",
          CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) FILTER (l_linestatus = 'O') AS DOUBLE) AS "Goal"
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)
SELECT "TaxType", tax."Year", "Collection", "Goal", tax."Year" AS "Quarter",
       round("BIRRevenues4Q", 4) AS "BIRRevenues4Q", round("NominalGDP4Q", 4) AS "NominalGDP4Q",
       round("Collection" / nullif("NominalGDP4Q" * 4, 0), 9) AS "Effort",
       round("Collection" / nullif("BIRRevenues4Q" * 4, 0), 9) AS "Share"
FROM tax LEFT JOIN (SELECT * FROM ngcor WHERE quarter("Quarter") = 4) n ON n."Quarter" = tax."Year" """


@query("d18_tax_types", D18_SQL)
def d18(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.when(F.col("l_linestatus") == "F", "Collection").otherwise("Goal")
    rows = table(spark, sf, "lineitem").join(
        table(spark, sf, "part").select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey")
    ).groupBy(F.col("p_type").alias("Tax Classification"),
              F.concat_ws(" ", F.date_format("l_shipdate", "yyyy"), kind).alias("h")).agg(
        cell_text(total("l_extendedprice", 2)).alias("cell"))
    heads = [f"{y} {k}" for y in ship_years(spark, sf) for k in ("Collection", "Goal")]
    raw = pivot_wide(rows, ["Tax Classification"], "h", "cell", heads)
    out = FI.build_tax(raw, ngcor(spark, sf, "mean"), ["Collection", "Goal"])
    return rounded_4q(out).withColumns({c: F.round(c, 9) for c in ("Effort", "Share")})


# -- agriculture ------------------------------------------------------------------------

GEO = {"F": "PHILIPPINES", "O": "..Central Luzon", "P": "....Bulacan"}
KIND = {"quarter": "Quarter", "year": "Annual", "month": "Month"}


def ship_years(spark: SparkSession, sf: str) -> list[int]:
    return [d.year for d in span(spark, sf, "year", "lineitem", "l_shipdate")]


def agri_heads(spark: SparkSession, sf: str) -> list[str]:
    """Quarter and yearly columns of the shipping years, `1995 Quarter 1` ... `1995 Annual`."""
    return [f"{y} {p}" for y in ship_years(spark, sf)
            for p in ("Quarter 1", "Quarter 2", "Quarter 3", "Quarter 4", "Annual")]


def agri_cells(spark: SparkSession, sf: str, keys: dict[str, Column], **measures: Column) -> DataFrame:
    """Quarterly and annual cells of one or more measures under their headers, from one pass over the line items."""
    src = table(spark, sf, "lineitem")
    year = F.date_format("l_shipdate", "yyyy")
    heads = F.array(F.concat(year, F.lit(" Quarter "), F.quarter("l_shipdate").cast("string")), F.concat(year, F.lit(" Annual")))
    rows = src.withColumns(keys).withColumn("h", F.explode(heads))
    summed = rows.groupBy(*[f"`{k}`" for k in keys], "h").agg(*[cell_text(m).alias(c) for c, m in measures.items()])
    return stage(summed, "agri-cells")


def flag_geo() -> Column:
    return map_of("l_returnflag", {"A": GEO["F"], "N": GEO["O"], "R": GEO["P"]})


FLAG_GEO_SQL = """CASE l_returnflag WHEN 'A' THEN 'PHILIPPINES' WHEN 'N' THEN 'Central Luzon' ELSE 'Bulacan' END"""
FLAG_LEVEL_SQL = """CASE l_returnflag WHEN 'A' THEN 'National' WHEN 'N' THEN 'Region' ELSE 'Province' END"""


def unit_of(freq: str) -> tuple[str, int]:
    return {"Annual": ("year", 1), "Quarter": ("quarter", 4)}[freq]


def full_grid(body: str, keys: str, unit: str, time: str) -> str:
    """All series of a wide table on its whole calendar, empty cells as NULL."""
    return f"""cells AS ({body}),
cal AS (SELECT CAST(unnest(generate_series(make_date((SELECT CAST(min(year(l_shipdate)) AS INTEGER) FROM lineitem), 1, 1),
        make_date((SELECT CAST(max(year(l_shipdate)) AS INTEGER) FROM lineitem), 12, 31), INTERVAL {'1 YEAR' if unit == 'year' else '3 MONTH'}))
        AS DATE) AS "{time}"),
full_ AS (SELECT * FROM (SELECT DISTINCT {keys} FROM cells) CROSS JOIN cal LEFT JOIN cells USING ({keys}, "{time}"))"""


def crops_sql(freq: str) -> str:
    unit, lag = unit_of(freq)
    time = AG.TIME_COLUMN[freq]
    body = f"""SELECT 'Crop ' || l_linenumber AS "Commodity", {FLAG_GEO_SQL} AS "Geolocation", {FLAG_LEVEL_SQL} AS "Level",
      CAST(date_trunc('{unit}', l_shipdate) AS DATE) AS "{time}",
      {cents('l_extendedprice')} AS "Volume", {cents('l_quantity')} AS "Area" FROM lineitem GROUP BY ALL"""
    keys = '"Commodity", "Geolocation", "Level"'
    grow = ", ".join(
        f'"{c}" / nullif(lag("{c}", {lag}) OVER w, 0) - 1 AS "{c}Growth"' for c in ("Volume", "Area", "Yield"))
    return ctes(full_grid(body, keys, unit, time)) + f""",
y AS (SELECT *, "Volume" / nullif("Area", 0) AS "Yield" FROM full_)
SELECT *, {grow} FROM y WINDOW w AS (PARTITION BY {keys} ORDER BY "{time}")"""


def crops(spark: SparkSession, sf: str, freq: str) -> DataFrame:
    heads = agri_heads(spark, sf)
    name = F.concat(F.lit("Crop "), F.col("l_linenumber").cast("string"))
    keys = {"Commodity": name, "Geolocation": flag_geo()}

    cells = agri_cells(spark, sf, keys, Volume=total("l_extendedprice", 2), Area=total("l_quantity", 2))

    def sheets(measure: str) -> list[DataFrame]:
        rows = pivot_wide(cells, ["Commodity", "Geolocation"], "h", measure, heads)
        major = F.col("Commodity") < "Crop 4"
        return [rows.where(major), rows.where(~major)]

    return AG.build_crops(sheets("Volume"), sheets("Area"), freq)


for _freq in ("Annual", "Quarter"):
    query(f"d19_crops_{ {'Annual': 'annual', 'Quarter': 'quarterly'}[_freq] }", crops_sql(_freq))(
        lambda spark, sf, freq=_freq: crops(spark, sf, freq))


PRICE_FOLDERS = {
    "F": ("Farmgate Prices", "New Series", "Farmgate"),
    "O": ("Retail Prices", "2018-based (New Geo Code)", "Retail"),
}


def price_tree(spark: SparkSession, sf: str) -> tuple[str, list[str]]:
    """Price files in a folder tree: months either way round in the header, and one reject."""
    root = fresh_dir(spark, "prices")
    src = table(spark, sf, "lineitem")
    years = ship_years(spark, sf)
    paths = []
    for status, (kind, series, _) in PRICE_FOLDERS.items():
        fmt = "yyyy MMMM" if status == "F" else "MMMM yyyy"
        names = AG.header_months(years[0], years[-1], year_first=status == "F")
        rows = src.where(F.col("l_linestatus") == status)
        keys = [flag_geo().alias("Geolocation"), F.concat(F.lit("Item "), F.col("l_linenumber").cast("string")).alias("Commodity")]
        cells = union_all([
            rows.groupBy(*keys, F.date_format("l_shipdate", fmt).alias("h")).agg(
                cell_text(total("l_extendedprice", 2)).alias("cell")),
            rows.groupBy(*keys, F.concat(F.date_format("l_shipdate", "yyyy"), F.lit(" Annual")).alias("h")).agg(
                cell_text(total("l_extendedprice", 2)).alias("cell"))])
        heads = names + [f"{y} Annual" for y in years]
        wide_rows = pivot_wide(cells, ["Geolocation", "Commodity"], "h", "cell", heads)
        paths.append(csv_out(wide_rows.fillna(".."), f"{root}/{kind}/{series}/items.csv"))
    seasonal = src.groupBy(F.lit("Palay").alias("Commodity")).agg(
        cell_text(total("l_quantity", 2)).alias(f"{years[0]} Quarter 1"))
    paths.append(csv_out(seasonal, f"{root}/Farmgate Prices/New Series/seasonal.csv"))
    return root, paths


def prices_sql(freq: str) -> str:
    unit = {"Annual": "year", "Month": "month"}[freq]
    return f"""
SELECT CASE l_linestatus WHEN 'F' THEN 'Farmgate' ELSE 'Retail' END AS "PriceType",
       CASE l_linestatus WHEN 'F' THEN 'New Series' ELSE '2018-based (New Geo Code)' END AS "Series",
       'Item ' || l_linenumber AS "Commodity", {FLAG_GEO_SQL} AS "Geolocation", {FLAG_LEVEL_SQL} AS "Level",
       CAST(date_trunc('{unit}', l_shipdate) AS DATE) AS "{AG.TIME_COLUMN[freq]}", {cents('l_extendedprice')} AS "Pesos"
FROM lineitem GROUP BY ALL"""


def prices(spark: SparkSession, sf: str, freq: str, national: bool = False) -> DataFrame:
    root, paths = price_tree(spark, sf)
    return AG.build_prices(AG.price_records(spark, root, paths, freq), freq, national)


@query("d20_prices_monthly", prices_sql("Month"))
def d20_monthly(spark: SparkSession, sf: str) -> DataFrame:
    return prices(spark, sf, "Month")


@query("d20_prices_annual", prices_sql("Annual"))
def d20_annual(spark: SparkSession, sf: str) -> DataFrame:
    return prices(spark, sf, "Annual")


D20_NATIONAL = f"SELECT * FROM ({prices_sql('Month')}) WHERE \"Level\" = 'National'"


@query("d20_prices_national", D20_NATIONAL)
def d20_national(spark: SparkSession, sf: str) -> DataFrame:
    return prices(spark, sf, "Month", national=True)


D21_SQL = ctes(full_grid(f"""SELECT CASE l_linestatus WHEN 'F' THEN 'Current Prices' ELSE 'Constant Prices' END AS "Valuation",
      'Sub ' || l_linenumber AS "Subsector", CAST(date_trunc('quarter', l_shipdate) AS DATE) AS "Quarter",
      {cents('l_extendedprice')} AS "MillionPesos" FROM lineitem GROUP BY ALL""",
    '"Valuation", "Subsector"', "quarter", "Quarter")) + """
SELECT *, "MillionPesos" / nullif(lag("MillionPesos", 4) OVER (PARTITION BY "Valuation", "Subsector" ORDER BY "Quarter"), 0) - 1
  AS "GrowthRate" FROM full_"""


@query("d21_value_production", D21_SQL)
def d21(spark: SparkSession, sf: str) -> DataFrame:
    keys = {"Valuation": map_of("l_linestatus", {"F": "Current Prices", "O": "Constant Prices"}),
            "Subsector": F.concat(F.lit("..Sub "), F.col("l_linenumber").cast("string"))}
    cells = agri_cells(spark, sf, keys, cell=total("l_extendedprice", 2))
    return AG.build_value_production(
        pivot_wide(cells, ["Valuation", "Subsector"], "h", "cell", agri_heads(spark, sf)))


D22_SQL = ctes(full_grid("""SELECT 'Item ' || l_linenumber AS "Commodity",
      CASE l_linestatus WHEN 'F' THEN 'Self-Sufficiency Ratio' ELSE 'Import Dependency Ratio' END AS "Indicator",
      CAST(date_trunc('year', l_shipdate) AS DATE) AS "Year", CAST(count(*) AS DOUBLE) AS "Ratio"
      FROM lineitem GROUP BY ALL""", '"Commodity", "Indicator"', "year", "Year")) + "SELECT * FROM full_"


@query("d22_self_sufficiency", D22_SQL)
def d22(spark: SparkSession, sf: str) -> DataFrame:
    src = table(spark, sf, "lineitem")
    name = F.concat(F.lit("Item "), F.col("l_linenumber").cast("string")).alias("Commodity")

    def sheet(status: str) -> DataFrame:
        cells = src.where(F.col("l_linestatus") == status).groupBy(
            name, F.date_format("l_shipdate", "yyyy").alias("h")).agg(F.count("*").cast("string").alias("cell"))
        return pivot_wide(cells, ["Commodity"], "h", "cell", [str(y) for y in ship_years(spark, sf)])

    return AG.build_self_sufficiency(
        {"Self-Sufficiency Ratio": sheet("F"), "Import Dependency Ratio": sheet("O")})


def livestock_sql(freq: str) -> str:
    unit, _ = unit_of(freq)
    time = AG.TIME_COLUMN[freq]
    body = f"""SELECT 'Animal ' || l_linenumber AS "Item", CAST(CASE WHEN l_linenumber > 1 THEN 2 ELSE 0 END AS INTEGER) AS "Depth",
      'Production (MT)' AS "Indicator", CAST(date_trunc('{unit}', l_shipdate) AS DATE) AS "{time}",
      {cents('l_extendedprice')} AS "Value" FROM lineitem GROUP BY ALL"""
    out = ctes(full_grid(body, '"Item", "Depth", "Indicator"', unit, time))
    out += f'SELECT "Item", "Depth", "Indicator", "{time}", "Value" FROM full_'
    if freq == "Annual":
        out += f"""
UNION ALL
SELECT a, 0, 'Inventory (head)', y, CASE a WHEN 'Carabao' THEN n WHEN 'Cattle' THEN o ELSE p END
FROM (SELECT CAST(date_trunc('year', o_orderdate) AS DATE) AS y, CAST(count(*) FILTER (o_orderstatus = 'F') AS DOUBLE) AS n,
        CAST(count(*) FILTER (o_orderstatus = 'O') AS DOUBLE) AS o,
        CAST(count(*) FILTER (o_orderstatus = 'P') AS DOUBLE) AS p FROM orders GROUP BY 1)
CROSS JOIN (VALUES ('Carabao'), ('Cattle'), ('Goat')) t(a)"""
    return out


def livestock(spark: SparkSession, sf: str, freq: str) -> DataFrame:
    n = F.col("l_linenumber")
    name = F.concat(F.when(n > 1, "..").otherwise(""), F.lit("Animal "), n.cast("string"))
    cells = agri_cells(spark, sf, {"Sector/Animal Type": name}, cell=total("l_extendedprice", 2))
    production = pivot_wide(cells, ["Sector/Animal Type"], "h", "cell", agri_heads(spark, sf))
    status = F.col("o_orderstatus")
    inventory = table(spark, sf, "orders").groupBy(F.date_format("o_orderdate", "yyyy").alias("Year")).agg(
        F.count(F.when(status == "F", 1)).cast("string").alias("Carabao"),
        F.count(F.when(status == "O", 1)).cast("string").alias("Cattle"),
        F.count(F.when(status == "P", 1)).cast("string").alias("Goat"))
    return AG.build_livestock(production, inventory, freq)


def fisheries_sql(freq: str) -> str:
    unit, _ = unit_of(freq)
    return f"""
WITH s AS (SELECT 'Sub ' || l_linenumber AS sub, {FLAG_GEO_SQL} AS geo, {FLAG_LEVEL_SQL} AS lev,
  CAST(date_trunc('{unit}', l_shipdate) AS DATE) AS t, {cents('l_quantity')} AS q, {cents('l_extendedprice')} AS v
  FROM lineitem GROUP BY ALL)
SELECT sub AS "Subsector", geo AS "Geolocation", lev AS "Level", 'Volume (MT)' AS "Indicator", t AS "{AG.TIME_COLUMN[freq]}", q AS "Value" FROM s
UNION ALL SELECT sub, geo, lev, 'Value (PhP000)', t, v FROM s"""


def fisheries(spark: SparkSession, sf: str, freq: str) -> DataFrame:
    keys = {"Geolocation": flag_geo(), "Subsector": F.concat(F.lit("..Sub "), F.col("l_linenumber").cast("string"))}
    heads = agri_heads(spark, sf)
    cells = agri_cells(spark, sf, keys, quantity=total("l_quantity", 2), price=total("l_extendedprice", 2))
    sheet = lambda c: pivot_wide(
        cells, ["Geolocation", "Subsector"], "h", c, heads)
    return AG.build_fisheries(
        {"Volume (MT)": sheet("quantity"), "Value (PhP000)": sheet("price")}, freq)


for _freq, _word in (("Annual", "annual"), ("Quarter", "quarterly")):
    query(f"d23_livestock_{_word}", livestock_sql(_freq))(
        lambda spark, sf, freq=_freq: livestock(spark, sf, freq))
    query(f"d24_fisheries_{_word}", fisheries_sql(_freq))(
        lambda spark, sf, freq=_freq: fisheries(spark, sf, freq))


# -- inspection and compilation -----------------------------------------------------------

D25_SQL = ctes(FACT) + """,
f AS (SELECT *, 'imts_' || lower(direction) || '_' || year || '.csv' AS file FROM fact),
y AS (SELECT direction, year, row_number() OVER w AS k, count(*) OVER (PARTITION BY direction) AS n
      FROM (SELECT DISTINCT direction, year FROM fact) WINDOW w AS (PARTITION BY direction ORDER BY year)),
p AS (SELECT direction, year FROM y WHERE k IN (1, (n + 1) // 2, n)),
u AS (SELECT DISTINCT file, direction, year, code FROM f JOIN p USING (direction, year)),
h AS (SELECT file, direction, year, length(code) AS len, count(*) AS n FROM u GROUP BY ALL),
s AS (SELECT *, row_number() OVER (PARTITION BY file ORDER BY code) AS k FROM u)
SELECT file, CASE direction WHEN 'Exports' THEN 3 ELSE 4 END AS ncol,
       'Commodity Code | Country | ' || CASE direction WHEN 'Exports' THEN year || ' FOB Value (USD)'
         ELSE year || ' Quantity | ' || year || ' CIF Value (USD)' END AS columns,
       CAST(sum(n) AS BIGINT) AS n_codes, string_agg(len || ':' || n, ', ' ORDER BY len) AS length_dist,
       (SELECT string_agg(code, ', ' ORDER BY k) FROM s WHERE s.file = h.file AND k <= 6) AS samples,
       (SELECT count(DISTINCT country) FROM fact) AS n_labels
FROM h GROUP BY file, direction, year"""


@query("d25_inspect", D25_SQL)
def d25(spark: SparkSession, sf: str) -> DataFrame:
    found = PU.inspect(spark, landed_vintages(spark, sf))
    labels = found["labels"].agg(F.count("*")).scalar()
    return found["signatures"].join(found["codes"], "file").withColumn("n_labels", labels)


# builder and SQL of every dashboard table
DASHBOARD = {
    "SNA2000_Quarterly_Exp": (lambda s, f: accounts(s, f, "Expenditure", "quarter"),
                              accounts_sql("Expenditure", "quarter")),
    "SNA2000_Quarterly_Ind": (lambda s, f: accounts(s, f, "Industry", "quarter"),
                              accounts_sql("Industry", "quarter")),
    "SNA2000_Quarterly_PC": (d10, D10_SQL),
    "inflation_small": (d11_small, D11_SMALL),
    "inflation_main": (d11_main, D11_MAIN),
    "inflation_core": (d11_core, D11_CORE),
    "deflators": (d13, D13_SQL),
    "labor": (d14, D14_SQL),
    "ngcor": (ngcor, ngcor_sql("mean")),
    "ngdebt": (d17, D17_SQL),
    "tax_types": (d18, D18_SQL),
    "crops_annual": (lambda s, f: crops(s, f, "Annual"), crops_sql("Annual")),
    "livestock_annual": (lambda s, f: livestock(s, f, "Annual"), livestock_sql("Annual")),
    "fisheries_annual": (lambda s, f: fisheries(s, f, "Annual"), fisheries_sql("Annual")),
    "value_production_quarterly": (d21, D21_SQL),
    "self_sufficiency_annual": (d22, D22_SQL),
    "prices_monthly": (d20_national, D20_NATIONAL),
    "trade_annual": (None, ANNUAL_SQL),
    "trade_by_partner": (None, PARTNER_SQL),
    "trade_by_region": (None, REGION_SQL),
    "trade_by_commodity": (None, COMMODITY_SQL),
    "trade_semiconductors": (None, SEMI_SQL),
}
D26_SQL = contents_sql({name: sql for name, (_, sql) in DASHBOARD.items()})


@query("d26_compile", D26_SQL)
def d26(spark: SparkSession, sf: str) -> DataFrame:
    """Contents of all published tables, as read from the published files."""
    tables = T.build_trade(trade_fact(spark, sf))
    tables |= {n: build(spark, sf) for n, (build, _) in DASHBOARD.items() if build}
    folder = fresh_dir(spark, "dashboard")
    PU.compile_dashboard(tables, folder)
    return contents(read_version(spark, folder))
