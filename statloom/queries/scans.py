"""Scans, landing jobs and sinks, over files that Spark first writes from the tables."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import total
from ..functions.text import as_double, squish
from ..operators.frames import union_labeled
from ..operators.joins import pending
from ..operators.reshape import period_columns, unpivot_except
from ..plans import trade as T
from ..sources import landing as G
from ..sources import leading as L
from ..sources import scan as S
from ..sources import sinks as K
from ..sources.workspace import fresh_dir
from ..streaming.resume import land_new_files
from .common import (
    ANNUAL, COMMODITY, FACT, GRID, LINES, PARTNER, ctes, lines, monthly, table, trade_fact,
    wide_monthly,
)
from .registry import query

WRITERS = 8


def csv_out(df: DataFrame, path: str) -> str:
    df.write.option("header", True).csv(path)
    return path


def marked(df: DataFrame, mark: str = "..") -> DataFrame:
    """Text cells with a marker in place of a missing number, as such tables come."""
    return df.fillna(mark)


def landed_wide(spark: SparkSession, sf: str, mark: str = "..") -> str:
    return csv_out(marked(wide_monthly(spark, sf), mark), fresh_dir(spark, "wide"))


@query("s1_scan_strings", ctes(GRID) + """
SELECT series, strftime(month, '%Y %b') AS period, cell FROM grid""")
def s1(spark: SparkSession, sf: str) -> DataFrame:
    df = S.scan_strings(spark, landed_wide(spark, sf, "..."), S.AGRI_MARKS)
    return unpivot_except(df, ["series"], "period", "cell", None)


@query("s2_scan_typed", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate
FROM orders""")
def s2(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        F.to_date("o_orderdate").alias("o_orderdate"))
    path = csv_out(df, fresh_dir(spark, "typed"))
    return S.scan_typed(spark, path, df.schema)


# folder pairs of the tree, each filled with the items of one flag
TREE = {
    "A": ("Farmgate Prices", "New Series"),
    "N": ("Wholesale Prices", "Old Series"),
    "R": ("Retail Prices", "2018-based (New Geo Code)"),
}


def landed_tree(spark: SparkSession, sf: str) -> str:
    root = fresh_dir(spark, "tree")
    for flag, (kind, series) in TREE.items():
        rows = lines(spark, sf).where(F.col("flag") == flag).select("month", "quantity", "amount")
        csv_out(rows, f"{root}/{kind}/{series}/monthly.csv")
    return root


@query("s3_scan_tree", ctes(LINES) + """
SELECT CASE flag WHEN 'A' THEN 'Farmgate Prices' WHEN 'N' THEN 'Wholesale Prices'
       ELSE 'Retail Prices' END AS "PriceType",
       CASE flag WHEN 'A' THEN 'New Series' WHEN 'N' THEN 'Old Series'
       ELSE '2018-based (New Geo Code)' END AS "Series", month, quantity, amount
FROM lines""")
def s3(spark: SparkSession, sf: str) -> DataFrame:
    groups = S.scan_tree(spark, landed_tree(spark, sf), ["PriceType", "Series"])
    (df,) = groups.values()
    return df.select("PriceType", "Series", F.col("month").cast("date").alias("month"),
                     as_double("quantity").alias("quantity"), as_double("amount").alias("amount"))


def landed_vintages(spark: SparkSession, sf: str) -> dict[str, list[str]]:
    """Leaf records as one CSV folder per year and direction, the year in the value header."""
    root = fresh_dir(spark, "records")
    trade_fact(spark, sf).write.partitionBy("direction", "year").parquet(f"{root}/fact")
    fact = spark.read.parquet(f"{root}/fact")
    years = range(*[x + i for i, x in enumerate(fact.agg(F.min("year"), F.max("year")).first())])

    def put(job: tuple[str, int]) -> str:
        direction, year = job
        valuation = {"Exports": "FOB", "Imports": "CIF"}[direction]
        extra = [F.lit(0).alias(f"{year} Quantity")] if direction == "Imports" else []
        rows = fact.where((F.col("direction") == direction) & (F.col("year") == year)).select(
            F.col("code").alias("Commodity Code"), F.col("country").alias("Country"), *extra,
            F.col("value").cast("decimal(18,2)").alias(f"{year} {valuation} Value (USD)"))
        return csv_out(rows, f"{root}/{direction}/imts_{direction.lower()}_{year}.csv")

    jobs = [(d, y) for d in ("Exports", "Imports") for y in years]
    with ThreadPoolExecutor(WRITERS) as pool:
        paths = dict(zip(jobs, pool.map(put, jobs)))
    return {d: [p for (direction, _), p in paths.items() if direction == d]
            for d in ("Exports", "Imports")}


@query("s4_scan_vintages", ctes(FACT) + """
SELECT year, direction, trim(regexp_replace(country, '\\s+', ' ', 'g')) AS country, code,
       count(*) AS records, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value
FROM fact GROUP BY ALL""")
def s4(spark: SparkSession, sf: str) -> DataFrame:
    rows = S.scan_vintages(spark, landed_vintages(spark, sf))
    return rows.groupBy("year", "direction", squish("country").alias("country"), "code").agg(
        F.count("*").alias("records"), total("value", 2).alias("value"))


@query("s5_scan_columns", """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_mktsegment FROM customer""")
def s5(spark: SparkSession, sf: str) -> DataFrame:
    path = csv_out(table(spark, sf, "customer"), fresh_dir(spark, "customer"))
    assert S.header_of(spark, path)[0] == "c_custkey"
    return S.scan_columns(spark, path, ["c_custkey", "c_mktsegment"])


@query("s6_grid_block", """
SELECT CAST(o_orderkey AS INTEGER) AS row_idx, CAST(o_custkey AS VARCHAR) AS customer,
       o_orderstatus AS status
FROM orders WHERE o_orderkey > 10""")
def s6(spark: SparkSession, sf: str) -> DataFrame:
    grid = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("int").alias("row_idx"),
        F.array(F.col("o_custkey").cast("string"), F.col("o_orderstatus"), F.col("o_orderpriority"))
        .alias("cells"))
    return S.grid_block(grid, 10, None, ["customer", "status"])


@query("s7_partition_valid", ctes(GRID) + """
SELECT 'accepted' AS status, 'wide' AS kind, count(*) AS cells FROM grid
UNION ALL SELECT 'no period columns', 'tall', count(*) FROM monthly
UNION ALL SELECT 'fewer than 1 category columns', 'bare', count(*) FROM grid""")
def s7(spark: SparkSession, sf: str) -> DataFrame:
    root = fresh_dir(spark, "layouts")
    df = marked(wide_monthly(spark, sf))
    kinds = {"wide": df, "tall": monthly(spark, sf), "bare": df.drop("series")}
    paths = [csv_out(d, f"{root}/{k}") for k, d in kinds.items()]
    layout = S.partition_valid(spark, paths)
    found = layout.rejects.unionByName(
        spark.createDataFrame([(p, "accepted") for p in layout.accepted], S.REJECTS_SCHEMA))
    cells = [
        S.csv_reader(spark).csv(p).agg(
            F.lit(p).alias("file"),
            (F.count("*") * max(len(period_columns(kinds[p.rsplit("/", 1)[-1]].columns)), 1))
            .cast("bigint").alias("cells")) for p in paths]
    sizes = cells[0].unionByName(cells[1]).unionByName(cells[2])
    return found.join(sizes, "file").select(
        F.col("reason").alias("status"), F.substring_index("file", "/", -1).alias("kind"), "cells")


@query("s8_valid_binary", """
SELECT DISTINCT c_nationkey, true AS is_parquet, false AS is_zip FROM customer""")
def s8(spark: SparkSession, sf: str) -> DataFrame:
    root = fresh_dir(spark, "binary")
    table(spark, sf, "customer").repartition("c_nationkey").write.partitionBy("c_nationkey").parquet(root)
    key = F.regexp_extract("path", "c_nationkey=(\\d+)", 1).cast("int").alias("c_nationkey")
    return L.leading(spark, [root], n=4, glob="*.parquet").select(
        key, L.has_magic(b"PAR1", 100).alias("is_parquet"), L.has_magic(b"PK", 100).alias("is_zip")).distinct()


BASE = "https://stats.example.org"
HREFS = "SELECT unnest(regexp_extract_all(html, '<a\\b[^>]*?\\bhref=\"([^\"]*)\"', 1)) AS href FROM pages"
LINKS = f"""links AS (
  SELECT DISTINCT CASE WHEN starts_with(href, 'http') THEN href ELSE '{BASE}' || href END AS link
  FROM ({HREFS}))"""


@query("s9_extract_links", ctes(LINKS) + """
SELECT link FROM links WHERE ends_with(link, 'on')""")
def s9(spark: SparkSession, sf: str) -> DataFrame:
    return G.extract_links(table(spark, sf, "pages"), "on", BASE)


PATTERNS = {"The": "/The$", "any_th": "/th", "numbers": r"\d{4}$", "none": "%no such link%"}


@query("s10_resolve_one", ctes(LINKS) + """,
p AS (SELECT * FROM (VALUES ('The', '/The$'), ('any_th', '/th'), ('numbers', '\\d{4}$'),
      ('none', '%no such link%')) t(name, rx)),
m AS (SELECT name, count(link) AS matches, min(link) AS first_link
      FROM p LEFT JOIN links ON regexp_matches(link, rx) GROUP BY name)
SELECT name, matches, CASE matches WHEN 0 THEN 'missing' WHEN 1 THEN 'unique' ELSE 'ambiguous' END AS status,
       CASE WHEN matches = 1 THEN first_link END AS link
FROM m""")
def s10(spark: SparkSession, sf: str) -> DataFrame:
    return G.resolve_one(G.extract_links(table(spark, sf, "pages"), "", BASE), PATTERNS)


RESOLVED = ctes(LINKS) + """,
p AS (SELECT DISTINCT '/' || c_mktsegment || '$' AS name, c_mktsegment AS word FROM customer
      UNION SELECT DISTINCT link, regexp_extract(link, '/([^/]*)$', 1) FROM links WHERE regexp_matches(link, '/[a-z]+$')),
m AS (SELECT name, link FROM p JOIN links ON ends_with(link, '/' || word)),
n AS (SELECT name, count(link) AS matches, min(link) AS first_link FROM p LEFT JOIN m USING (name) GROUP BY name)"""


def link_patterns(links: DataFrame, spark: SparkSession, sf: str) -> DataFrame:
    """A pattern for the last part of every link in small letters, and some that match nothing."""
    word = F.regexp_extract("link", "/([^/]*)$", 1)
    made = links.where(F.col("link").rlike("/[a-z]+$")).select(F.col("link").alias("name"), F.concat(F.lit("/"), word, F.lit("$")).alias("pattern"))
    none = table(spark, sf, "customer").select(F.concat(F.lit("/"), "c_mktsegment", F.lit("$")).alias("name")).distinct()
    return made.unionByName(none.select("name", F.col("name").alias("pattern")))


@query("s10_resolve_first", RESOLVED + """
SELECT name, matches, CASE matches WHEN 0 THEN 'missing' WHEN 1 THEN 'unique' ELSE 'ambiguous' END AS status, first_link AS link FROM n""")
def s10_first(spark: SparkSession, sf: str) -> DataFrame:
    links = G.extract_links(table(spark, sf, "pages"), "", BASE)
    return G.resolve_links(links, link_patterns(links, spark, sf), "first")


@query("s10_resolve_all", RESOLVED + """
SELECT name, matches, CASE matches WHEN 0 THEN 'missing' WHEN 1 THEN 'unique' ELSE 'ambiguous' END AS status, link
FROM n LEFT JOIN m USING (name)""")
def s10_all(spark: SparkSession, sf: str) -> DataFrame:
    links = G.extract_links(table(spark, sf, "pages"), "", BASE)
    return G.resolve_links(links, link_patterns(links, spark, sf), "all")


@query("s11_list_vintages", """
SELECT DISTINCT o_orderstatus || '-' || year(o_orderdate) AS id,
       'Value of orders ' || year(o_orderdate) || ' by status' AS text,
       CAST(year(o_orderdate) AS INTEGER) AS year
FROM orders WHERE year(o_orderdate) >= 1996""")
def s11(spark: SparkSession, sf: str) -> DataFrame:
    y = F.date_format("o_orderdate", "yyyy")
    titles = table(spark, sf, "orders").select("o_orderstatus", y.alias("y")).distinct().select(
        "o_orderstatus", F.concat_ws("-", "o_orderstatus", "y").alias("id"),
        F.when(F.col("y") == "1995", "l").otherwise("t").alias("type"),
        F.concat(F.lit("Value of orders "), "y", F.lit(" by status")).alias("text"))
    # one listing per status; its entries are bounded by the years of the calendar
    listing = titles.groupBy("o_orderstatus").agg(
        F.to_json(F.collect_list(F.struct("id", "type", "text"))).alias("listing"))
    return G.list_vintages(listing, "listing")


@query("s12_request_grid", """
WITH y AS (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year FROM orders),
g AS (SELECT year, year - (SELECT min(year) FROM y) AS year_pos, CAST(p AS INTEGER) AS period
      FROM y CROSS JOIN range(13) r(p))
SELECT *, '{"query":[{"code":"Year","selection":{"filter":"item","values":["' || year_pos ||
  '"]}},{"code":"Period","selection":{"filter":"item","values":["' || period ||
  '"]}}],"response":{"format":"csv"}}' AS body
FROM g""")
def s12(spark: SparkSession, sf: str) -> DataFrame:
    return G.request_grid(table(spark, sf, "orders").select(F.year("o_orderdate").alias("y")), "y")


BATCH_DIMS = {
    "lineitem": ["l_suppkey", "l_linenumber"],
    "customer": ["c_nationkey", "c_mktsegment"],
}


@query("s13_plan_batches", """
WITH v AS (
  SELECT 'lineitem' AS "table", 'l_suppkey' AS dim, lpad(CAST(l_suppkey AS VARCHAR), 9, '0') AS value FROM lineitem
  UNION SELECT 'lineitem', 'l_linenumber', lpad(CAST(l_linenumber AS VARCHAR), 9, '0') FROM lineitem
  UNION SELECT 'customer', 'c_nationkey', lpad(CAST(c_nationkey AS VARCHAR), 9, '0') FROM customer
  UNION SELECT 'customer', 'c_mktsegment', c_mktsegment FROM customer),
z AS (SELECT "table", dim, count(*) AS size FROM v GROUP BY ALL),
t AS (SELECT "table", CAST(product(size) AS BIGINT) AS cells, arg_max(dim, size) AS dim, max(size) AS size
      FROM z GROUP BY 1),
p AS (SELECT *, cells // size AS slice FROM t),
q AS (SELECT *, CASE WHEN cells <= 45 THEN 'one request' WHEN slice > 45 THEN 'slice too large'
        ELSE 'batched' END AS status FROM p),
k AS (SELECT q.*, value, row_number() OVER (PARTITION BY q."table" ORDER BY value) AS k
      FROM v JOIN q ON v."table" = q."table" AND v.dim = q.dim),
b AS (SELECT *, CASE status WHEN 'one request' THEN 1
        WHEN 'batched' THEN (k - 1) // greatest(1, 45 // slice) + 1 END AS batch FROM k)
SELECT "table", dim, status, cells, CAST(batch AS INTEGER) AS batch, count(*) AS n_values,
       min(value) AS first_value, max(value) AS last_value, count(*) * max(slice) AS batch_cells,
       CASE WHEN status <> 'slice too large' THEN string_agg(value, ',' ORDER BY value) END AS "values"
FROM b GROUP BY "table", dim, status, cells, batch""")
def s13(spark: SparkSession, sf: str) -> DataFrame:
    parts = []
    for name, dims in BATCH_DIMS.items():
        for d in dims:
            text = F.col(d) if d == "c_mktsegment" else F.lpad(F.col(d).cast("string"), 9, "0")
            parts.append(table(spark, sf, name).select(
                F.lit(name).alias("table"), F.lit(d).alias("dim"), text.alias("value")))
    values = parts[0]
    for p in parts[1:]:
        values = values.unionByName(p)
    plan = G.plan_batches(values, 50, 0.9)
    listed = F.when(F.size("values") > 0, F.array_join("values", ","))
    return plan.withColumns({"cells": F.col("cells").cast("bigint"), "batch_cells": F.col("batch_cells").cast("bigint"), "values": listed})


@query("s14_pending", """
SELECT CASE o_orderstatus WHEN 'P' THEN 'pending' ELSE 'landed' END AS state,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS n
FROM orders GROUP BY 1, 2""")
def s14(spark: SparkSession, sf: str) -> DataFrame:
    """Two landing runs into one target, then what is still wanted."""
    root = fresh_dir(spark, "landing")
    rows = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus", F.to_date("o_orderdate").alias("o_orderdate"))
    for status in ("F", "O"):
        rows.where(F.col("o_orderstatus") == status).write.mode("append").option(
            "header", True).csv(f"{root}/in")
        land_new_files(spark, f"{root}/in", f"{root}/out", f"{root}/ck", rows.schema)
    landed = spark.read.schema(rows.schema).parquet(f"{root}/out")
    states = union_labeled(
        {"landed": landed, "pending": pending(rows, landed, ["o_orderkey"])}, "state")
    return states.groupBy("state", F.trunc("o_orderdate", "month").alias("month")).agg(
        F.count("*").alias("n"))


def bundle(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return T.build_trade(trade_fact(spark, sf))


@query("s16_write_bundle", ctes(PARTNER, COMMODITY) + """
SELECT unnest(list_sort(list(DISTINCT p.year))) AS year, 6 AS hs_digits, true AS include_pre_hs,
       (SELECT min(year) FROM commodity WHERE classification = 'HS') AS hs_era_from,
       (SELECT count(*) FROM partner) AS partner_rows
FROM partner p""")
def s16(spark: SparkSession, sf: str) -> DataFrame:
    tables = bundle(spark, sf)
    folder = fresh_dir(spark, "bundle")
    K.write_bundle(tables, T.trade_meta(tables), folder)
    back = K.read_bundle(spark, folder, ["meta", "trade_by_partner"])
    rows = back["trade_by_partner"].agg(F.count("*")).scalar()
    return back["meta"].select(
        F.explode("years").alias("year"), "hs_digits", "include_pre_hs", "hs_era_from",
        rows.alias("partner_rows"))


@query("s17_publish", ctes(PARTNER, ANNUAL) + """
SELECT year, Exports, Imports, Exports - Imports AS balance, Exports + Imports AS total_trade
FROM annual""")
def s17(spark: SparkSession, sf: str) -> DataFrame:
    folder = fresh_dir(spark, "published")
    names = K.publish(bundle(spark, sf), ["trade_annual"], folder)
    return K.read_bundle(spark, folder, names)["trade_annual"]


@query("s20_distinct_labels", ctes(FACT) + """
SELECT DISTINCT country FROM fact""")
def s20(spark: SparkSession, sf: str) -> DataFrame:
    folder = fresh_dir(spark, "labels")
    K.write_labels(K.distinct_labels(trade_fact(spark, sf), "country"), folder)
    return spark.read.text(folder).withColumnRenamed("value", "country")
