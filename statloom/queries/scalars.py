"""Scalar functions over whole text and date columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import labels as L
from ..functions import nested as N
from ..functions import numbers as X
from ..functions import text as S
from ..operators.reshape import unpivot_periods
from .common import GDP, GRID, LINES, MONTH, ctes, gdp, lines, sql_list, table, wide_monthly
from .registry import query

WHITE = r"[\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


@query("f1_squish", f"""
SELECT doc_id, trim(regexp_replace(text, '{WHITE}', ' ', 'g')) AS squished FROM documents""")
def f1(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", S.squish("text").alias("squished"))


@query("f2_case", """
SELECT p_partkey, upper(p_name) AS upper_name, lower(p_brand) AS lower_brand,
       list_aggregate(list_transform(string_split(p_name, ' '),
         lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), 'string_agg', ' ') AS title_name
FROM part""")
def f2(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        "p_partkey", S.upper("p_name").alias("upper_name"), S.lower("p_brand").alias("lower_brand"),
        S.title("p_name").alias("title_name"))


@query("f3_replace", """
SELECT doc_id, regexp_replace(text, '[aeiou]+', '') AS first_removed,
       regexp_replace(text, '[aeiou]+', '', 'g') AS all_removed,
       regexp_replace(text, '[.,] *', '; ') AS first_replaced
FROM documents""")
def f3(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(
        "doc_id", S.remove_first("text", "[aeiou]+").alias("first_removed"),
        S.remove_all("text", "[aeiou]+").alias("all_removed"),
        S.replace_first("text", "[.,] *", "; ").alias("first_replaced"))


@query("f4_extract", """
SELECT page_id, CASE WHEN regexp_matches(url, '\\d{2,}') THEN regexp_extract(url, '\\d{2,}') END
         AS number_text,
       CASE WHEN regexp_matches(url, '/([a-z]{2})/') THEN regexp_extract(url, '/([a-z]{2})/', 1) END
         AS language,
       regexp_matches(url, '\\?page=') AS is_paged
FROM pages""")
def f4(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select(
        "page_id", S.extract("url", r"\d{2,}").alias("number_text"),
        S.extract("url", "/([a-z]{2})/", 1).alias("language"),
        S.detect("url", r"\?page=").alias("is_paged"))


@query("f5_parts", """
SELECT s_suppkey, substr(s_name, 1, 4) AS head, CAST(length(s_name) AS INTEGER) AS n,
       CASE WHEN length(CAST(s_nationkey AS VARCHAR)) >= 2 THEN CAST(s_nationkey AS VARCHAR)
            ELSE lpad(CAST(s_nationkey AS VARCHAR), 2, '0') END AS padded,
       string_split(s_name, '#')[2] AS tail, s_name || ' / ' || s_nationkey AS joined
FROM supplier""")
def f5(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "supplier").select(
        "s_suppkey", S.sub("s_name", 1, 4).alias("head"), S.nchar("s_name").alias("n"),
        S.pad("s_nationkey", 2).alias("padded"), S.split_at("s_name", "#", 2).alias("tail"),
        S.join_text(" / ", "s_name", "s_nationkey").alias("joined"))


@query("f6_names", r"""
WITH titled AS (
  SELECT p_partkey, p_name,
         p_name || ' (' || p_type || '): Farmgate Prices by Brand, ' || p_brand AS title FROM part)
SELECT p_partkey,
       regexp_replace(trim(regexp_replace(regexp_replace(
         regexp_replace(regexp_replace(title, '(?i)(farmgate|wholesale|retail).*$', ''),
                        '(?i)\bby\b.*$', ''),
         '[():,/]', ' ', 'g'), '\s+', ' ', 'g')), '\s+', '-', 'g') AS slug,
       lower(regexp_replace(regexp_replace(title, '[^A-Za-z0-9]+', '_', 'g'), '^_|_$', '', 'g'))
         AS safe_name,
       regexp_replace(title, '\s|-|/|\(|\)', '', 'g') AS ident
FROM titled""")
def f6(spark: SparkSession, sf: str) -> DataFrame:
    title = F.concat("p_name", F.lit(" ("), "p_type", F.lit("): Farmgate Prices by Brand, "), "p_brand")
    return table(spark, sf, "part").withColumn("title", title).select(
        "p_partkey", S.slug("title").alias("slug"), S.safe_name("title").alias("safe_name"),
        S.ident("title").alias("ident"))


@query("f7_parse_number", r"""
SELECT doc_id, TRY_CAST(regexp_extract(replace(text, ',', ''), '-?(?:\d+\.?\d*|\.\d+)', 0) AS DOUBLE)
  AS first_number
FROM documents""")
def f7(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", S.parse_number("text").alias("first_number"))


@query("f8_casts", r"""
SELECT o_orderkey, TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS level,
       TRY_CAST(o_orderpriority AS DOUBLE) AS bad_double,
       TRY_CAST(CAST(o_orderkey AS VARCHAR) || '.25' AS DOUBLE) AS shifted
FROM orders""")
def f8(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        "o_orderkey", S.as_int(F.substring("o_orderpriority", 1, 1)).alias("level"),
        S.as_double("o_orderpriority").alias("bad_double"),
        S.as_double(F.concat(F.col("o_orderkey").cast("string"), F.lit(".25"))).alias("shifted"))


@query("f9_parse_date", """
SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS by_abbr,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS by_name,
       CAST(date_trunc('year', o_orderdate) AS DATE) AS by_year,
       CAST(o_orderdate AS DATE) AS by_iso, CAST(NULL AS DATE) AS unfit
FROM orders""")
def f9(spark: SparkSession, sf: str) -> DataFrame:
    text = lambda p: F.date_format("o_orderdate", p)
    return table(spark, sf, "orders").select(
        "o_orderkey", D.parse_date(text("yyyy MMM"), "%Y %b").alias("by_abbr"),
        D.parse_date(text("MMMM yyyy"), "%B %Y").alias("by_name"),
        D.parse_date(text("yyyy"), "%Y").alias("by_year"),
        D.parse_date(text("yyyy-MM-dd"), "%Y-%m-%d").alias("by_iso"),
        D.parse_date("o_orderpriority", "%Y %b").alias("unfit"))


@query("f10_quarters", """
SELECT o_orderkey, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS from_text,
       CAST(date_trunc('quarter', o_orderdate) AS DATE) AS from_date,
       CAST(quarter(o_orderdate) AS INTEGER) AS number
FROM orders""")
def f10(spark: SparkSession, sf: str) -> DataFrame:
    text = F.concat(F.year("o_orderdate").cast("string"), F.lit(" Q"),
                    F.quarter("o_orderdate").cast("string"))
    return table(spark, sf, "orders").select(
        "o_orderkey", D.yq(text).alias("from_text"),
        D.quarter_start("o_orderdate").alias("from_date"), F.quarter("o_orderdate").alias("number"))


@query("f11_period_parse", """
WITH p AS (
  SELECT o_orderkey, o_orderdate AS d, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS k FROM orders)
SELECT o_orderkey,
       CASE k WHEN 1 THEN 'Quarter' WHEN 2 THEN 'Semester' WHEN 3 THEN 'Cumulative'
              WHEN 4 THEN 'Month' WHEN 5 THEN 'Annual' ELSE 'Other' END AS period_type,
       CAST(CASE k WHEN 1 THEN (quarter(d) - 1) * 3 + 1 WHEN 2 THEN CASE WHEN month(d) > 6 THEN 7 ELSE 1 END
              WHEN 4 THEN month(d) WHEN 5 THEN 1 END AS INTEGER) AS month,
       CASE k WHEN 1 THEN CAST(date_trunc('quarter', d) AS DATE)
              WHEN 2 THEN make_date(year(d), CASE WHEN month(d) > 6 THEN 7 ELSE 1 END, 1)
              WHEN 4 THEN CAST(date_trunc('month', d) AS DATE)
              ELSE make_date(year(d), 1, 1) END AS date
FROM p""")
def f11(spark: SparkSession, sf: str) -> DataFrame:
    d = F.col("o_orderdate")
    half = F.when(F.month(d) > 6, "2").otherwise("1")
    kind = F.substring("o_orderpriority", 1, 1)
    label = (
        F.when(kind == "1", F.concat(F.lit("Quarter "), F.quarter(d).cast("string")))
        .when(kind == "2", F.concat(F.lit("Semester "), half))
        .when(kind == "3", F.concat(F.lit("January to "), F.date_format(d, "MMMM")))
        .when(kind == "4", F.date_format(d, "MMMM")).when(kind == "5", "Annual").otherwise("n.a."))
    return table(spark, sf, "orders").select(
        "o_orderkey", D.period_parse(label, F.year(d)).alias("p")).select("o_orderkey", "p.*")


@query("f12_date_seq", """
SELECT o_custkey, CAST(unnest(generate_series(date_trunc('quarter', min(o_orderdate)),
         date_trunc('quarter', max(o_orderdate)), INTERVAL 3 MONTH)) AS DATE) AS quarter_start
FROM orders GROUP BY o_custkey""")
def f12(spark: SparkSession, sf: str) -> DataFrame:
    lo, hi = (D.quarter_start(f("o_orderdate")) for f in (F.min, F.max))
    ends = table(spark, sf, "orders").groupBy("o_custkey").agg(lo.alias("lo"), hi.alias("hi"))
    return ends.select("o_custkey", F.explode(D.date_seq("lo", "hi", "quarter")).alias("quarter_start"))


@query("f13_hierarchy", r"""
WITH dotted AS (
  SELECT p_partkey, CASE p_type WHEN 'SMALL' THEN '....' WHEN 'MEDIUM' THEN '..' WHEN 'LARGE' THEN '.'
         WHEN 'PROMO' THEN '......' ELSE '' END AS dots, p_name FROM part)
SELECT p_partkey, CASE WHEN length(dots) >= 4 THEN 'Province' WHEN length(dots) >= 2 THEN 'Region'
         ELSE 'National' END AS level,
       CAST(length(dots) AS INTEGER) AS depth, p_name AS label
FROM dotted""")
def f13(spark: SparkSession, sf: str) -> DataFrame:
    dots = L.recode("p_type", {
        "SMALL": "....", "MEDIUM": "..", "LARGE": ".", "PROMO": "......", "ECONOMY": "", "STANDARD": ""})
    df = table(spark, sf, "part").withColumn("place", F.concat(dots, "p_name"))
    return df.select("p_partkey", L.geo_level("place").alias("level"), L.depth("place").alias("depth"),
                     L.strip_dots("place").alias("label"))


@query("f14_ratios", ctes(LINES, GDP) + """
SELECT flag, month, amount / nullif(quantity, 0) AS unit_value,
       amount / nullif(quantity, 0) * 100 AS per_hundred,
       amount / nullif(g.NominalGDP, 0) AS effort
FROM lines LEFT JOIN gdp g ON g.Quarter = date_trunc('quarter', month)""")
def f14(spark: SparkSession, sf: str) -> DataFrame:
    joined = lines(spark, sf).withColumn("Quarter", D.quarter_start("month")).join(
        gdp(spark, sf), "Quarter", "left")
    return joined.select(
        "flag", "month", X.ratio("amount", "quantity").alias("unit_value"),
        X.scaled(X.ratio("amount", "quantity"), 100.0).alias("per_hundred"),
        X.ratio("amount", "NominalGDP").alias("effort"))


@query("f15_round_even", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
       round_even(l_quantity / 2, 0) AS half_quantity, round_even(l_extendedprice, 0) AS whole,
       round_even(l_quantity / 4, 1) AS quarter_quantity
FROM lineitem""")
def f15(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        X.round_even(F.col("l_quantity") / 2).alias("half_quantity"),
        X.round_even("l_extendedprice").alias("whole"),
        X.round_even(F.col("l_quantity") / 4, 1).alias("quarter_quantity"))


@query("f16_coalesce", ctes(GRID) + """
SELECT series, month, coalesce(amount, 0) AS amount,
       CASE WHEN amount IS NULL THEN 'missing' WHEN amount > 1000000 THEN 'large' ELSE 'small' END AS kind
FROM grid""")
def f16(spark: SparkSession, sf: str) -> DataFrame:
    long = unpivot_periods(wide_monthly(spark, sf), "amount", MONTH)
    return long.select(
        "series", "month",
        X.coalesce_to("amount", 0.0).alias("amount"),
        L.classify([(F.col("amount").isNull(), "missing"), (F.col("amount") > 1000000, "large")],
                   "small").alias("kind"))


@query("f17_json_dims", """
SELECT CAST(n_nationkey AS BIGINT) AS owner, 'segment' AS code, CAST(count(DISTINCT c_mktsegment) AS INTEGER) AS size,
       CAST(1 AS BIGINT) AS documents
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1
UNION ALL
SELECT user_id, 'key', CAST(json_extract(props, '$.k') AS INTEGER), count(*)
FROM events WHERE json_extract(props, '$.k') IS NOT NULL GROUP BY ALL""")
def f17(spark: SparkSession, sf: str) -> DataFrame:
    """Metadata documents with a list for each dimension: of every nation its segments, of every event a list as long as its key."""

    def document(code: str, values: Column) -> Column:
        return F.to_json(F.struct(F.array(F.struct(F.lit(code).alias("code"), values.alias("values"))).alias("variables")))

    segments = table(spark, sf, "customer").groupBy(F.col("c_nationkey").cast("bigint").alias("owner")).agg(
        F.array_sort(F.collect_set("c_mktsegment")).alias("segments"))
    size = F.get_json_object("props", "$.k").cast("int")
    events = table(spark, sf, "events").where(size.isNotNull())
    docs = segments.select("owner", document("segment", F.col("segments")).alias("doc")).unionByName(
        events.select(F.col("user_id").alias("owner"), document("key", F.array_repeat(F.lit("v"), size)).alias("doc")))
    dims = N.explode_list(docs.select("owner", N.json_dims("doc").alias("dims")), "dims", "dim")
    return dims.groupBy("owner", F.col("dim.code").alias("code"), F.col("dim.size").alias("size")).agg(F.count("*").alias("documents"))


@query("f18_normalise", r"""
SELECT o_orderkey, regexp_replace(o_orderpriority, '^.+\-', '') AS no_prefix,
       regexp_replace('0.1 - ' || o_orderpriority || ' - ' || o_orderstatus, '^.+\-\s', '') AS last_part,
       regexp_replace(o_orderpriority, 'NOT ', '') AS no_word
FROM orders""")
def f18(spark: SparkSession, sf: str) -> DataFrame:
    label = F.concat(F.lit("0.1 - "), "o_orderpriority", F.lit(" - "), "o_orderstatus")
    return table(spark, sf, "orders").select(
        "o_orderkey", S.remove_first("o_orderpriority", r"^.+\-").alias("no_prefix"),
        S.strip_code_prefix(label).alias("last_part"),
        S.normalise_label("o_orderpriority", "NOT ").alias("no_word"))


@query("f19_arrays", f"""
SELECT p_partkey, p_type IN ('SMALL', 'MEDIUM', 'LARGE') AS is_sized,
       CAST(nullif(coalesce(list_position({sql_list(['SMALL', 'MEDIUM', 'LARGE'])}, p_type), 0), 0)
            AS INTEGER) AS size_rank,
       unnest(string_split(p_name, ' ')) AS word
FROM part""")
def f19(spark: SparkSession, sf: str) -> DataFrame:
    sizes = ["SMALL", "MEDIUM", "LARGE"]
    df = table(spark, sf, "part").select(
        "p_partkey", L.in_set("p_type", sizes).alias("is_sized"),
        L.match_index("p_type", sizes).alias("size_rank"), F.split("p_name", " ").alias("words"))
    return N.explode_list(df, "words", "word")
