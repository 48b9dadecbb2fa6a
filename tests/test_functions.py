from datetime import date

import pytest
from pyspark.sql import functions as F

from statloom.functions import dates as D
from statloom.functions import labels as L
from statloom.functions import nested as N
from statloom.functions import numbers as X
from statloom.functions import text as S


def one(spark, col, *values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")
    return [r[0] for r in df.orderBy("i").select(col).collect()]


@pytest.mark.parametrize("text, number", [
    ("1,234.50", 1234.5), ("-3", -3.0), (".", None), ("a/", None), ("..", None), (None, None),
    ("12 p", 12.0), ("about 7 or 8", 7.0), (".5", 0.5), ("", None), ("5.", 5.0)])
def test_parse_number(spark, text, number):
    assert one(spark, S.parse_number("c"), text) == [number]


def test_squish_takes_all_blanks(spark):
    assert one(spark, S.squish("c"), "  a \t b \n c ") == ["a b c"]


def test_remove_first_only(spark):
    assert one(spark, S.remove_first("c", "a+"), "baaba", "xyz") == ["bba", "xyz"]
    assert one(spark, S.remove_first("c", "^b"), "bb", "ab") == ["b", "ab"]
    assert one(spark, S.remove_all("c", "a"), "banana") == ["bnn"]


def test_extract_gives_null_without_match(spark):
    assert one(spark, S.extract("c", r"\d{4}"), "in 1999 and 2000", "none") == ["1999", None]


def test_slug_and_names(spark):
    titles = ["Cereals: Farmgate Prices by Geolocation", "Livestock and Poultry (Household): RETAIL prices",
              "Rice by Place"]
    assert one(spark, S.slug("c"), *titles) == ["Cereals", "Livestock-and-Poultry-Household", "Rice"]
    assert one(spark, S.safe_name("c"), " A/B  c.") == ["a_b_c"]
    assert one(spark, S.ident("c"), "Surplus/(Deficit) - net") == ["SurplusDeficitnet"]


def test_strip_code_prefix_is_greedy(spark):
    assert one(spark, S.strip_code_prefix("c"), "01.1 - FOOD - OTHER", "ALL ITEMS") == ["OTHER", "ALL ITEMS"]


def test_pad_and_join(spark):
    assert one(spark, S.pad("c", 2), "7", "123", None) == ["07", "123", None]
    assert one(spark, S.join_text(" ", "c", F.lit("x")), "a", None) == ["a x", None]


def test_casts_never_fail(spark):
    assert one(spark, S.as_double("c"), " 1.5 ", "x", None) == [1.5, None, None]
    assert one(spark, S.as_int("c"), "7", "7.x") == [7, None]


@pytest.mark.parametrize("fmt, text, day", [
    ("%Y %b", "1995 Mar", date(1995, 3, 1)), ("%B %Y", "March 1995", date(1995, 3, 1)),
    ("%Y", "1995", date(1995, 1, 1)), ("%Y-%m-%d", "1995-03-02", date(1995, 3, 2)),
    ("%Y %b", "1995 Ave", None), ("%Y", "199x", None), ("%B %Y", "Marchy 1995", None)])
def test_parse_date(spark, fmt, text, day):
    assert one(spark, D.parse_date("c", fmt), text) == [day]


def test_quarters(spark):
    assert one(spark, D.yq("c"), "2000 Q1", "2000Q4", "2000 Q5", "x") == [
        date(2000, 1, 1), date(2000, 10, 1), None, None]


@pytest.mark.parametrize("label, kind, month", [
    ("Quarter 2", "Quarter", 4), ("Q3", "Quarter", 7), ("Semester 2", "Semester", 7),
    ("January to March", "Cumulative", None), ("March", "Month", 3), ("", "Annual", 1),
    ("Annual", "Annual", 1), ("Average", "Other", None), ("Quarter", "Quarter", None)])
def test_period_parse(spark, label, kind, month):
    (p,) = one(spark, D.period_parse("c", F.lit(1999)), label)
    assert (p["period_type"], p["month"], p["date"]) == (kind, month, date(1999, month or 1, 1))


def test_period_outside_the_calendar_has_no_date(spark):
    (p,) = one(spark, D.period_parse("c", F.lit(1999)), "Quarter 9")
    assert p["period_type"] == "Quarter" and p["date"] is None


def test_header_year(spark):
    heads = ["1990 January", "January 1990", "At Constant 2018 Prices 2003", "At Current Prices 2003"]
    assert one(spark, D.header_year("c"), *heads) == [1990, 1990, 2003, 2003]


def test_hierarchy(spark):
    names = ["PHILIPPINES", "..Region", "....Province", ".x", None]
    assert one(spark, L.geo_level("c"), *names) == ["National", "Region", "Province", "National", "National"]
    assert one(spark, L.depth("c"), *names) == [0, 2, 4, 1, None]
    assert one(spark, L.strip_dots("c"), *names) == ["PHILIPPINES", "Region", "Province", "x", None]


def test_label_rules(spark):
    assert one(spark, L.recode("c", {"a": "A"}), "a", "b", None) == ["A", "b", None]
    assert one(spark, L.in_set("c", ["a"]), "a", "b", None) == [True, False, False]
    assert one(spark, L.match_index("c", ["x", "a"]), "a", "b", None) == [2, None, None]


def test_ratio_and_rounding(spark):
    assert one(spark, X.ratio(F.lit(1.0), S.as_double("c")), "4", "0", None) == [0.25, None, None]
    assert one(spark, X.round_even(S.as_double("c")), "0.5", "1.5", "2.5", "-0.5") == [0, 2, 2, 0]
    assert one(spark, X.coalesce_to(S.as_double("c"), 9.0), "x", "1") == [9.0, 1.0]


def test_total_is_exact(spark):
    df = spark.range(1000).select((F.lit(0.1)).alias("v")).repartition(7)
    assert df.agg(X.total("v", 2)).first()[0] == 100.0


def test_json_dims(spark):
    doc = '{"variables":[{"code":"Year","values":["0","1"]},{"code":"Item","values":[]}]}'
    assert [tuple(d) for d in one(spark, N.json_dims("c"), doc)[0]] == [("Year", 2), ("Item", 0)]
