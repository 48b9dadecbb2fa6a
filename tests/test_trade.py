import itertools

import pytest
from pyspark.sql import functions as F

from statloom.plans import trade as T
from statloom.plans import trade_values as V
from statloom.sources.sinks import read_bundle, write_bundle

CANON = [
    ("United States of America", "UNITED STATES"), ("U.S.A.", "UNITED STATES"), ("Guam", "UNITED STATES"),
    ("Hongkong", "HONG KONG"), ("Macao", "MACAU"), ("Taiwan, Republic of China", "TAIWAN"),
    ("Japan (excludes Okinawa)", "JAPAN"), ("Korea, Dem. People's Rep. North", "KOREA, DPR (NORTH)"),
    ("Korea, Republic of", "KOREA, REP. (SOUTH)"), ("China, People's Rep.", "CHINA"),
    ("Mainland China", "CHINA"), ("German Opt. Ctry", "GERMAN OPT. CTRY"), ("West Germany 1/", "GERMANY"),
    ("UK Northern Ireland", "UNITED KINGDOM"), ("Soviet Union", "RUSSIA"),
    ("Netherlands Antilles", "NETHERLANDS ANTILLES"), ("Netherlands", "NETHERLANDS"),
    ("Czechoslovakia", "CZECH REPUBLIC"), ("Slovak Republic", "SLOVAKIA"), ("Viet Nam", "VIETNAM"),
    ("Brunei", "BRUNEI DARUSSALAM"), ("Lao PDR", "LAOS"), ("Burma", "MYANMAR"), ("Kampuchea", "CAMBODIA"),
    ("Indonesia", "INDONESIA"), ("Sabah", "MALAYSIA"), ("U.A.E.", "UNITED ARAB EMIRATES"),
    ("Iran, Islamic Rep.", "IRAN"), ("Brazil.,", "BRAZIL"), ("  Papua   New Guinea 2/ ", "PAPUA NEW GUINEA"),
    (None, None),
]
REGIONS = [
    ("ROMANIA", "Europe"), ("OMAN", "Middle East"), ("NETHERLANDS ANTILLES", "Rest of world"),
    ("FRENCH GUIANA", "Rest of world"), ("JAPAN", "East Asia"), ("LAOS", "ASEAN"), ("CANADA", "North America"),
    ("AUSTRALIA", "Oceania"), ("BRITISH INDIAN OCEAN TERRITORY", "South Asia"), ("BRAZIL", "Rest of world"),
    (None, "Rest of world"),
]


def apply(spark, fn, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, c string")
    return [r[0] for r in df.orderBy("i").select(fn("c")).collect()]


def test_canonical_countries(spark):
    assert apply(spark, T.canon_country, [a for a, _ in CANON]) == [b for _, b in CANON]


def test_regions(spark):
    assert apply(spark, T.region_of, [a for a, _ in REGIONS]) == [b for _, b in REGIONS]


def test_residual_looks_at_the_raw_label(spark):
    labels = ["South and Southeast Asia, n.e.s.", "United Arab Emirates, N.E.S.", "German Opt. Ctry", "Japan"]
    assert apply(spark, T.is_residual, labels) == [True, False, True, False]


def test_codes(spark):
    codes = ["8541290000", "7108120000", "2601110000", "7907000000", "8471300000", "2601110", None, "7701000000"]
    assert apply(spark, T.hs_era, codes) == ["HS"] * 5 + ["pre-HS", None, "HS"]
    assert apply(spark, T.code_key, codes)[:6] == ["854129", "710812", "260111", "790700", "847130", "2601110"]
    assert apply(spark, T.is_semi, codes)[:5] == [True, False, False, False, False]
    assert apply(spark, T.is_mineral, codes)[:6] == [False, True, True, True, False, False]
    assert apply(spark, T.mineral_type, codes)[1:4] == [
        "Gold (7108)", "Metal ores & concentrates (26)", "Lead, zinc & tin (78-80)"]
    assert apply(spark, T.chapter_label, ["01", "77", "99"]) == [
        "Live animals", "Chapter 77", "Special / other (national)"]
    assert apply(spark, T.chapter_group, ["05", "77", "00", "xx", "99"]) == [
        "Animal products", "Base metals", V.NO_GROUP, V.NO_GROUP, "Instruments & misc manufactures"]


def test_chapter_table_is_complete():
    assert sorted(V.CHAPTER_LABELS) == [f"{i:02d}" for i in range(1, 100) if i != 77]
    spans = sorted((a, b) for a, b, _ in V.CHAPTER_GROUPS)
    assert spans[0][0] == 1 and spans[-1][1] == 99
    assert all(b + 1 == c for (_, b), (c, _) in itertools.pairwise(spans))


FACT = [
    (1999, "Exports", "Japan 1/", "8541290000", 10.25), (1999, "Exports", "Japan (excludes Okinawa)", "8541300000", 0.25),
    (1999, "Exports", "Philippine waters, N.E.S.", "0101100000", 5.0), (1999, "Imports", "China", "1234567", 7.5),
    (1999, "Imports", "China", "7108120000", 2.0), (2000, "Imports", "India", "2601110000", 3.0),
    (1999, "Exports", "Japan", "0101", -4.0), (1999, "Exports", "Japan", "0101", None),
    (2000, "Exports", "India", None, 1.0),
]


@pytest.fixture(scope="module")
def tables(spark):
    df = spark.createDataFrame(FACT, "year int, direction string, country string, code string, value double")
    return T.build_trade(df)


def test_partner_table(tables):
    got = {(r["year"], r["direction"], r["country"], r["is_resid"]): r["value_usd"]
           for r in tables["trade_by_partner"].collect()}
    assert got == {
        (1999, "Exports", "JAPAN", False): 10.0,  # 10.50 to even
        (1999, "Exports", "PHILIPPINE WATERS, N.E.S", True): 5.0,
        (1999, "Imports", "CHINA", False): 10.0,  # 9.50 to even
        (2000, "Imports", "INDIA", False): 3.0, (2000, "Exports", "INDIA", False): 1.0}


def test_commodity_table(tables):
    got = {(r["year"], r["classification"], r["code"]): (r["chapter"], r["group"], r["value_usd"])
           for r in tables["trade_by_commodity"].collect()}
    assert got[(1999, "HS", "854129")] == ("85", "Machinery & electrical", 10.0)
    assert got[(1999, "PSCC", "1234567")] == (None, None, 8.0)
    assert len(got) == 6  # the record without a code is in no commodity row


def test_product_tables(tables):
    semi = tables["trade_semiconductors"].collect()
    assert [tuple(r) for r in semi] == [(1999, "Exports", "JAPAN", 10.0)]
    minerals = {(r["country"], r["mineral_type"]): r["value_usd"] for r in tables["trade_minerals"].collect()}
    assert minerals == {("CHINA", "Gold (7108)"): 2.0, ("INDIA", "Metal ores & concentrates (26)"): 3.0}


def test_rollups_agree(tables):
    annual = {r["year"]: (r["Exports"], r["Imports"], r["balance"], r["total_trade"])
              for r in tables["trade_annual"].collect()}
    assert annual == {1999: (15.0, 10.0, 5.0, 25.0), 2000: (1.0, 3.0, -2.0, 4.0)}
    region = tables["trade_by_region"].groupBy("year").agg(F.sum("value_usd").alias("v")).collect()
    assert {r["year"]: r["v"] for r in region} == {y: t[3] for y, t in annual.items()}


def test_hs_only_and_digits(spark):
    df = spark.createDataFrame(FACT, "year int, direction string, country string, code string, value double")
    cfg = T.TradeConfig(hs_digits=4, include_pre_hs=False, value_digits=None)
    got = {r["code"] for r in T.commodity_table(T.trade_leaf(df, cfg), cfg).collect()}
    assert got == {"8541", "0101", "7108", "2601"}


def test_partitioning_does_not_change_results(spark):
    df = spark.createDataFrame(
        [(1999, "Exports", "Japan" if i % 3 else "India", "8541290000", (i % 97) + 0.01 * (i % 100)) for i in range(3000)],
        "year int, direction string, country string, code string, value double")
    results = {tuple(sorted(map(tuple, T.partner_table(T.trade_base(df.repartition(n))).collect())))
               for n in (1, 3, 11)}
    assert len(results) == 1


def test_bundle_round_trip(spark, tables, tmp_path):
    meta = T.trade_meta(tables)
    write_bundle(tables, meta, str(tmp_path))
    back = read_bundle(spark, str(tmp_path), ["meta", "trade_annual"])
    row = back["meta"].first()
    assert row["years"] == [1999, 2000] and row["hs_era_from"] == 1999 and row["semi_codes"] == ["8541", "8542"]
    assert back["trade_annual"].count() == 2
