from datetime import date

from pyspark.sql import functions as F

from statloom.plans import accounts as NA
from statloom.plans import agri as AG
from statloom.plans import fiscal as FI
from statloom.plans import prices as PR
from statloom.plans import publish as PU
from statloom.plans import social as SO
from statloom.sources.workspace import fresh_dir


def table(spark, header, *rows):
    schema = ", ".join(f"`{h}` string" for h in header)
    return spark.createDataFrame([tuple(r) for r in rows], schema)


def test_accounts_growth_before_cleaning(spark):
    grid = spark.createDataFrame([
        (1, ["Table", None, None]), (2, ["Less : Imports", "10", "12"]), (3, [None, None, None]),
        (4, ["Statistical discrepancy", "1", "2"]), (6, ["Less : Imports", "5", "5"])],
        "row_idx int, cells array<string>")
    blocks = [NA.Block("Current Prices", 1, 3), NA.Block("Constant 2018 Prices", 5, 2)]
    out = NA.build_accounts(grid, blocks, ["2000-01-01", "2001-01-01"], "Expenditure", "Year", 1, drop="discrepancy")
    got = {(r["Expenditure"], r["Valuation"], r["Year"]): (r["MillionPesos"], r["GrowthRate"]) for r in out.collect()}
    assert got == {
        ("Imports", "Current Prices", date(2000, 1, 1)): (10.0, None),
        ("Imports", "Current Prices", date(2001, 1, 1)): (12.0, 12 / 10 - 1),
        ("Imports", "Constant 2018 Prices", date(2000, 1, 1)): (5.0, None),
        ("Imports", "Constant 2018 Prices", date(2001, 1, 1)): (5.0, 0.0)}


def test_per_capita(spark):
    heads = ["Industry", *[f"{y} Q{q}" for y in (2000, 2001) for q in range(1, 5)]]
    out = NA.build_per_capita(table(
        spark, heads, ["Per Capita Gross Domestic Product at current prices", *"12345", ".", ".", "."],
        ["Per Capita Household Final Consumption at current prices", *"12345678"]))
    got = sorted(map(tuple, out.collect()), key=lambda r: r[1])
    assert len(got) == 8 and got[0][:3] == ("Per Capita Gross Domestic Product", date(2000, 1, 1), "Current Prices")
    assert got[4][3:] == (5.0, 4.0) and got[5][3:] == (None, None)


def cpi(spark, years, rows):
    heads = ["Geolocation", "Commodity Description",
             *[f"{y} {m}" for y in years for m in ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep",
                                                   "Oct", "Nov", "Dec", "Ave")]]
    return table(spark, heads, *[[g, c, *[str(v)] * (13 * len(years))] for g, c, v in rows])


def test_inflation_over_two_vintages(spark):
    old = cpi(spark, [1999], [("PHILIPPINES", "0 - ALL ITEMS", 100), ("..Muslim", "01.1 - RICE", 50)])
    new = PR.align_places(cpi(spark, [2000], [("PHILIPPINES", "0 - ALL ITEMS", 110), ("..Bansamoro Muslim", "01.1 - RICE", 60),
                                             ("....New", "0 - ALL ITEMS", 1)]))
    large = PR.build_inflation([old, new], F.lit("2000-03-15").cast("date"))
    got = {(r["Geolocation"], r["Commodity"], r["Month"]): (r["CPI"], r["Inflation"]) for r in large.collect()}
    assert len(got) == 3 * 14
    assert got[("PHILIPPINES", "0 - ALL ITEMS", date(2000, 2, 1))] == (110.0, 110 / 100 - 1)
    assert got[("..Muslim", "01.1 - RICE", date(2000, 1, 1))] == (60.0, 60 / 50 - 1)
    assert got[("....New", "0 - ALL ITEMS", date(1999, 1, 1))] == (None, None)
    core = PR.build_core(cpi(spark, [1999], [("PHILIPPINES", "0 - ALL ITEMS", 7)]))
    small = PR.small_table(large, core)
    assert {(r["Commodity"], r["CommodityRank"]) for r in small.collect()} == {("Headline", 1), ("Core", 2)}
    assert {r["Geolocation"] for r in PR.main_table(large).collect()} == {"PHILIPPINES"}


def test_core_from_sheet(spark):
    sheet = spark.createDataFrame(
        [(1, "1999", "9")] + [(i + 2, m, str(i + 1)) for i, m in enumerate(["January", "February"])]
        + [(4, "2000", "9"), (5, "January", "4")], "row_idx bigint, m string, v string")
    got = sorted(tuple(r) for r in PR.build_core_from_sheet(sheet, "m", "v").collect())
    assert [(r[2], r[3]) for r in got] == [(date(1999, 1, 1), 1.0), (date(1999, 2, 1), 2.0), (date(2000, 1, 1), 4.0)]


def test_cpi_items_fill_down(spark):
    items = table(spark, ["Geolocation", "Commodity Description", "Weights"], ["A", "x", "1"], ["A", "y", "1"], ["B", "x", "1"])
    sheet = spark.createDataFrame([(1, "A", "x", "1"), (2, None, "y", "2"), (3, "B", "z", "3")],
                                  "row_idx bigint, Geolocation string, `Commodity Description` string, `2018Jan` string")
    got = {tuple(r) for r in PR.build_cpi_items(items, sheet).collect()}
    assert got == {("A", "x", "1"), ("A", "y", "2"), ("B", "x", None)}


def test_deflators_keep_index_years(spark):
    n = spark.createDataFrame([(2000, 50.0), (2001, 60.0)], "Year int, NominalGDP double")
    r = spark.createDataFrame([(2000, 25.0), (2001, 0.0)], "Year int, RealGDP double")
    c = spark.createDataFrame([(2000, 90.0), (2001, 95.0), (2002, 99.0)], "Year int, CPI double")
    assert sorted(map(tuple, PR.build_deflators(n, r, c).collect())) == [
        (2000, 200.0, 90.0), (2001, None, 95.0), (2002, None, 99.0)]


MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October",
          "November", "December"]


def monthly(spark, years, **series):
    heads = ["Particulars", *[f"{m} {y}" for y in years for m in MONTHS]]
    return table(spark, heads, *[[n, *[str(v)] * (12 * len(years))] for n, v in series.items()])


def gdp(spark, first, years, value=100.0):
    return spark.createDataFrame(
        [(date(first + y, q, 1), value) for y in range(years) for q in (1, 4, 7, 10)], "Quarter date, NominalGDP double")


def test_ngcor(spark):
    raw = monthly(spark, [2000, 2001], **{"BIR Revenues (net)": 1, "Surplus/Deficit": -2})
    out = FI.build_ngcor(FI.monthly_long(raw), gdp(spark, 2000, 1), ["BIRRevenuesnet", "SurplusDeficit"])
    got = [tuple(r) for r in out.orderBy("Quarter").collect()]
    assert len(got) == 4  # quarters without output are gone
    assert got[3] == (date(2000, 10, 1), 3.0, -6.0, 100.0, 3.0, -6.0, 100.0) and got[2][4] is None


def test_ngdebt_splice(spark):
    lines = {"Total Obligations": 9, "Actual Obligations": 8, "Domestic Debt": 3, "External Debt": 4,
             "Domestic Guaranteed Obligations": 1, "External Guaranteed Obligations": 2,
             "Debt Service - Interest Payment": 5}
    m = FI.monthly_long(monthly(spark, [2007, 2008, 2009], **lines))
    yearly = table(spark, ["Particulars", "1985", "2007", "2008", "2009"], *[[n, *[str(v * 10)] * 4] for n, v in lines.items()])
    out = FI.build_ngdebt(FI.annual_long(yearly, 1986), m, gdp(spark, 2007, 3), 2009).orderBy("Month").collect()
    assert [r["Month"] for r in out] == [date(2007, 12, 1), date(2008, 12, 1), *[date(2009, k, 1) for k in (3, 6, 9, 12)]]
    assert out[0]["DomesticDebt"] == 40.0 and out[2]["DomesticDebt"] == 4.0 and out[2]["ExternalDebt"] == 6.0
    assert {r["NominalGDP4Q"] for r in out} == {400.0}
    assert out[0]["DebtServiceInterestPayment"] == 15.0 and out[0]["DebtService4Q"] == 60.0


def test_tax(spark):
    raw = table(spark, ["Tax Classification", "2000 Collection", "2000 Goal"], ["VAT", "600", "700"])
    ng = spark.createDataFrame([(date(2000, 10, 1), 50.0, 100.0), (date(2000, 7, 1), 1.0, 1.0)],
                               "Quarter date, BIRRevenues4Q double, NominalGDP4Q double")
    r = FI.build_tax(raw, ng, ["Collection", "Goal"]).first()
    assert (r["TaxType"], r["Year"], r["Effort"], r["Share"]) == ("VAT", date(2000, 10, 1), 1.5, 3.0)


def test_labor(spark):
    raw = table(spark, ["LFS Round", "Round", "Population 15+"], ["2000 Q2", "Q", "5"], ["2021 Jan", "Jan", "6"],
                ["2000", "Annual", "7"])
    out = SO.build_labor(raw)
    assert out.columns == ["LFSRound", "Round", "Period", "Population15"]
    assert sorted(map(tuple, out.collect())) == [
        ("2000 Q2", "Q", date(2000, 4, 1), "5"), ("2021 Jan", "Jan", date(2021, 1, 1), "6")]


def test_poverty(spark):
    out = SO.build_poverty(table(spark, ["A", "B", "C", "2018", "2021"], ["a", "b", "c", "1.5", ".."]), ["A", "B", "C"])
    assert sorted(map(tuple, out.collect()), key=str) == [
        ("a", "b", "c", date(2018, 1, 1), 1.5), ("a", "b", "c", date(2021, 1, 1), None)]


def test_crops_do_not_mix_levels(spark):
    heads = ["Commodity", "Geolocation", "2000 Annual", "2001 Annual", "2000 Quarter 1"]
    vol = table(spark, heads, ["Rice", "..Aurora", "10", "20", "1"], ["Rice", "....Aurora", "1", "3", "1"])
    area = table(spark, heads, ["Rice", "..Aurora", "5", "5", "1"], ["Corn", "PHILIPPINES", "2", "2", "1"])
    out = AG.build_crops([vol], [area], "Annual")
    got = {(r["Commodity"], r["Level"], r["Year"].year): (r["Volume"], r["Area"], r["Yield"], r["VolumeGrowth"]) for r in out.collect()}
    assert got[("Rice", "Region", 2001)] == (20.0, 5.0, 4.0, 1.0)
    assert got[("Rice", "Province", 2001)] == (3.0, None, None, 2.0)
    assert got[("Corn", "National", 2000)] == (None, 2.0, None, None) and len(got) == 6


def test_livestock_both_ways(spark):
    prod = table(spark, ["Sector/Animal Type", "1997 Q1", "1997 Annual"], ["LIVESTOCK 1/", "1.5", "6"], ["..Hog", "..", "5"])
    inv = table(spark, ["Year", "Carabao", "Duck"], ["1950", "1,903", "709"], ["1951", "..", "x"])
    annual = {(r["Item"], r["Depth"], r["Indicator"], r["Year"].year): r["Value"] for r in AG.build_livestock(prod, inv, "Annual").collect()}
    assert annual == {
        ("LIVESTOCK 1/", 0, "Production (MT)", 1997): 6.0, ("Hog", 2, "Production (MT)", 1997): 5.0,
        ("Carabao", 0, "Inventory (head)", 1950): 1903.0, ("Duck", 0, "Inventory (head)", 1950): 709.0,
        ("Carabao", 0, "Inventory (head)", 1951): None, ("Duck", 0, "Inventory (head)", 1951): None}
    assert AG.build_livestock(prod, inv, "Quarter").count() == 2


def test_value_self_sufficiency_and_fisheries(spark):
    vp = table(spark, ["V", "S", *[f"{y} Quarter {q}" for y in (2000, 2001) for q in range(1, 5)]],
               ["At Current Prices", "..Crops", *"12345678"])
    got = AG.build_value_production(vp).orderBy("Quarter").collect()
    assert got[4]["Subsector"] == "Crops" and got[4]["GrowthRate"] == 4.0
    ratios = AG.build_self_sufficiency({
        "Self-Sufficiency Ratio": table(spark, ["Commodity", "1988"], ["Rice", "97.1"]),
        "Import Dependency Ratio": table(spark, ["Commodity", "1990"], ["Rice", ".."])})
    assert {(r["Indicator"], r["Year"].year, r["Ratio"]) for r in ratios.collect()} == {
        ("Self-Sufficiency Ratio", 1988, 97.1), ("Import Dependency Ratio", 1990, None)}
    fish = table(spark, ["G", "S", "2000 Annual", "2000 Semester 1"], ["..NCR", "..Marine", "4", "2"], ["....X", "..Inland", "..", "1"])
    out = AG.build_fisheries({"Volume (MT)": fish}, "Annual")
    assert [tuple(r) for r in out.collect()] == [("Marine", "NCR", "Region", "Volume (MT)", date(2000, 1, 1), 4.0)]


def test_prices_from_a_tree(spark, tmp_path):
    def put(path, text):
        p = tmp_path / path
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(text)
        return str(p)

    paths = [
        put("Farmgate Prices/New Series/a.csv", "Geo,Item,1990 January,1990 Annual\nPHILIPPINES,Rice,5,6\n..NCR,Rice,..,7\n"),
        put("Retail Prices/Old Series/b.csv", "Geo,Item,January 1990\n....X,Corn,8\n"),
        put("Retail Prices/Old Series/na.csv", "NA\n")]
    rec = AG.price_records(spark, str(tmp_path), paths)
    assert {tuple(r) for r in AG.build_prices(rec, "Month").collect()} == {
        ("Farmgate", "New Series", "Rice", "PHILIPPINES", "National", date(1990, 1, 1), 5.0),
        ("Retail", "Old Series", "Corn", "X", "Province", date(1990, 1, 1), 8.0)}
    assert AG.build_prices(rec, "Month", national_only=True).count() == 1
    assert AG.build_prices(rec, "Annual").count() == 2


def test_dashboard_whitelist(spark):
    df = spark.range(1)
    folder = fresh_dir(spark, "dash")
    tables = {n: df for n in [*PU.DASHBOARD_TABLES, "scratch"]}
    assert PU.compile_dashboard(tables, folder) == PU.DASHBOARD_TABLES and len(PU.DASHBOARD_TABLES) == 22


def test_signatures(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Commodity Code,Country,1999 FOB\n1,2,3\n")
    assert [tuple(r) for r in PU.header_signatures(spark, [str(tmp_path / "a.csv")]).collect()] == [
        ("a.csv", 3, "Commodity Code | Country | 1999 FOB")]


def test_inspect_files(spark, tmp_path):
    files = {"Exports": [], "Imports": []}
    for d, year, code in [("Exports", y, c) for y, c in ((1999, "12"), (2000, "x"), (2001, "345"), (2002, "6"))] + [
            ("Imports", 1999, "7")]:
        p = tmp_path / f"{d}_{year}.csv"
        p.write_text(f"Commodity Code,Country,{year} FOB\n{code},Japan {year},3\n{code},India,1\n")
        files[d].append(str(p))
    found = PU.inspect(spark, files)
    assert found["signatures"].count() == 5
    assert [r[0] for r in found["labels"].collect()] == ["India", *[f"Japan {y}" for y in (1999, 2000, 2001, 2002)]]
    assert sorted(tuple(r) for r in found["codes"].collect()) == [
        ("Exports_1999.csv", 1, "2:1", "12"), ("Exports_2000.csv", 1, "1:1", "x"),
        ("Exports_2002.csv", 1, "1:1", "6"), ("Imports_1999.csv", 1, "1:1", "7")]
