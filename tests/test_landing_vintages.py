"""Batches in document order, ranks without a hot task, vintages that replace each other, calendar growth and sketches."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from statloom.operators import aggs as A
from statloom.operators.numbering import ranked
from statloom.operators.reshape import unpivot_periods
from statloom.operators.windows import yoy
from statloom.plans import agri as AG
from statloom.sources import landing as G
from statloom.streaming import resume as R
from tests.test_sources import put


def test_ranks_of_texts(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["hot", "hot", "hot", "a", None]), f"v{k:05d}") for k in range(4000)]
    rng.shuffle(rows)
    got = ranked(spark.createDataFrame(rows, "g string, v string"), ["g"], ["v"], "k", parts=9)
    want = {}
    for g in {r[0] for r in rows}:
        want |= {(g, v): k for k, v in enumerate(sorted(v for h, v in rows if h == g), start=1)}
    assert {(r.g, r.v): r.k for r in got.collect()} == want


def test_no_task_ranks_a_hot_group_whole(spark):
    df = spark.range(4000).select(F.lit("hot").alias("g"), F.lpad(F.col("id").cast("string"), 6, "0").alias("v"))
    plan = ranked(df, ["g"], ["v"], "k", parts=8)
    assert [r.k for r in plan.orderBy("v").collect()] == list(range(1, 4001))
    text = plan._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in text.splitlines() if "row_number()" in line and "Window" in line]
    assert windows and all("__chunk" in line for line in windows)


def test_batches_hold_their_values_in_document_order(spark):
    codes = ["z9", "b2", "a10", "q", "m", "c3", "x"]
    rows = [("t", "code", c, i) for i, c in enumerate(codes)] + [("t", "year", str(y), y) for y in (2000, 2001)]
    got = G.plan_batches(spark.createDataFrame(rows, "`table` string, dim string, value string, place int"), 6, order="place")
    assert [(r["batch"], r["values"], r["first_value"], r["batch_cells"]) for r in got.orderBy("batch").collect()] == [
        (1, ["z9", "b2", "a10"], "z9", 6), (2, ["q", "m", "c3"], "q", 6), (3, ["x"], "x", 2)]


def test_cells_are_exact_beyond_doubles(spark):
    sizes = {"a": 2049, "b": 2047, "c": 2045, "d": 2043, "e": 2041}  # a product of 55 bits
    rows = [("t", d, str(i)) for d, n in sizes.items() for i in range(n)]
    got = G.plan_batches(spark.createDataFrame(rows, "`table` string, dim string, value string"), 100).first()
    assert int(got["cells"]) == 2049 * 2047 * 2045 * 2043 * 2041 and got["status"] == "slice too large" and got["values"] == []


SCHEMA = "code string, value int, direction string, year int"


def records(path, *rows):
    return put(path, "code,value,direction,year\n" + "".join(",".join(map(str, r)) + "\n" for r in rows))


def test_a_revised_vintage_replaces_itself_only(spark, tmp_path):
    src, out, ck = (str(tmp_path / d) for d in ("in", "out", "ck"))
    run = lambda: R.land_vintages(spark, src, out, ck, SCHEMA, ["direction", "year"])
    landed = lambda: sorted((r.direction, r.year, r.code, r.value) for r in spark.read.parquet(out).collect())
    records(tmp_path / "in" / "first" / "e1999.csv", ("01", 1, "Exports", 1999), ("02", 2, "Exports", 1999))
    records(tmp_path / "in" / "first" / "e2000.csv", ("01", 3, "Exports", 2000))
    run()
    assert landed() == [("Exports", 1999, "01", 1), ("Exports", 1999, "02", 2), ("Exports", 2000, "01", 3)]
    records(tmp_path / "in" / "second" / "e1999.csv", ("01", 10, "Exports", 1999))
    records(tmp_path / "in" / "second" / "i1999.csv", ("07", 7, "Imports", 1999))
    run()
    want = [("Exports", 1999, "01", 10), ("Exports", 2000, "01", 3), ("Imports", 1999, "07", 7)]
    assert landed() == want
    run()
    assert landed() == want


def test_a_crash_between_write_and_commit_changes_nothing(spark, tmp_path, monkeypatch):
    src, out, ck = (str(tmp_path / d) for d in ("in", "out", "ck"))
    records(tmp_path / "in" / "a" / "x.csv", ("01", 1, "Exports", 1999), ("02", 2, "Exports", 1999))
    real, died = R.newest_revision, []

    class Dying:
        """Rows whose write succeeds and whose caller then dies, once."""

        def __init__(self, df):
            self.df = df

        def drop(self, *c):
            self.df.drop(*c).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("direction", "year").parquet(out)
            died.append(1)
            raise RuntimeError("executor lost")

    monkeypatch.setattr(R, "newest_revision", lambda *a: Dying(real(*a)))
    with pytest.raises(Exception, match="executor lost"):
        R.land_vintages(spark, src, out, ck, SCHEMA, ["direction", "year"])
    assert died and spark.read.parquet(out).count() == 2
    monkeypatch.setattr(R, "newest_revision", real)
    R.land_vintages(spark, src, out, ck, SCHEMA, ["direction", "year"])
    assert sorted(r.value for r in spark.read.parquet(out).collect()) == [1, 2]


def test_of_two_revisions_in_one_run_the_last_counts(spark):
    rows = [(1999, "old", 1, 5), (1999, "new", 2, 6), (1999, "new", 2, 7), (None, "old", 3, 8), (None, "new", 1, 9)]
    df = spark.createDataFrame(rows, "year int, folder string, modified int, v int")
    assert sorted(r.v for r in R.newest_revision(df, ["year"], "folder", "modified").collect()) == [6, 7, 8]


def test_calendar_growth(spark):
    rows = [(None, date(2000, 1, 1), 10.0), (None, date(2001, 1, 1), 20.0), (None, date(2003, 1, 1), 40.0), ("x", date(2001, 1, 1), 5.0),
            ("x", date(2002, 1, 1), None), ("x", date(2003, 1, 1), 6.0)]
    df = spark.createDataFrame(rows, "k string, t date, v double")
    out = yoy(df, ["k"], "t", "v", 1, calendar="year")
    assert {(r.k, r.t.year): r.GrowthRate for r in out.collect()} == {
        (None, 2000): None, (None, 2001): 1.0, (None, 2003): None, ("x", 2001): None, ("x", 2002): None, ("x", 2003): None}
    plan = yoy(df, ["k"], "t", "v", 1, calendar="year")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan
    months = spark.createDataFrame([(date(2000 + m // 12, m % 12 + 1, 1), float(m + 1)) for m in range(30) if m != 5], "t date, v double")
    got = {(r.t.year, r.t.month): r.g for r in yoy(months, [], "t", "v", 12, "g", calendar="month").collect()}
    assert got[2001, 1] == 13 / 1 - 1 and got[2001, 6] is None and got[2002, 6] == 30 / 18 - 1


def test_sketches_of_parts_merge_to_the_whole(spark):
    df = spark.range(60_000).select(
        (F.col("id") % 7).alias("part"), F.when(F.col("id") % 11 > 0, F.col("id") % 20_000).alias("v"))
    exact = df.agg(A.n_distinct("v")).first()[0]
    parts = df.groupBy("part").agg(A.distinct_sketch("v").alias("s"))
    merged = parts.agg(A.sketch_count(A.merged_sketch("s"))).first()[0]
    whole = df.agg(A.sketch_count(A.distinct_sketch("v"))).first()[0]
    assert abs(merged - exact) <= 4 * 0.013 * exact and abs(merged - whole) <= 0.013 * exact
    few = spark.createDataFrame([(None,), (1,), (1,), (2,)], "v int")
    assert few.agg(A.sketch_count(A.distinct_sketch("v"))).first()[0] == few.agg(A.n_distinct("v")).first()[0] == 3


def test_columns_of_other_periods_are_not_melted(spark):
    wide = spark.createDataFrame([("a", "1", "2", "3")], ["k", "1999 Quarter 1", "1999 Annual", "2000 Annual"])
    out = unpivot_periods(wide, "v", AG.DATED, only={"PeriodType": "Annual"})
    assert "Quarter 1" not in out._jdf.queryExecution().optimizedPlan().toString().split("LocalRelation")[0].split("Project")[0]
    assert sorted((r.Date.year, r.v) for r in out.collect()) == [(1999, 2.0), (2000, 3.0)]
    none = unpivot_periods(wide, "v", AG.DATED, only={"PeriodType": "Month"})
    assert none.count() == 0 and none.columns == out.columns
