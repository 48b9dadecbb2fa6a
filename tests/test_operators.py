import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from statloom.functions import numbers as N
from statloom.operators import aggs as A
from statloom.operators import frames as O
from statloom.operators import joins as J
from statloom.operators import numbering as NU
from statloom.operators import reshape as R
from statloom.operators import windows as W


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def months(n):
    return [date(2000 + i // 12, i % 12 + 1, 1) for i in range(n)]


# -- numbering: small chunks, one group with most rows, against brute force


def hot_rows(n=500, seed=3):
    rnd = random.Random(seed)
    return [(i, "hot" if rnd.random() < 0.7 else rnd.choice("abc"),
             rnd.choice(["x", "y"]) if rnd.random() < 0.1 else None) for i in range(n)]


def test_numbered_matches_brute_force(spark):
    data = hot_rows()
    df = spark.createDataFrame(data, "i bigint, g string, v string").repartition(5)
    got = {r["i"]: (r["k"], r["n"]) for r in NU.numbered(df, ["g"], "i", "k", "n", rows=7).collect()}
    seen, want = {}, {}
    for i, g, _ in data:
        seen[g] = seen.get(g, 0) + 1
        want[i] = seen[g]
    assert got == {i: (want[i], seen[g]) for i, g, _ in data}


def test_fill_down_matches_brute_force(spark):
    data = hot_rows()
    df = spark.createDataFrame(data, "i bigint, g string, v string").repartition(5)
    for keys in ([], ["g"]):
        got = {r["i"]: r["v"] for r in R.fill_down(df, "v", "i", keys, rows=11).collect()}
        last, want = {}, {}
        for i, g, v in data:
            k = g if keys else None
            last[k] = v if v is not None else last.get(k)
            want[i] = last[k]
        assert got == want


def test_sparse_orders_match_brute_force(spark):
    """Every row is a chunk of its own, and there are several blocks of chunks."""
    data = [(i * 70 - 9_000, g, v) for i, g, v in hot_rows()]
    df = spark.createDataFrame(data, "i bigint, g string, v string").repartition(5)
    got = {r["i"]: (r["k"], r["n"]) for r in NU.numbered(df, ["g"], "i", "k", "n", rows=20).collect()}
    filled = {r["i"]: r["v"] for r in R.fill_down(df, "v", "i", ["g"], rows=20).collect()}
    seen, last, want, want_filled = {}, {}, {}, {}
    for i, g, v in data:
        seen[g] = want[i] = seen.get(g, 0) + 1
        last[g] = want_filled[i] = v if v is not None else last.get(g)
    assert got == {i: (want[i], seen[g]) for i, g, _ in data}
    assert filled == want_filled


def test_numbered_with_missing_keys(spark):
    df = spark.createDataFrame([(1, None), (2, None), (9, "a")], "i bigint, g string")
    assert rows(NU.numbered(df, ["g"], "i", "k", rows=2).select("i", "k"), "i") == [(1, 1), (2, 2), (9, 1)]


def test_split_header_rows(spark):
    sheet = [(1, "1995", "9"), (2, "January", "1"), (3, "February", "2"), (4, None, None),
             (5, "1996", "8"), (6, "January", "3")]
    df = spark.createDataFrame(sheet, "i bigint, m string, v string")
    out = R.split_header_rows(df, "m", "i", rows=2).select("Period", "v")
    assert sorted(map(tuple, out.collect())) == [("1995 Feb", "2"), ("1995 Jan", "1"), ("1996 Jan", "3")]


# -- reshape


def test_unpivot_keeps_empty_cells_and_reads_headers(spark):
    df = spark.createDataFrame(
        [("a", "1,000", None), ("b", ".", "2")], "`Item's.name` string, `1990 Q1` string, `Q2 1990` string")
    got = R.unpivot_periods(df, "v").collect()
    assert {(r[0], r[1], r[2], r[3], r[4]) for r in got} == {
        ("a", "1990 Q1", 1000.0, 1990, "Q1"), ("a", "Q2 1990", None, 1990, "Q2"),
        ("b", "1990 Q1", None, 1990, "Q1"), ("b", "Q2 1990", 2.0, 1990, "Q2")}


def test_price_basis_stays_in_the_label(spark):
    df = spark.createDataFrame([("a", "1")], "k string, `At Constant 2018 Prices 2003` string")
    assert tuple(R.unpivot_periods(df, "v").first())[2:] == (1.0, 2003, "At Constant 2018 Prices")


def test_unpivot_needs_periods(spark):
    with pytest.raises(ValueError):
        R.unpivot_periods(spark.createDataFrame([("a",)], "NA string"))


def test_unpivot_then_pivot_is_identity(spark):
    df = spark.createDataFrame([("a", 1.0, None), ("b", 2.0, 3.0)], "k string, `2001` double, `2002` double")
    long = R.unpivot_except(df, ["k"], "y", "v", None)
    assert rows(R.pivot_wide(long, ["k"], "y", "v", ["2001", "2002"]), "k") == rows(df, "k")


def test_unpivot_window_reuses_the_key_partitioning(spark):
    df = spark.createDataFrame([("a", "1", "2")], "k string, `2001` string, `2002` string")
    parts = [df, df.toDF("k", "2003", "2004")]
    long = R.unpivot_except(R.stitch_columns(parts, ["k"]), ["k"], "y", "v")
    plan = W.yoy(long, ["k"], "y", "v", 1)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_stitch_matches_missing_keys(spark):
    a = spark.createDataFrame([("x", "1"), (None, "2")], "k string, a string")
    b = spark.createDataFrame([(None, "3"), ("y", "4")], "k string, b string")
    assert rows(R.stitch_columns([a, b], ["k"]), "k") == [(None, "2", "3"), ("x", "1", None), ("y", None, "4")]


def test_combine_categories(spark):
    df = spark.createDataFrame([(1, "A B", 1.0), (1, "C", 2.0), (2, "A B", 5.0)], "t int, n string, v double")
    out = R.combine_categories(df, ["t"], "n", "v", {"S": lambda c: c["A B"] + c["C"]}, ["A B", "C"])
    assert rows(out, "t") == [(1, "S", 3.0), (2, "S", None)]


# -- joins


@pytest.mark.parametrize("how, want", [
    ("left", [(None, 1, 10), ("a", 2, None)]),
    ("right", [(None, 1, 10), ("b", None, 20)]),
    ("full", [(None, 1, 10), ("a", 2, None), ("b", None, 20)])])
def test_natural_join_matches_missing_keys(spark, how, want):
    a = spark.createDataFrame([(None, 1), ("a", 2)], "k string, x int")
    b = spark.createDataFrame([(None, 10), ("b", 20)], "k string, y int")
    assert rows(J.natural_join(a, b, how), "k") == want


def test_full_join_of_unique_keys(spark):
    a = spark.createDataFrame([(None, 1), ("a", 2)], "k string, x int")
    b = spark.createDataFrame([(None, 10), ("b", 20)], "k string, y int")
    assert rows(J.natural_join(a, b, "full", unique_keys=True), "k") == [
        (None, 1, 10), ("a", 2, None), ("b", None, 20)]


def test_full_join_keeps_duplicates(spark):
    a = spark.createDataFrame([("k", i) for i in range(3)], "k string, x int")
    b = spark.createDataFrame([("k", i) for i in range(2)] + [("z", 9)] * 2, "k string, y int")
    assert J.natural_join(a, b, "full").count() == 8


def test_label_lookup_rejects_large_tables():
    with pytest.raises(ValueError):
        J.label_lookup("c", {str(i): "x" for i in range(2000)}, F.lit(None))


# -- windows


def test_growth_of_a_constant_is_zero(spark):
    df = spark.createDataFrame([("s", m, 5.0) for m in months(30)], "s string, m date, v double")
    got = [r[0] for r in W.yoy(df, ["s"], "m", "v", 12, "g").orderBy("m").select("g").collect()]
    assert got == [None] * 12 + [0.0] * 18


def test_growth_over_zero_is_missing(spark):
    df = spark.createDataFrame([("s", m, v) for m, v in zip(months(2), [0.0, 3.0])], "s string, m date, v double")
    assert [r[0] for r in W.yoy(df, ["s"], "m", "v", 1, "g").select("g").collect()] == [None, None]


def test_calendar_growth_skips_gaps(spark):
    ms = [m for m in months(14) if m != date(2000, 2, 1)]
    df = spark.createDataFrame([("s", m, float(i + 1)) for i, m in enumerate(ms)], "s string, m date, v double")
    got = {r["m"]: r["g"] for r in W.yoy(df, ["s"], "m", "v", 12, "g", calendar="month").collect()}
    assert got[date(2001, 2, 1)] is None and got[date(2001, 1, 1)] == 12.0 / 1.0 - 1


def test_rolling_needs_k_values(spark):
    vals = [1.0, 2.0, 3.0, 4.0, None, 6.0, 7.0, 8.0, 9.0]
    df = spark.createDataFrame([("s", m, v) for m, v in zip(months(9), vals)], "s string, m date, v double")
    got = [r[0] for r in W.roll_sum(df, ["s"], "m", "v", 4, "r").orderBy("m").select("r").collect()]
    assert got == [None, None, None, 10.0, None, None, None, None, 30.0]
    wide = W.roll_wide(df.select("m", "v"), "m", ["v"], 4, "mean", "4Q").orderBy("m").collect()
    assert [r["v4Q"] for r in wide] == [None, None, None, 2.5, None, None, None, None, 7.5]


def test_make_unique(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, "a")], "i bigint, n string")
    assert rows(W.make_unique(df, "n", "i", rows=2), "i") == [(1, "a"), (2, "b"), (3, "a-1"), (4, "a-2")]


@pytest.mark.parametrize("n, want", [(1, [1]), (2, [1, 2]), (3, [1, 2, 3]), (6, [1, 3, 6]), (7, [1, 4, 7])])
def test_pick_spread(spark, n, want):
    df = spark.createDataFrame([("g", i) for i in range(1, n + 1)], "g string, i bigint")
    assert [r["i"] for r in W.pick_spread(df, ["g"], "i", rows=2).orderBy("i").collect()] == want


# -- frames


def test_sort_puts_missing_last(spark):
    df = spark.createDataFrame([(None,), (2,), (1,)], "x int")
    assert [r[0] for r in O.sort_na_last(df, "x").collect()] == [1, 2, None]
    assert [r[0] for r in O.sort_na_last(df, "-x").collect()] == [2, 1, None]


def test_level_rank(spark):
    df = spark.createDataFrame([(5, "b"), (1, "z"), (3, "b"), (2, None)], "i int, c string")
    assert rows(O.with_level_rank(df, "c", order="i").select("i", "level_rank"), "i") == [
        (1, 1), (2, 2), (3, 3), (5, 3)]
    assert rows(O.with_level_rank(df, "c", ["b"]).select("i", "level_rank"), "i") == [
        (1, None), (2, None), (3, 1), (5, 1)]


def test_top_leaves_residuals_out(spark):
    df = spark.createDataFrame(
        [(1, "a", 5, False), (1, "b", 9, True), (1, "c", 5, False), (1, "d", 1, False)],
        "y int, n string, v int, r boolean")
    out = O.top_partners(df, 2, ["y"], "v", "n", "r")
    assert rows(out.select("n", "rank"), "rank") == [("a", 1), ("c", 2)]


def test_until_and_splice(spark):
    df = spark.createDataFrame([(m, 1) for m in months(6)], "m date, v int")
    assert O.until(df, "m", F.lit(date(2000, 4, 20))).count() == 3
    both = O.splice(df, df.withColumn("v", F.lit(2)), "m", "2000-03-01")
    assert [r["v"] for r in both.orderBy("m").collect()] == [1, 1, 2, 2, 2, 2]


# -- aggregates


def test_empty_quarter_is_zero(spark):
    df = spark.createDataFrame([(date(2000, 1, 1), None), (date(2000, 4, 1), 2.0), (date(2000, 5, 1), None)],
                               "m date, v double")
    assert rows(A.to_quarter_sum(df, [], "m", "v"), "Quarter") == [
        (date(2000, 1, 1), 0.0), (date(2000, 4, 1), 2.0)]


def test_quarter_end(spark):
    df = spark.createDataFrame([(m,) for m in months(7)], "m date")
    assert [r["m"].month for r in A.to_quarter_end(df, "m").orderBy("m").collect()] == [3, 6]


def test_distinct_share_and_arg_max(spark):
    df = spark.createDataFrame(
        [(1999, None, 5.0, True), (2000, "a", 7.0, False), (2001, "a", 7.0, False), (2002, "b", None, True)],
        "y int, c string, v double, f boolean")
    got = df.agg(A.n_distinct("c"), A.share_where("f", "v"), A.arg_max("y", "v")).first()
    assert tuple(got) == (3, 5.0 / 19.0, 2000)


def test_annual_balance_with_one_side(spark):
    df = spark.createDataFrame([(1999, "Exports", 5.0), (2000, "Exports", 1.0), (2000, "Imports", 3.0)],
                               "year int, direction string, value_usd double")
    assert rows(A.annual_balance(df), "year") == [(1999, 5.0, None, None, None), (2000, 1.0, 3.0, -2.0, 4.0)]


def test_reconcile_reports_gaps(spark):
    a = spark.createDataFrame([("x", 1.0), ("y", 2.0)], "k string, v double")
    b = spark.createDataFrame([("x", 1.0), ("z", 2.0)], "k string, v double")
    assert [(r["k"], r["gap"], r["agrees"]) for r in A.reconcile(a, b, ["k"], "v").orderBy("k").collect()] == [
        ("x", 0.0, True), ("y", 2.0, False), ("z", 2.0, False)]


def test_code_profile(spark):
    df = spark.createDataFrame(
        [("f", c, i) for i, c in enumerate(["22", "1", "22", "333", "4"])], "file string, code string, i int")
    assert tuple(A.code_profile(df, "code", "file", "i", 2).first()) == ("f", 4, "1:2, 2:1, 3:1", "22, 1")


def test_pivot_wide_loses_nothing_silently(spark):
    long = spark.createDataFrame([("k", "A", 1), ("k", "B", 2)], "k string, n string, v int")
    assert R.pivot_wide(long, ["k"], "n", "v").collect()[0].asDict() == {"k": "k", "A": 1, "B": 2}
    assert R.pivot_wide(long, ["k"], "n", "v", ["A"], "drop").columns == ["k", "A"]
    for rows_, levels in (([("k", "B", 2)], ["A"]), ([("k", None, 2)], ["A"]), ([("k", "A", 1), ("k", "A", 2)], ["A"])):
        with pytest.raises(Exception, match="name outside the levels|two values in one cell"):
            R.pivot_wide(spark.createDataFrame(rows_, long.schema), ["k"], "n", "v", levels).collect()


def test_stitch_columns_raises_on_repeated_keys(spark):
    twice = spark.createDataFrame([("x", "9"), ("x", "10")], "k string, a string")
    other = spark.createDataFrame([("x", "1")], "k string, b string")
    with pytest.raises(Exception, match="a part has a key twice"):
        R.stitch_columns([twice, other], ["k"]).collect()
    with pytest.raises(ValueError):
        R.stitch_columns([other, other], ["k"])


def test_amounts_with_more_decimals_raise(spark):
    df = spark.createDataFrame([(0.004,)] * 10, "v double")
    with pytest.raises(Exception, match="more decimals than 2"):
        df.select(N.total("v", 2)).collect()
    assert df.select(N.total("v", 3)).first()[0] == 0.04


def test_label_join(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "c string")
    labels = spark.createDataFrame([("a", "A"), ("a", "A"), (None, "none")], "c string, label string")
    got = J.label_join(df, "c", labels, "label", F.lit("other"))
    assert {tuple(r) for r in got.collect()} == {("a", "A"), ("b", "other"), (None, "none")}


def test_missing_keys_match(spark):
    a = spark.createDataFrame([("x", 1), (None, 2)], "k string, v int")
    b = spark.createDataFrame([(None, 3)], "k string, w int")
    assert [r.k for r in J.pending(a, b, ["k"]).collect()] == ["x"]
    assert [r.v for r in J.members(a, b, ["k"]).collect()] == [2]
    assert {tuple(r) for r in J.join_all([a, b], ["k"]).collect()} == {("x", 1, None), (None, 2, 3)}
