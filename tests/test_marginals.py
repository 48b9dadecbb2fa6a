"""Marginals from one aggregation, and audits of them."""

import pytest
from pyspark.sql import functions as F

from statloom.operators import aggs as A


@pytest.fixture(scope="module")
def fact(spark):
    rows = [(2000, "a", "x", 1.25), (2000, None, "x", 2.5), (2000, None, None, 4.0), (2001, "a", "y", 8.0), (2001, "b", None, 16.0), (None, "b", "y", 32.0)]
    return spark.createDataFrame(rows, "year int, who string, what string, v double")


def specs():
    return {
        "year": A.Marginal(["year"]), "who": A.Marginal(["who"], rename={"who": "partner"}), "both": A.Marginal(["what", "year"]),
        "late": A.Marginal(["who"], F.col("year") >= 2001), "none": A.Marginal(["year"], F.col("v") > 100), "all": A.Marginal([]),
    }


def test_marginals_are_those_of_single_sums(fact):
    got = A.marginals(fact, specs(), "v", 2)
    for name, m in specs().items():
        rows = fact if m.where is None else fact.where(m.where)
        want = rows.groupBy(*m.keys).agg(F.sum("v").alias("v")) if m.keys else rows.agg(F.sum("v").alias("v"))
        want = want.withColumnsRenamed(dict(m.rename))
        assert got[name].columns == want.columns, name
        key = lambda r: tuple(map(str, r))
        assert sorted(map(tuple, got[name].collect()), key=key) == sorted(map(tuple, want.collect()), key=key), name
    assert "partner" in got["who"].columns and got["none"].count() == 0


def test_one_scan_for_all_marginals(spark, fact, monkeypatch):
    ran = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            ran.add(b.num_rows)
            yield b

    got = A.marginals(fact.mapInArrow(seen, fact.schema), specs(), "v")
    total = sum(df.count() for df in got.values())
    assert ran.value == 6 and total == 3 + 3 + 5 + 2 + 0 + 1


def test_marginals_of_no_rows(fact):
    got = A.marginals(fact.where("v < 0"), specs(), "v")
    assert {n: df.count() for n, df in got.items() if n != "all"} == dict.fromkeys(["year", "who", "both", "late", "none"], 0)


def test_reconcile_matches_missing_keys(spark):
    a = spark.createDataFrame([(1, None, 10.0), (1, "x", 5.0), (2, "x", 1.0)], "y int, k string, v double")
    b = spark.createDataFrame([(1, None, 11.0), (1, "x", 5.0), (3, "x", 2.0)], "y int, k string, v double")
    got = {(r.y, r.k): (r.left_total, r.right_total, r.gap, r.agrees) for r in A.reconcile(a, b, ["y", "k"], "v", None).collect()}
    assert got == {(1, None): (10.0, 11.0, 1.0, True), (1, "x"): (5.0, 5.0, 0.0, True), (2, "x"): (1.0, None, 1.0, False), (3, "x"): (None, 2.0, 2.0, False)}
    assert not A.reconcile(a, b, ["y", "k"], "v").where("k IS NULL").first().agrees


def test_residual_summary(spark):
    rows = [(2000, True, 1.0), (2000, False, 1.0), (2001, True, 5.0), (2001, False, 5.0), (2002, False, 4.0), (2003, None, 0.0)]
    partner = spark.createDataFrame(rows, "year int, is_resid boolean, value_usd double")
    assert tuple(A.residual_summary(A.residual_share(partner)).first()) == (0.5, 2000, 2003, None)
