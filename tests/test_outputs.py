"""Files in their published order, figures taken while writing, and versions that replace each other whole."""

import random

import pytest
from pyspark.sql import functions as F

from statloom.operators.frames import in_ranges, nth, sort_na_last
from statloom.plans import accounts as NA
from statloom.plans import trade as T
from statloom.queries.common import trade_fact
from statloom.sources import sinks as K
from statloom.sources.workspace import fresh_dir

SF = "/root/testdata/sf0.001"


def rows_in_file_order(spark, folder, schema):
    """Rows of a CSV folder, part by part."""
    from glob import glob

    out = []
    for part in sorted(glob(f"{folder}/part-*")):
        out += [tuple(r) for r in spark.read.schema(schema).option("header", True).csv(part).collect()]
    return out


@pytest.fixture(scope="module")
def shuffled(spark):
    rng = random.Random(1)
    rows = [(rng.choice([2000, 2001, 2002, None]), rng.choice(["a", "b", None]), rng.choice([None, *map(float, range(50))])) for _ in range(3000)]
    return spark.createDataFrame(rows, "year int, k string, v double").repartition(7)


def test_files_hold_the_order(spark, shuffled):
    folder = fresh_dir(spark, "ordered")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        written = K.write_tables({"t": shuffled}, folder, order={"t": ["year", "-v"]})
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    got = rows_in_file_order(spark, f"{folder}/t.csv", shuffled.schema)
    want = [tuple(r) for r in sort_na_last(shuffled, "year", "-v", "k").collect()]
    assert got == want and written == {"t": 3000}


def test_one_hot_key_is_dealt_to_several_tasks(spark, shuffled):
    hot = shuffled.withColumn("year", F.lit(1))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = in_ranges(hot, "year").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(parts) > 1


def test_trade_tables_from_records_to_files(spark):
    tables = T.build_trade(trade_fact(spark, SF))
    folder = fresh_dir(spark, "trade-csv")
    written = K.write_tables(tables, folder, order=T.TABLE_ORDER)
    assert set(written) == set(T.TABLE_ORDER)
    for name, keys in T.TABLE_ORDER.items():
        got = rows_in_file_order(spark, f"{folder}/{name}.csv", tables[name].schema)
        cols = tables[name].columns
        at = [(cols.index(k.lstrip("-")), -1 if k.startswith("-") else 1) for k in keys]
        order = [tuple(s * r[i] if s < 0 else r[i] for i, s in at) for r in got]
        assert order == sorted(order) and len(got) == written[name], name
    assert K.output_inventory(tables, folder, written=written).where("MB IS NULL OR rows = 0").count() == 0


def test_inventory_computes_nothing_again(spark):
    ran = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            ran.add(b.num_rows)
            yield b

    df = spark.range(100).mapInArrow(seen, "id long")
    folder = fresh_dir(spark, "once")
    written = K.write_tables({"t": df}, folder)
    assert K.output_inventory({"t": df}, folder, written=written).first()["rows"] == 100 and ran.value == 100


def test_base_is_pruned_by_year(spark):
    base = T.stage(T.trade_base(trade_fact(spark, SF)), "base", ["direction", "year"])
    plan = base.where("year = 1996 AND direction = 'Exports'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "(year" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_fingerprints_tell_multisets_apart(spark):
    def of(rows):
        return tuple(spark.createDataFrame(rows, "a string, b double").agg(*K.fingerprint(spark.createDataFrame(rows, "a string, b double"))).first())

    one = [("x", 1.0), ("y", None), ("y", None), (None, 2.0)]
    assert of(one) == of(one[::-1])
    for other in (one[:3], [*one, one[0]], [("x", 1.0), ("y", None), ("x", 1.0), (None, 2.0)], [("y", 1.0), ("x", None), ("y", None), (None, 2.0)]):
        assert of(one) != of(other)


def test_versions_replace_each_other_whole(spark):
    folder = fresh_dir(spark, "published")
    assert K.manifest(spark, folder).count() == 0
    one = {"a": spark.range(5).toDF("x"), "b": spark.range(3).toDF("y"), "scratch": spark.range(1)}
    assert K.publish_version(one, ["a", "b"], folder, {"a": ["-x"]}) == 1
    # A table that fails while others are written leaves the first version as it was.
    bad = {"a": spark.range(9).toDF("x"), "b": spark.range(3).select(F.raise_error(F.lit("stop")).cast("string").alias("y"))}
    with pytest.raises(Exception, match="stop"):
        K.publish_version(bad, ["a", "b"], folder)
    now = K.read_version(spark, folder)
    assert sorted(now) == ["a", "b"] and now["a"].count() == 5
    assert K.publish_version({"a": spark.range(9).toDF("x")}, ["a"], folder) == 2
    assert {n: d.count() for n, d in K.read_version(spark, folder).items()} == {"a": 9}
    assert {n: d.count() for n, d in K.read_version(spark, folder, 1).items()} == {"a": 5, "b": 3}
    assert {tuple(r) for r in K.verify_version(spark, folder, 1).collect()} == {("a", 5, True), ("b", 3, True)}
    # Files that do not hold what was written are noticed.
    path = K.manifest(spark, folder, 1).where("table = 'b'").first().path
    spark.range(3).toDF("y").withColumn("y", F.col("y") + 1).write.mode("overwrite").parquet(path)
    assert {tuple(r) for r in K.verify_version(spark, folder, 1).collect()} == {("a", 5, True), ("b", 3, False)}
    with pytest.raises(KeyError):
        K.publish_version(one, ["absent"], folder)


def test_nth_reads_one_range(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("v"), F.lit("x").alias("k")).repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        want = sorted(r.v for r in df.collect())
        for n in (1, 2, 777, 2500, 4999, 5000):
            assert [r.v for r in nth(df, n, "k", "v").collect()] == [want[n - 1]]
            assert [r.v for r in nth(df, n, "-v").collect()] == [want[-n]]
        assert nth(df, 5001, "v").collect() == []
        plan = nth(df, 2500, "v")._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(__range" in plan
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_labels_of_two_sheets_are_ranked_by_first_appearance(spark):
    def sheet(*rows):
        return spark.createDataFrame([(i, list(r)) for i, r in rows], "row_idx int, cells array<string>")

    grids = {"a": sheet((2, ("Zinc, all", "1", "2")), (3, ("Apples", "3", None))), "b": sheet((2, ("Apples", "5", "6")), (3, ("Mills", "7", "8")))}
    blocks = [NA.Block("cur", 1, 2, "a"), NA.Block("con", 1, 2, "b")]
    out = NA.build_accounts(grids, blocks, ["2000-01-01", "2001-01-01"], "Industry", "Year", 1, strip=NA.AFTER_COMMA, rank="r")
    assert {(r.Industry, r.r) for r in out.collect()} == {("Zinc", 1), ("Apples", 2), ("Mills", 3)}
    got = {(r.Valuation, r.Industry, r.Year.year): (r.MillionPesos, r.GrowthRate) for r in out.collect()}
    assert got["cur", "Zinc", 2001] == (2.0, 1.0) and got["con", "Apples", 2000] == (5.0, None) and got["cur", "Apples", 2001] == (None, None)
