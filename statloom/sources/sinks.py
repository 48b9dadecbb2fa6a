"""Named tables to CSV and parquet bundles, their dictionary and inventory."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.cols import named
from ..operators.frames import in_ranges
from .leading import leading


WRITERS = 4

Orders = Mapping[str, Sequence[str]]
# sums of two hashes of all rows: equal for equal rows in any order and any files
FINGERPRINT = ("rows", "first", "second")


def fingerprint(df: DataFrame) -> list[Column]:
    """Aggregates that tell two multisets of rows apart, whatever their order: `FINGERPRINT`."""
    cols = [named(c) for c in sorted(df.columns)]
    wide = lambda h: F.coalesce(F.sum(h.cast("decimal(20,0)")), F.lit(0)).cast("string")
    return [
        F.count(F.lit(1)).alias("rows"), wide(F.xxhash64(*cols)).alias("first"),
        wide(F.xxhash64(F.lit("second"), *reversed(cols))).alias("second")]


def _write_all(
    tables: Mapping[str, DataFrame], put: Callable[[str, DataFrame], None], order: Orders,
    figures: Callable[[DataFrame], list[Column]],
) -> dict[str, dict[str, Any]]:
    """Write independent tables side by side; the first failure is raised.

    Returns figures of each table, observed while it was written, so none is computed twice.
    """

    def one(name: str, df: DataFrame) -> dict[str, Any]:
        seen = Observation()
        cols = figures(df)
        rows = in_ranges(df, *order[name]) if order.get(name) else df
        put(name, rows.observe(seen, *cols))
        return seen.get

    with ThreadPoolExecutor(WRITERS) as pool:
        jobs = {name: pool.submit(one, name, df) for name, df in tables.items()}
        return {name: job.result() for name, job in jobs.items()}


def _rows(df: DataFrame) -> list[Column]:
    return [F.count(F.lit(1)).alias("rows")]


def write_tables(
    tables: Mapping[str, DataFrame], folder: str, mode: str = "overwrite", order: Orders = {},
) -> dict[str, int]:
    """One CSV folder per table, its parts in the order given for it; returns the rows of each table."""
    found = _write_all(tables, lambda name, df: df.write.mode(mode).option("header", True).csv(
        f"{folder}/{name}.csv"), order, _rows)
    return {name: seen["rows"] for name, seen in found.items()}


def write_bundle(
    tables: Mapping[str, DataFrame], meta: Mapping[str, Any], folder: str, mode: str = "overwrite",
    order: Orders = {},
) -> dict[str, int]:
    """Parquet per table plus a one-row `meta` table; lists become arrays. Returns the rows of each table."""
    first = next(iter(tables.values()))
    found = _write_all(tables, lambda name, df: df.write.mode(mode).parquet(f"{folder}/{name}"), order, _rows)
    row = first.sparkSession.range(1).select(
        F.current_timestamp().alias("built"), *[F.lit(v).alias(k) for k, v in meta.items()])
    row.write.mode(mode).parquet(f"{folder}/meta")
    return {name: seen["rows"] for name, seen in found.items()}


def read_bundle(spark: SparkSession, folder: str, names: Sequence[str]) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{folder}/{n}") for n in names}


def _picked(bundle: Mapping[str, DataFrame], names: Sequence[str]) -> dict[str, DataFrame]:
    missing = [n for n in names if n not in bundle]
    if missing:
        raise KeyError(f"not in bundle: {missing}")
    return {n: bundle[n] for n in names}


def publish(
    bundle: Mapping[str, DataFrame], names: Sequence[str], folder: str, mode: str = "overwrite",
    order: Orders = {},
) -> list[str]:
    """Save the listed tables only; a listed table that is absent is an error."""
    _write_all(_picked(bundle, names), lambda name, df: df.write.mode(mode).parquet(f"{folder}/{name}"), order, _rows)
    return list(names)


MANIFEST = "version bigint, built timestamp, `table` string, path string, rows bigint, first string, second string"


def manifest(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """Tables of a published version (the last one by default), with their paths and fingerprints; no rows before the first."""
    try:
        rows = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], MANIFEST)
    last = F.lit(version) if version is not None else rows.agg(F.max("version")).scalar()
    return rows.where(F.col("version") == last)


def publish_version(
    bundle: Mapping[str, DataFrame], names: Sequence[str], folder: str, order: Orders = {},
) -> int:
    """Write the listed tables beside the published ones, then make them the published ones.

    The new version counts from the moment its rows stand in the manifest, which is one
    commit of one file. A publish that fails before leaves the old version as it was. There is one
    publisher at a time; older versions stay until their owner clears them.
    """
    picked = _picked(bundle, names)
    spark = next(iter(picked.values())).sparkSession
    version = (manifest(spark, folder).agg(F.max("version")).first()[0] or 0) + 1
    base = f"{folder}/versions/{version:06d}-{uuid.uuid4().hex}"
    found = _write_all(picked, lambda name, df: df.write.parquet(f"{base}/{name}"), order, fingerprint)
    rows = [(version, name, f"{base}/{name}", *(seen[f] for f in FINGERPRINT)) for name, seen in found.items()]
    spark.createDataFrame(rows, "version bigint, `table` string, path string, rows bigint, first string, second string").select(
        "version", F.current_timestamp().alias("built"), "table", "path", *FINGERPRINT).coalesce(1).write.mode("append").parquet(
        f"{folder}/manifest")
    return version


def read_version(spark: SparkSession, folder: str, version: int | None = None) -> dict[str, DataFrame]:
    """The published tables by name."""
    return {r.table: spark.read.parquet(r.path) for r in manifest(spark, folder, version).collect()}


def verify_version(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """Per published table, whether its files hold the rows that were written."""
    said = manifest(spark, folder, version)
    now = reduce(DataFrame.unionByName, [
        df.agg(*fingerprint(df)).withColumn("table", F.lit(name)) for name, df in read_version(spark, folder, version).items()])
    both = said.alias("s").join(now.alias("n"), "table")
    same = reduce(lambda x, y: x & y, [F.col(f"s.{f}") == F.col(f"n.{f}") for f in FINGERPRINT])
    return both.select("table", F.col("s.rows").alias("rows"), same.alias("intact"))


def data_dictionary(
    spark: SparkSession, tables: Mapping[str, DataFrame], notes: Mapping[tuple[str, str], str]
) -> DataFrame:
    """One row per column of each table, with its type and note."""
    rows = [
        (t, i, f.name, f.dataType.simpleString(), notes.get((t, f.name), notes.get(("", f.name))))
        for t, df in tables.items() for i, f in enumerate(df.schema.fields, start=1)]
    return spark.createDataFrame(
        rows, "`table` string, position int, column string, type string, note string")


def coverage_text(annual: DataFrame, commodity: DataFrame, include_early: bool = True) -> DataFrame:
    """The coverage sentence of the dictionary: years, and since when codes are harmonised."""
    tail = ", PSCC before that." if include_early else " (PSCC excluded)."
    first = commodity.where(F.col("classification") == "HS").agg(F.min("year")).scalar()
    return annual.agg(F.min("year").alias("a"), F.max("year").alias("b")).select(F.concat(
        F.lit("Coverage: "), F.col("a").cast("string"), F.lit("-"), F.col("b").cast("string"),
        F.lit("; commodity by HS classification from "), first.cast("string"),
        F.lit(" onward"), F.lit(tail)).alias("coverage"))


def output_inventory(
    tables: Mapping[str, DataFrame], folder: str, suffix: str = ".csv", written: Mapping[str, int] | None = None,
) -> DataFrame:
    """Per written table: its rows, and the megabytes its files take.

    `written` has the rows that the writer counted; without it the tables are computed again.
    """
    spark = next(iter(tables.values())).sparkSession
    if written is not None:
        counts = spark.createDataFrame([(n + suffix, written[n]) for n in tables], "file string, rows bigint")
    else:
        counts = reduce(
            DataFrame.unionByName,
            [df.agg(F.count("*").alias("rows")).select(F.lit(n + suffix).alias("file"), "rows")
             for n, df in tables.items()])
    files = leading(spark, [f"{folder}/{n}{suffix}" for n in tables]).select(
        F.element_at(F.split("path", "/"), -2).alias("file"), "length")
    sizes = files.groupBy("file").agg(F.bround(F.sum("length") / 1e6, 2).alias("MB"))
    return counts.join(sizes, ["file"], "left")


def distinct_labels(df: DataFrame, col: str) -> DataFrame:
    """Sorted distinct labels, ready for a text sink."""
    return df.select(named(col)).where(named(col).isNotNull()).distinct().orderBy(named(col))


def write_labels(labels: DataFrame, folder: str) -> None:
    labels.write.mode("overwrite").text(folder)
