"""Run registered queries in Spark and their SQL in DuckDB, and compare whole results.

    python -m tests.oracle [--sf 0.001] [name ...]
"""

from __future__ import annotations

import argparse
import sys
import time
import traceback

import duckdb
from pyspark.sql import DataFrame, SparkSession

from statloom.queries import all_queries
from statloom.queries.registry import Query

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "boolean": "BOOLEAN", "float": "FLOAT",
}


def session(cpus: int = 8) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]").appName("statloom")
        .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g").config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.extraJavaOptions", "-Xss16m")
        .getOrCreate())


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def key(v):
    return (v is not None, str(type(v).__name__), v if v is not None else 0)


def ordered(rows):
    return sorted(rows, key=lambda r: tuple(key(v) for v in r))


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Reasons why the two results differ; none when they agree exactly."""
    out = []
    cur = con.execute(sql)
    want_types = {d[0]: str(d[1]) for d in cur.description}
    want = cur.fetchall()
    got_types = dict(df.dtypes)
    if sorted(got_types) != sorted(want_types):
        return [f"columns {sorted(got_types)} != {sorted(want_types)}"]
    names = sorted(got_types)
    for n in names:
        if TYPES.get(got_types[n], got_types[n]) != want_types[n]:
            out.append(f"type of {n}: {got_types[n]} != {want_types[n]}")
    at = [list(want_types).index(n) for n in names]
    want = ordered(tuple(r[i] for i in at) for r in want)
    got = ordered(tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect())
    if len(got) != len(want):
        out.append(f"rows {len(got)} != {len(want)}")
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        out.append(f"{len(bad)} rows differ, e.g. {bad[:2]}")
    return out


def check(spark: SparkSession, con: duckdb.DuckDBPyConnection, sf: str, q: Query) -> list[str]:
    df = q.run(spark, sf)
    if q.sql is None:
        return [] if df.count() > 0 else ["no rows"]
    return differences(df, con, q.sql)


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="0.001")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    sf = f"/root/testdata/sf{args.sf}"
    spark, con = session(), connect(sf)
    spark.sparkContext.setLogLevel("ERROR")
    failed = 0
    for name, q in all_queries().items():
        if args.names and not any(name.startswith(n) for n in args.names):
            continue
        t = time.time()
        try:
            why = check(spark, con, sf, q)
        except Exception as e:  # noqa: BLE001
            why = [str(e)[:1500] or traceback.format_exc()[-1500:]]
        failed += bool(why)
        print(f"{'FAIL' if why else 'ok  '} {name} {time.time() - t:.2f}s", flush=True)
        for w in why:
            print("     ", w[:1500], flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main() > 0)
