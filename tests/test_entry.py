import re
import subprocess
import sys

import __spark_entry__ as entry
import bench
from statloom.queries import all_queries


def test_every_query_has_sql():
    assert set(all_queries()) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_every_inventory_id_is_registered():
    wanted = {"s": 20, "p": 10, "r": 8, "j": 7, "a": 11, "w": 7, "o": 3, "u": 6, "f": 19, "d": 26}
    have = {re.match(r"([a-z]+\d+)_", n).group(1) for n in all_queries()}
    assert have == {f"{k}{i}" for k, n in wanted.items() for i in range(1, n + 1)}


def test_entry_schema(spark):
    df = entry.entry(spark)
    assert df.columns == ["year", "Exports", "Imports", "balance", "total_trade"]
    assert df.count() > 0


def test_bench_names_exist():
    assert set(bench.HEADLINE) <= set(entry.queries())


def test_registry_needs_no_session():
    code = "import __spark_entry__ as e; assert e.queries().keys() >= e.oracle_sql().keys()"
    subprocess.run([sys.executable, "-c", code], check=True)
