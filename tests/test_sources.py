import re
from datetime import date
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from statloom.sources import landing as G
from statloom.sources import scan as S
from statloom.sources import sinks as K
from statloom.sources.workspace import fresh_dir, shared_root
from statloom.streaming.resume import land_new_files


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_scan_strings_markers(spark, tmp_path):
    path = put(tmp_path / "a.csv", 'Item,1990 Q1,1990 Q2\n"..Rice, white", .. ,5\nCorn,...,-\nnote,,:\n')
    got = {tuple(r) for r in S.scan_strings(spark, path, S.AGRI_MARKS).collect()}
    assert got == {("..Rice, white", None, "5"), ("Corn", None, None), ("note", None, None)}


def test_scan_strings_refuses_mixed_headers(spark, tmp_path):
    put(tmp_path / "a.csv", "x,y\n1,2\n")
    put(tmp_path / "b.csv", "y,x\n1,2\n")
    with pytest.raises(Exception):
        S.scan_strings(spark, str(tmp_path), []).collect()


def test_scan_tree_with_blanks_in_names(spark, tmp_path):
    put(tmp_path / "Farm Prices" / "New + Old (x)" / "a.csv", "k,2000\na,1\n")
    put(tmp_path / "Retail Prices" / "Old" / "b.csv", "k,2000\nb,2\n")
    put(tmp_path / "Retail Prices" / "Old" / "c.csv", "k,2001\nc,3\n")
    groups = S.scan_tree(spark, str(tmp_path), ["Kind", "Series"])
    assert set(groups) == {("k", "2000"), ("k", "2001")}
    assert {tuple(r) for r in groups[("k", "2000")].collect()} == {
        ("a", "1", "Farm Prices", "New + Old (x)"), ("b", "2", "Retail Prices", "Old")}


def test_scan_vintages(spark, tmp_path):
    a = put(tmp_path / "Exports" / "e1999.csv",
            "Commodity Code,Country,1999 FOB Value (PHP),1999 FOB Value (USD)\n 01 , Japan,9,5\n02,China,9,..\n")
    b = put(tmp_path / "Exports" / "e2000.csv",
            "Commodity Code,Country,2000 FOB Value (PHP),2000 FOB Value (USD)\n01,Japan,9,6\n")
    c = put(tmp_path / "Imports" / "i1999.csv", "Country,Commodity Code,1999 CIF Value\nIndia,03,x\n")
    got = {tuple(r) for r in S.scan_vintages(spark, {"Exports": [a, b], "Imports": [c]}).collect()}
    assert got == {(1999, "Exports", "Japan", "01", 5.0), (1999, "Exports", "China", "02", None),
                   (2000, "Exports", "Japan", "01", 6.0), (1999, "Imports", "India", "03", None)}


def test_roles_must_be_found():
    with pytest.raises(ValueError):
        S.find_roles(["Commodity", "Country", "Value"], S.Roles())


def test_layout_check(spark, tmp_path):
    ok = put(tmp_path / "ok.csv", "Geo,Item,1990 January\na,b,1\n")
    one = put(tmp_path / "one.csv", "Item,2016 Quarter 1\nb,1\n")
    na = put(tmp_path / "na.csv", "NA\n")
    layout = S.partition_valid(spark, [ok, one, na], min_categories=2)
    assert layout.accepted == [ok]
    assert {(r["file"].rsplit("/", 1)[-1], r["reason"]) for r in layout.rejects.collect()} == {
        ("one.csv", "fewer than 2 category columns"), ("na.csv", "no period columns")}


def test_grid_block(spark):
    grid = spark.createDataFrame([(i, [f"a{i}", f"b{i}"]) for i in range(1, 8)], "row_idx int, cells array<string>")
    got = S.grid_block(grid, 2, 3, ["x", "y", "z"]).orderBy("row_idx").collect()
    assert [tuple(r) for r in got] == [(i, f"a{i}", f"b{i}", None) for i in (3, 4, 5)]


def test_valid_binary(spark, tmp_path):
    (tmp_path / "good.xlsx").write_bytes(b"PK" + b"0" * 2000)
    (tmp_path / "short.xlsx").write_bytes(b"PK")
    (tmp_path / "page.xlsx").write_bytes(b"<html>" + b"0" * 2000)
    files = spark.read.format("binaryFile").load(str(tmp_path))
    got = {r["path"].rsplit("/", 1)[-1]: r["valid"] for r in S.valid_binary(files, b"PK", 1000).collect()}
    assert got == {"good.xlsx": True, "short.xlsx": False, "page.xlsx": False}


# -- landing


def test_links(spark):
    html = '<a class="x" href="/a.xlsx">1</a><a href="/a.xlsx">2</a><a href="https://o.org/b.xlsx">3</a><a href="/c.pdf">'
    pages = spark.createDataFrame([(html,), (None,)], "html string")
    got = {r[0] for r in G.extract_links(pages, ".xlsx", "https://x.org").collect()}
    assert got == {"https://x.org/a.xlsx", "https://o.org/b.xlsx"}


def test_resolve_one(spark):
    links = spark.createDataFrame([("u/1981.xlsx",), ("u/1946.xlsx",), ("u/1946b.xlsx",)], "link string")
    got = {r["name"]: (r["matches"], r["status"], r["link"])
           for r in G.resolve_one(links, {"q": "1981", "a": "1946", "n": "1900"}).collect()}
    assert got == {"q": (1, "unique", "u/1981.xlsx"), "a": (2, "ambiguous", None), "n": (0, "missing", None)}


def test_listing(spark):
    doc = ('[{"id":"a","type":"t","text":"Exports 2007"},{"id":"b","type":"l","text":"2008"},'
           '{"id":"c","text":"Exports 1999"},{"id":null,"type":"t","text":"2001"},{"id":"d","type":"t","text":"none"}]')
    cat = spark.createDataFrame([(doc,)], "listing string")
    assert [(r["id"], r["year"]) for r in G.list_vintages(cat, "listing").collect()] == [("c", 1999), ("a", 2007)]
    assert [r["id"] for r in G.list_vintages(cat, "listing", [2007]).collect()] == ["a"]


def test_request_grid(spark):
    got = G.request_grid(spark.createDataFrame([(1994,), (1996,), (1994,)], "y int"), "y").orderBy("year", "period").collect()
    assert len(got) == 26
    assert got[13]["body"] == (
        '{"query":[{"code":"Year","selection":{"filter":"item","values":["2"]}},'
        '{"code":"Period","selection":{"filter":"item","values":["0"]}}],"response":{"format":"csv"}}')


def dims(spark, **sizes):
    return spark.createDataFrame(
        [("t", d, f"{i:05d}") for d, n in sizes.items() for i in range(n)], "table string, dim string, value string")


@pytest.mark.parametrize("sizes, cap", [
    ({"a": 7, "b": 13}, 30), ({"a": 100, "b": 3, "c": 2}, 50), ({"a": 5, "b": 5}, 25), ({"a": 9}, 2)])
def test_batches_stay_under_the_cap(spark, sizes, cap):
    got = G.plan_batches(dims(spark, **sizes), cap).collect()
    assert sum(r["n_values"] for r in got) == max(sizes.values())
    assert all(r["batch_cells"] <= cap for r in got)
    assert {r["dim"] for r in got} <= {d for d, n in sizes.items() if n == max(sizes.values())}


def test_too_large_slice_is_reported(spark):
    got = G.plan_batches(dims(spark, a=10, b=9), 8).collect()
    assert {(r["status"], r["batch"]) for r in got} == {("slice too large", None)}


def test_chosen_dimension(spark):
    got = G.plan_batches(dims(spark, a=10, b=4), 20, chunk_dim="b").collect()
    assert {r["dim"] for r in got} == {"b"} and len(got) == 2


def test_each_file_lands_once(spark, tmp_path):
    src, out, ck = (str(tmp_path / d) for d in ("in", "out", "ck"))
    schema = "k int, v string"
    run = lambda: land_new_files(spark, src, out, ck, schema)
    put(tmp_path / "in" / "a.csv", "k,v\n1,a\n")
    run()
    put(tmp_path / "in" / "b.csv", "k,v\n2,b\n")
    run()
    run()
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == [(1, "a"), (2, "b")]


# -- sinks


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("b", 1, date(2000, 1, 1)), ("a", None, None), ("b", 2, None)], "k string, v int, d date")
    K.write_tables({"t": df}, str(tmp_path / "csv"))
    assert sorted(map(str, S.scan_typed(spark, str(tmp_path / "csv" / "t.csv"), df.schema).collect())) == sorted(
        map(str, df.collect()))
    inv = K.output_inventory({"t": df}, str(tmp_path / "csv")).first()
    assert (inv["file"], inv["rows"]) == ("t.csv", 3) and inv["MB"] is not None
    assert [r[0] for r in K.distinct_labels(df, "k").collect()] == ["a", "b"]
    d = K.data_dictionary(spark, {"t": df}, {("t", "d"): "day"}).orderBy("position").collect()
    assert [tuple(r)[1:] for r in d] == [(1, "k", "string", None), (2, "v", "int", None), (3, "d", "date", "day")]
    with pytest.raises(KeyError):
        K.publish({"t": df}, ["t", "absent"], str(tmp_path / "pub"))


def test_failed_write_is_raised(spark, tmp_path):
    bad = spark.range(3).select(F.raise_error(F.lit("stop")).cast("string").alias("x"))
    with pytest.raises(Exception, match="stop"):
        K.write_tables({"bad": bad}, str(tmp_path / "x"))


def stub_session(settings, master):
    conf = SimpleNamespace(get=lambda k, default=None: settings.get(k, default), set=settings.__setitem__)
    context = SimpleNamespace(master=master, getConf=lambda: conf)
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_work_folder_is_the_named_one():
    cluster = stub_session({"spark.checkpoint.dir": "hdfs://x/ck/"}, "yarn")
    assert re.match("hdfs://x/ck/statloom/t-[0-9a-f]{32}$", fresh_dir(cluster, "t"))


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(ValueError):
        fresh_dir(stub_session({}, "spark://host:7077"), "t")
    local = stub_session({}, "local[2]")
    assert shared_root(local) == shared_root(local)
