"""How files begin: headers and signatures as Spark's own readers see them."""

import gzip

import pytest
from pyspark.sql import functions as F

from statloom.sources import leading as L
from statloom.sources import scan as S
from tests.test_sources import put


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("text", [
    "a,b\n1,2\n", "a,b", "\n \na,b\n1,2\n", ' a , "b, c" ,d\n1,2,3\n', "a,,b,\n1,2,3,4\n", "x,X,y,x\n1,2,3,4\n", 'a,"two\nlines",b\n1,2,3\n',
    'a,"q ""q"" q"\n1,2\n', "é,Ünit\r\n1,2\r\n"])
def test_headers_are_those_of_the_csv_reader(spark, tmp_path, text):
    path = put(tmp_path / "a.csv", text)
    want = S.csv_reader(spark).option("multiLine", True).csv(path).columns
    assert list(L.headers(spark, [path])[path]) == want


@pytest.mark.parametrize("chunk", [1, 7, 1 << 16])
def test_first_record_over_chunks(chunk):
    import io

    assert L.first_record(io.BytesIO(b'\n\n"a\nb",c\nrest,"\n'), chunk) == b'"a\nb",c'
    assert L.first_record(io.BytesIO(b"only"), chunk) == b"only"
    assert L.first_record(io.BytesIO(b" \n\n"), chunk) is None
    assert L.first_record(io.BytesIO(b""), chunk) is None


def test_a_file_without_records_is_no_csv(monkeypatch):
    import io

    monkeypatch.setattr(L, "MAX_HEADER", 100)
    with pytest.raises(ValueError):
        L.first_record(io.BytesIO(b"x" * 1000), 10)


def test_parts_must_agree(spark, tmp_path):
    put(tmp_path / "v.csv" / "part-0.csv", "a,b\n1,2\n")
    put(tmp_path / "v.csv" / "part-1.csv", "a,b\n3,4\n")
    put(tmp_path / "v.csv" / "part-2.csv", "")
    put(tmp_path / "v.csv" / "_SUCCESS", "c,d\n")
    folder = str(tmp_path / "v.csv")
    assert L.headers(spark, [folder]) == {folder: ("a", "b")}
    put(tmp_path / "v.csv" / "part-3.csv", "b,a\n3,4\n")
    with pytest.raises(ValueError, match="differ"):
        L.headers(spark, [folder])


def test_records_with_differing_parts_are_refused(spark, tmp_path):
    put(tmp_path / "e.csv" / "p0.csv", "Commodity,Country,1999 FOB\n01,Japan,5\n")
    put(tmp_path / "e.csv" / "p1.csv", "Country,Commodity,1999 FOB\nJapan,01,5\n")
    with pytest.raises(ValueError):
        S.scan_vintages(spark, {"Exports": [str(tmp_path / "e.csv")]})


def test_empty_packed_and_absent_files(spark, tmp_path):
    empty = put(tmp_path / "empty.csv", "")
    packed = tmp_path / "p.csv.gz"
    packed.write_bytes(gzip.compress(b"k,2000\na,1\n"))
    assert L.headers(spark, [empty, str(packed)]) == {empty: (), str(packed): ("k", "2000")}
    with pytest.raises(Exception, match="absent"):
        L.headers(spark, [str(tmp_path / "absent.csv")])
    assert L.headers(spark, []) == {}


def test_magic_reads_a_few_bytes(spark, tmp_path):
    (tmp_path / "deep" / "er").mkdir(parents=True)
    (tmp_path / "good.xlsx").write_bytes(b"PK" + b"0" * 2000)
    (tmp_path / "deep" / "short.xlsx").write_bytes(b"P")
    (tmp_path / "deep" / "er" / "page.xlsx").write_bytes(b"<html>" + b"0" * 2000)
    (tmp_path / "deep" / "other.txt").write_bytes(b"PK" + b"0" * 2000)
    found = L.leading(spark, [str(tmp_path)], n=2, glob="*.xlsx")
    assert found.agg(F.max(F.length("head"))).first()[0] == 2
    got = {r.path.rsplit("/", 1)[-1]: (r.length, r.ok) for r in found.withColumn("ok", L.has_magic(b"PK", 1000)).collect()}
    assert got == {"good.xlsx": (2002, True), "short.xlsx": (1, False), "page.xlsx": (2006, False)}


def test_folder_of_many_headers(spark, tmp_path):
    """Files of one folder with two headers are told apart; other folders are one path each."""
    for k in range(5):
        put(tmp_path / "A" / "x" / f"{k}.csv", f"k,{2000 + k % 2}\n{k},1\n")
        put(tmp_path / "B" / "y" / f"{k}.csv", f"k,2000\nb{k},1\n")
    known = S.tree_headers(spark, str(tmp_path))
    assert len(known) == 6 and known[str(tmp_path / "B" / "y")] == ("k", "2000")
    groups = S.scan_tree(spark, str(tmp_path), ["one", "two"])
    assert {tuple(r) for r in groups["k", "2001"].collect()} == {("1", "1", "A", "x"), ("3", "1", "A", "x")}
    assert {r.k for r in groups["k", "2000"].collect()} == {"0", "2", "4", *(f"b{k}" for k in range(5))}


def test_no_row_is_joined_with_its_file(spark, tmp_path):
    paths = [put(tmp_path / f"e{y}.csv", f"Commodity,Country,{y} FOB\n01,Japan,{y}\n") for y in (1999, 2000)]
    rows = S.scan_vintages(spark, {"Exports": paths})
    assert "Join" not in plan(rows) and "Python" not in plan(rows) and "file_path" not in plan(rows)
    assert {tuple(r) for r in rows.collect()} == {(y, "Exports", "Japan", "01", float(y)) for y in (1999, 2000)}
    tree = next(iter(S.scan_tree(spark, str(tmp_path.parent), ["one"]).values()))
    assert "Join" not in plan(tree) and "file_path" not in plan(tree)
