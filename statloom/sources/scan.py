"""CSV scans for wide statistical tables: markers, mixed headers, path columns, grids."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cols import literal, named, quoted
from ..functions.text import as_double, squish
from ..operators.frames import union_all
from ..operators.reshape import period_columns
from .leading import headers, leading

# fixed values: texts that stand for a missing number, by subject
AGRI_MARKS = ["..", "-", ":", "...", " ", ""]
TRADE_MARKS = ["..", "", "NA"]
PRICE_MARKS = [".."]


def csv_reader(spark: SparkSession):
    return (
        spark.read.option("header", True).option("escape", '"')
        .option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True))


def null_marks(c: Column, marks: Sequence[str]) -> Column:
    return F.when(~F.trim(c).isin(*marks), c)


def nulls_for_marks(df: DataFrame, marks: Sequence[str]) -> DataFrame:
    """Missing values in place of the markers, in every text column of a wide table."""
    listed = ", ".join(literal(m) for m in marks)
    return df.selectExpr(*[
        f"CASE WHEN trim({quoted(c)}) NOT IN ({listed}) THEN {quoted(c)} END AS {quoted(c)}"
        for c in df.columns])


def scan_strings(
    spark: SparkSession, paths: str | Sequence[str], marks: Sequence[str]
) -> DataFrame:
    """All-string CSV scan in which any of several markers means missing.

    All files must share one header; a differing header fails instead of shifting columns.
    """
    df = csv_reader(spark).option("enforceSchema", False).csv(paths)
    return nulls_for_marks(df, marks)


def scan_typed(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str | None = None,
    null_value: str = "..",
) -> DataFrame:
    """CSV scan with given types, or with inferred ones (which reads the data twice)."""
    reader = csv_reader(spark).option("nullValue", null_value)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).csv(path)


def header_of(spark: SparkSession, path: str) -> list[str]:
    """Column names of one CSV; only the first lines of its files are read."""
    return list(headers(spark, [path])[path])


SCHEME = r"^[A-Za-z0-9]*:?/+"  # names of one path differ in their slashes


def bare(path: str) -> str:
    return re.sub(SCHEME, "", path).rstrip("/")


def folders_below(root: str, path: str, depth: int) -> tuple[str | None, ...]:
    """Folder names of a path below `root`, outermost first, to a fixed depth."""
    parts = bare(path).split(bare(root) + "/", 1)[-1].split("/")
    return tuple((parts + [None] * depth)[:depth])


def scan_columns(spark: SparkSession, paths: str | Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Only the named columns, as text."""
    return csv_reader(spark).csv(paths).select(*[named(c) for c in cols])


@dataclass(frozen=True)
class Placed:
    """Paths with one header and one place in a tree."""

    header: tuple[str, ...]
    place: tuple[str | None, ...]
    paths: list[str]

    def scan(self, spark: SparkSession, names: Sequence[str], marks: Sequence[str]) -> DataFrame:
        """One string scan; the place is known, so its names are literals and not looked up for each row."""
        rows = nulls_for_marks(csv_reader(spark).csv(self.paths), marks)
        return rows.select("*", *[F.lit(v).cast("string").alias(n) for n, v in zip(names, self.place)])


def place_files(
    root: str, headers_of: Mapping[str, tuple[str, ...]], depth: int
) -> list[Placed]:
    """Paths below `root` by header and folder names."""
    groups: dict[tuple, list[str]] = {}
    for path, header in headers_of.items():
        groups.setdefault((header, folders_below(root, path, depth)), []).append(path)
    return [Placed(header, place, sorted(paths)) for (header, place), paths in groups.items()]


def tree_headers(spark: SparkSession, root: str, glob: str = "*.csv") -> dict[str, tuple[str, ...]]:
    """Headers below `root`: by folder, and by file only where the files of one folder differ.

    So the driver holds a name for each folder, not for each part.
    """
    found = leading(spark, [root], header=True, glob=glob).where("header IS NOT NULL").withColumn(
        "folder", F.regexp_replace("path", "/[^/]*$", ""))
    by_folder = found.groupBy("folder").agg(F.min("header").alias("one"), F.max("header").alias("other"))
    out = {r.folder: tuple(r.one) for r in by_folder.where("one = other").collect()}
    mixed = found.join(by_folder.where("one <> other").select("folder"), "folder", "left_semi")
    return out | {r.path: tuple(r.header) for r in mixed.select("path", "header").collect()}


def scan_tree(
    spark: SparkSession, root: str, depth_cols: Sequence[str], marks: Sequence[str] = AGRI_MARKS
) -> dict[tuple[str, ...], DataFrame]:
    """Every CSV below `root`, grouped by header, with columns from the folder names."""
    out: dict[tuple[str, ...], DataFrame] = {}
    for placed in place_files(root, tree_headers(spark, root), len(depth_cols)):
        rows = placed.scan(spark, depth_cols, marks)
        out[placed.header] = out[placed.header].unionByName(rows) if placed.header in out else rows
    return out


@dataclass(frozen=True)
class Layout:
    """Outcome of a header check."""

    accepted: list[str]
    rejects: DataFrame
    headers: Mapping[str, tuple[str, ...]]


REJECTS_SCHEMA = "file string, reason string"


def partition_valid(
    spark: SparkSession, paths: Sequence[str], min_categories: int = 1
) -> Layout:
    """Keep files that have period columns and enough category columns; report the rest."""
    accepted, rejects = [], []
    known = headers(spark, paths)
    for path, header in known.items():
        periods = period_columns(header)
        if not periods:
            rejects.append((path, "no period columns"))
        elif len(header) - len(periods) < min_categories:
            rejects.append((path, f"fewer than {min_categories} category columns"))
        else:
            accepted.append(path)
    return Layout(accepted, spark.createDataFrame(rejects, REJECTS_SCHEMA), known)


@dataclass(frozen=True)
class Roles:
    """Header patterns of a record file; the last matching value column is used."""

    code: str = r"(?i)commodity"
    country: str = r"(?i)country"
    value: str = r"(?i)FOB|CIF"


def find_roles(header: Sequence[str], roles: Roles) -> tuple[str, str, str, int]:
    """Names of the code, country and value columns, and the year in the value header."""

    def hits(rx: str) -> list[str]:
        found = [h for h in header if re.search(rx, h)]
        if not found:
            raise ValueError(f"no column matches {rx!r} in {list(header)}")
        return found

    value = hits(roles.value)[-1]
    year = re.search(r"\d{4}", value)
    if not year:
        raise ValueError(f"no year in value column {value!r}")
    return hits(roles.code)[0], hits(roles.country)[0], value, int(year.group())


def scan_vintages(
    spark: SparkSession, files: Mapping[str, Sequence[str]], roles: Roles = Roles(),
    marks: Sequence[str] = TRADE_MARKS,
) -> DataFrame:
    """Leaf records of a family of per-year files, by direction.

    Each path, a file or a folder of parts, names its value column after its year, so headers
    differ. One job reads all headers and checks that the parts of a path agree. Each path is
    a scan of its own with direction and year as literals: nothing is looked up for a row.
    """
    scans = []
    owned = [(d, p) for d, paths in files.items() for p in paths]
    known = headers(spark, [p for _, p in owned])
    for direction, path in owned:
        header = known[path]
        code, country, value, year = find_roles(header, roles)
        schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(header))])
        at = [f"c{header.index(c)}" for c in (code, country, value)]
        scans.append(csv_reader(spark).schema(schema).csv(path).select(
            F.lit(year).alias("year"), F.lit(direction).alias("direction"),
            null_marks(F.col(at[1]), marks).alias("country"), squish(null_marks(F.col(at[0]), marks)).alias("code"),
            as_double(null_marks(F.col(at[2]), marks)).alias("value")))
    return union_all(scans)


def grid_block(df: DataFrame, skip: int, n: int | None, names: Sequence[str]) -> DataFrame:
    """Rectangle of a landed sheet (`row_idx int, cells array<string>`), rows from 1.

    Skips `skip` rows, takes `n` (or all), and names the cells from the first.
    """
    rows = F.col("row_idx") > skip
    if n is not None:
        rows = rows & (F.col("row_idx") <= skip + n)
    return df.where(rows).select(
        "row_idx",
        *[F.get(F.col("cells"), F.lit(i)).alias(name) for i, name in enumerate(names)])


def valid_binary(df: DataFrame, magic: bytes, min_len: int) -> DataFrame:
    """Check landed files (`path, length, content`) by leading bytes and size."""
    head = F.substring(F.col("content"), 1, len(magic))
    ok = (F.col("length") > min_len) & (head == F.lit(bytearray(magic)))
    return df.select("path", "length", ok.alias("valid"))
