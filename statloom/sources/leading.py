"""A batch source of how files begin: signatures and CSV headers, without reading the rest.

Its partitions are the list of files: the driver lists one level below the given paths, and
tasks list what is deeper and read the first bytes of each file. So neither a job for each file
nor a list of all parts on the driver is needed, and a file of any size costs a few bytes.
"""

from __future__ import annotations

import csv
import io
import json
import os
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from fnmatch import fnmatchcase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "owner int, path string, length bigint, head binary, header array<string>"
CHUNK = 1 << 16
#: A first record longer than this is taken for a file that is no CSV.
MAX_HEADER = 1 << 24
PARTITIONS = 64


def file_system(path: str):
    """File system of a path, the path inside it, and what stands before that in its name."""
    from pyarrow import fs

    scheme = re.match(r"([A-Za-z][A-Za-z0-9+.-]*):", path)
    if scheme is None:
        return fs.LocalFileSystem(), path, ""
    if scheme[1] == "file":
        inner = "/" + path[5:].lstrip("/")
        return fs.LocalFileSystem(), inner, path[:len(path) - len(inner)]
    system, inner = fs.FileSystem.from_uri(path)
    return system, inner, path[:len(path) - len(inner)]


def first_record(source, chunk: int = CHUNK) -> bytes | None:
    """The first CSV record that is not blank; None for a file without one."""
    data, at = b"", 0
    while True:
        more = source.read(chunk)
        data += more
        while (end := data.find(b"\n", at)) >= 0 or not more:
            end = len(data) if end < 0 else end
            if data.count(b'"', 0, end) % 2 == 0 or not more and end == len(data):
                record = data[:end]
                if record.strip():
                    return record
                if end == len(data):
                    return None
                data, at = data[end + 1:], 0
            else:
                at = end + 1  # the line break stands between quotes
        if len(data) > MAX_HEADER:
            raise ValueError(f"no record ends within {MAX_HEADER} bytes")


def header_names(record: bytes) -> list[str]:
    """Column names of a header record, as Spark's CSV reader gives them."""
    text = record.decode("utf-8", "replace").lstrip("﻿").rstrip("\r\n")
    cells = [c.strip() for c in next(csv.reader(io.StringIO(text), skipinitialspace=True))]
    low = [c.lower() for c in cells]
    return [f"_c{i}" if not c else f"{c}{i}" if low.count(c.lower()) > 1 else c for i, c in enumerate(cells)]


@dataclass
class Entries(InputPartition):
    """Files and folders, each with the number of the given path that it belongs to."""

    found: list[tuple[int, str]]


class LeadingReader(DataSourceReader):
    def __init__(self, options):
        self.roots = json.loads(options["roots"])
        self.n, self.header, self.glob = int(options["n"]), options["header"] == "true", options["glob"]

    def below(self, path: str, deep: bool):
        """Files at a path that a scan would read, and its folders where `deep` is not asked for."""
        from pyarrow import fs

        system, inner, before = file_system(path)
        info = system.get_file_info(inner)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(path)
        if info.type == fs.FileType.File:
            return [(info, before)]
        found = system.get_file_info(fs.FileSelector(inner, recursive=deep))
        start = len(inner.rstrip("/")) + 1
        return [
            (f, before) for f in found
            if not re.search(r"(^|/)(\.|_(?![^/]*=))", f.path[start:])
            and (not deep and f.type == fs.FileType.Directory or f.type == fs.FileType.File and fnmatchcase(f.base_name, self.glob))]

    def partitions(self) -> Sequence[InputPartition]:
        found = [
            (owner, before + info.path) for owner, root in enumerate(self.roots) for info, before in self.below(root, deep=False)]
        return [Entries(found[k::PARTITIONS]) for k in range(min(PARTITIONS, len(found)))] or [Entries([])]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        for owner, path in partition.found:
            for info, before in self.below(path, deep=True):
                head, header = b"", None
                if self.n:
                    with file_system(path)[0].open_input_file(info.path) as f:
                        head = f.read(self.n)
                if self.header:
                    with file_system(path)[0].open_input_stream(info.path) as f:  # packed files are unpacked
                        record = first_record(f)
                    header = None if record is None else header_names(record)
                yield owner, before + info.path, info.size, head, header


class LeadingBytes(DataSource):
    """`owner` is the number of the given path, `head` the first bytes, `header` the names in the first record."""

    @classmethod
    def name(cls) -> str:
        return "leading_bytes"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> LeadingReader:
        return LeadingReader(dict(self.options))


def leading(
    spark: SparkSession, paths: Sequence[str], n: int = 0, header: bool = False, glob: str = "*"
) -> DataFrame:
    """How each file at or below the paths begins (`SCHEMA`): its first `n` bytes, its header on request."""
    roots = [p if ":" in p or p.startswith("/") else os.path.abspath(p) for p in paths]
    spark.dataSource.register(LeadingBytes)
    return spark.read.format("leading_bytes").options(
        roots=json.dumps(roots), n=str(n), header=str(header).lower(), glob=glob).load()


def has_magic(magic: bytes, min_len: int) -> Column:
    """Whether a file of `leading` is longer than `min_len` and begins with these bytes."""
    return (F.col("length") > min_len) & (F.substring("head", 1, len(magic)) == F.lit(bytearray(magic)))


def headers(spark: SparkSession, paths: Sequence[str]) -> dict[str, tuple[str, ...]]:
    """Header of each path, a file or a folder of parts, in one job; no names for a path without a record.

    The parts of a folder must agree: rows of a part with another header would come under wrong names.
    """
    found = leading(spark, paths, header=True).where("header IS NOT NULL").groupBy("owner").agg(
        F.min("header").alias("one"), F.max("header").alias("other")).collect()  # one row for each given path
    for r in found:
        if r.one != r.other:
            raise ValueError(f"parts of {paths[r.owner]} differ in their headers: {r.one} and {r.other}")
    by_owner = {r.owner: tuple(r.one) for r in found}
    return {p: by_owner.get(i, ()) for i, p in enumerate(paths)}
