"""Landing jobs: harvested links, catalog listings, request grids and batches."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.cols import named
from ..functions.links import hrefs, resolved
from ..functions.text import extract
from ..operators.numbering import ranked
from .workspace import stage

LISTING_SCHEMA = "array<struct<id:string,type:string,text:string>>"

#: Characters of the piece of a pattern by which links are looked up.
PIECE = 3
#: Patterns without such a piece are tested on every link, so there may not be many.
MAX_OPEN = 200


def extract_links(
    pages: DataFrame, suffix: str, base: str | Column, html: str = "html"
) -> DataFrame:
    """Distinct links of the pages that end in `suffix`, resolved against `base`, the address of the page or of all pages."""
    at = F.lit(base) if isinstance(base, str) else base
    links = pages.select(at.alias("__base"), F.explode(hrefs(html)).alias("href"))
    return links.where(F.col("href").endswith(suffix)).select(resolved("__base", "href").alias("link")).distinct()


def required_text(pattern: str) -> str:
    """The longest text that every match of a pattern surely holds; empty where none is sure.

    It reads plain characters outside groups, classes and alternatives, and takes nothing from a pattern
    with flags or quoted stretches: too short a text costs time, a wrong one would lose links.
    """
    if re.search(r"\(\?[a-zA-Z-]+[:)]|\\[QE]", pattern):
        return ""
    best, run, i, depth = "", "", 0, 0
    while i < len(pattern):
        c, plain, width = pattern[i], None, 1
        if c == "|" and depth == 0:
            return ""
        if c == "\\":
            following = pattern[i + 1:i + 2]
            width = 2
            if following and not following.isalnum():
                plain = following
            elif following in tuple("pPxucN0123456789k"):
                return best if len(best) >= len(run) else run  # what such an escape takes up is not read
        elif c == "[":
            end = i + 1 + (pattern[i + 1:i + 2] == "^")
            end += pattern[end:end + 1] == "]"
            inner = 1
            while end < len(pattern) and inner:
                inner += {"[": 1, "]": -1}.get(pattern[end], 0)
                end += 2 if pattern[end] == "\\" else 1
            width = end - i
        elif c in "()":
            depth += 1 if c == "(" else -1
        elif c not in ".^$*+?{}":
            plain = c
        i += width
        quantifier = re.match(r"[*+?]|\{[0-9]+(,[0-9]*)?\}", pattern[i:])
        if quantifier:
            i += quantifier.end()
            i += pattern[i:i + 1] in ("?", "+")
        if plain is None or depth:
            best, run = (run if len(run) > len(best) else best), ""
        elif quantifier is None:
            run += plain
        else:
            sure = quantifier.group()[0] == "+" or re.match(r"\{0*[1-9]", quantifier.group())
            run += plain if sure else ""
            best, run = (run if len(run) > len(best) else best), ""
    return run if len(run) > len(best) else best


def pattern_pieces(patterns: DataFrame) -> DataFrame:
    """(name, pattern, pieces): the pieces of the text that each pattern requires."""

    def run(batches):
        for b in batches:
            for name, rx in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                text = required_text(rx)
                pieces = sorted({text[k:k + PIECE] for k in range(len(text) - PIECE + 1)})
                yield pa.RecordBatch.from_pylist([{"name": name, "pattern": rx, "pieces": pieces}], schema=schema)

    schema = pa.schema([("name", pa.string()), ("pattern", pa.string()), ("pieces", pa.list_(pa.string()))])
    given = patterns.select("name", "pattern").where("pattern IS NOT NULL")
    return given.mapInArrow(run, "name string, pattern string, pieces array<string>")


def matching_links(links: DataFrame, patterns: DataFrame) -> DataFrame:
    """(name, link) of every link that matches a pattern of (name, pattern).

    A pattern meets only the links that hold its rarest required piece, found by an equi-join;
    then the pattern itself decides. Links that stand nowhere in an index of pieces cost it nothing.
    """
    own = stage(pattern_pieces(patterns), "patterns")
    given = links.select("link").where("link IS NOT NULL").distinct()
    places = F.sequence(F.lit(1), F.length("link") - (PIECE - 1))
    pieces = stage(given.where(F.length("link") >= PIECE).select("link", F.explode(F.array_distinct(
        F.transform(places, lambda i: F.substring("link", i, F.lit(PIECE))))).alias("piece")), "link-pieces")
    wanted = own.select("name", "pattern", F.explode("pieces").alias("piece"))
    counts = pieces.join(wanted.select("piece").distinct(), "piece", "left_semi").groupBy("piece").agg(F.count("*").alias("n"))
    rarest = wanted.join(counts, "piece", "left").groupBy("name", "pattern").agg(
        F.min_by("piece", F.struct(F.coalesce("n", F.lit(0)), "piece")).alias("piece"))
    found = rarest.join(pieces, "piece").where(F.expr("link RLIKE pattern")).select("name", "link")
    open_ones = own.where(F.size("pieces") == 0).select("name", "pattern").limit(MAX_OPEN + 1).collect()
    if len(open_ones) > MAX_OPEN:
        raise ValueError(f"more than {MAX_OPEN} patterns require no text of {PIECE} characters")
    if open_ones:
        tests = F.array(*[F.when(F.col("link").rlike(r.pattern), F.lit(r.name)) for r in open_ones])
        found = found.unionByName(given.select(F.explode(F.array_compact(tests)).alias("name"), "link"))
    return found.distinct()


def resolve_links(links: DataFrame, patterns: DataFrame, how: str = "one") -> DataFrame:
    """Links of each pattern of (name, pattern): `one` demands a single match, `first` takes the smallest, `all` has a row for each.

    Every pattern has at least one row: name, matches, status (unique, missing, ambiguous), link.
    """
    if how not in ("one", "first", "all"):
        raise ValueError(f"how is one, first or all, not {how!r}")
    found = matching_links(links, patterns)
    counted = found.groupBy("name").agg(F.count("*").alias("matches"), F.min("link").alias("first_link"))
    n = F.coalesce(F.col("matches"), F.lit(0))
    status = F.when(n == 1, "unique").when(n == 0, "missing").otherwise("ambiguous")
    out = patterns.select("name").distinct().join(counted, "name", "left").select(
        "name", n.alias("matches"), status.alias("status"), "first_link")
    if how == "all":
        return out.join(found, "name", "left").select("name", "matches", "status", "link")
    link = F.col("first_link") if how == "first" else F.when(F.col("status") == "unique", F.col("first_link"))
    return out.select("name", "matches", "status", link.alias("link"))


def resolve_one(links: DataFrame, patterns: Mapping[str, str]) -> DataFrame:
    """Resolve each named pattern to a link, demanding exactly one match."""
    table = links.sparkSession.createDataFrame(list(patterns.items()), "name string, pattern string")
    return resolve_links(links, table)


def list_vintages(
    catalog: DataFrame, listing: str, years: Sequence[int] | None = None
) -> DataFrame:
    """Tables of catalog listings (JSON arrays) with the year in their title, by year."""
    items = catalog.select(F.inline(F.from_json(named(listing), LISTING_SCHEMA)))
    kind = F.coalesce(F.col("type"), F.lit("t"))
    tables = items.where((kind == "t") & F.col("id").isNotNull()).withColumn(
        "year", extract("text", r"\d{4}").cast("int")).where(F.col("year").isNotNull())
    if years is not None:
        tables = tables.where(F.col("year").isin(*years))
    return tables.select("id", "text", "year").orderBy("year", "id")


def selection(code: str, value: Column) -> Column:
    """One `item` selection of a table query."""
    return F.struct(
        F.lit(code).alias("code"),
        F.struct(F.lit("item").alias("filter"), F.array(value.cast("string")).alias("values"))
        .alias("selection"))


def request_grid(years: DataFrame, year: str, periods: int = 13) -> DataFrame:
    """One request per year and period number, with its JSON body.

    Years count from the first one, as their position in the remote list.
    """
    first = years.agg(F.min(named(year))).scalar()
    grid = (
        years.select(named(year).alias("year")).distinct()
        .withColumn("year_pos", F.col("year") - first)
        .withColumn("period", F.explode(F.sequence(F.lit(0), F.lit(periods - 1)))))
    body = F.to_json(F.struct(
        F.array(selection("Year", F.col("year_pos")), selection("Period", F.col("period")))
        .alias("query"),
        F.struct(F.lit("csv").alias("format")).alias("response")))
    return grid.withColumn("body", body)


def plan_batches(
    dim_values: DataFrame, cap: int, safety: float = 1.0, chunk_dim: str | None = None, order: str = "value"
) -> DataFrame:
    """Split each table's request so that no batch exceeds `cap * safety` cells.

    Input has one row per (table, dim, value), and may have the place of the value in its
    document, which `order` names. The dimension named `chunk_dim`, or the largest one, is cut
    into batches in that order. `values` has those of a batch in order, at most `cap * safety`, ready
    to be sent. A table one of whose slices is too large by itself gets status `slice too large` instead of
    batches; small tables get one batch. Cells are exact whole decimals.
    """
    limit = int(cap * safety)
    values = dim_values.groupBy("table", "dim", "value").agg(F.min(named(order)).alias("__place"))
    sizes = values.groupBy("table", "dim").agg(F.count("*").alias("size"))
    wanted = F.lit(0) if chunk_dim is None else (F.col("dim") == chunk_dim).cast("int")
    product = F.aggregate(  # over the dimensions of one table
        F.collect_list("size"), F.lit(1).cast("decimal(38,0)"), lambda acc, x: (acc * x.cast("decimal(19,0)")).cast("decimal(38,0)"))
    dims = sizes.groupBy("table").agg(
        product.alias("cells"), F.max(F.struct(wanted.alias("w"), F.col("size"), F.col("dim"))).alias("__cut"))
    plan = dims.select(
        "table", "cells", F.col("__cut.dim").alias("dim"), F.col("__cut.size").alias("size")).withColumn(
        "slice", (F.col("cells") / F.col("size")).cast("decimal(38,0)"))
    status = (
        F.when(F.col("cells") <= limit, "one request")
        .when(F.col("slice") > limit, "slice too large").otherwise("batched"))
    width = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.col("slice"))).cast("bigint")
    plan = plan.withColumn("status", status).withColumn(
        "batch_values",
        F.when(F.col("status") == "one request", F.col("size"))
        .when(F.col("status") == "batched", width))
    cut = values.join(plan.select("table", "dim"), ["table", "dim"], "left_semi")
    # Values of a dimension may be many: they are ranked by ranges, and a batch holds a limited number.
    placed = ranked(cut, ["table", "dim"], ["__place", "value"], "__k").join(plan, ["table", "dim"])
    batch = (F.floor((F.col("__k") - 1) / F.col("batch_values")) + 1).cast("int")
    listed = F.when(F.col("status") != "slice too large", F.struct("__k", "value"))
    return (
        placed.withColumn("batch", batch)
        .groupBy("table", "dim", "status", "cells", "batch")
        .agg(F.count("*").alias("n_values"), F.min_by("value", "__k").alias("first_value"),
             F.max_by("value", "__k").alias("last_value"), F.max("slice").alias("__slice"),
             F.array_sort(F.collect_list(listed)).getField("value").alias("values"))
        .withColumn("batch_cells", F.col("n_values") * F.col("__slice")).drop("__slice"))
