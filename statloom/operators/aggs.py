"""Marginals, rollups, downsampling, audits and reconciliation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.cols import ColumnLike, as_col, named
from ..functions.numbers import round_even, total
from ..sources.workspace import stage
from .joins import natural_join


@dataclass(frozen=True)
class Marginal:
    """One marginal table of a fact: its keys and the rows it covers."""

    keys: Sequence[str]
    where: Column | None = None
    rename: Mapping[str, str] = field(default_factory=dict)


def marginals(
    base: DataFrame, specs: Mapping[str, Marginal], value: str, digits: int | None = None
) -> dict[str, DataFrame]:
    """Several marginals of one fact, from one aggregation of it.

    All key sets are grouping sets of one pass over `base`: one scan and one shuffle, of rows that
    each task has already summed. The rows that a marginal covers are a condition in its sum, and
    a count by the same condition leaves out groups without such rows. The result, small beside
    the fact, is written once and each marginal reads its part.
    """
    keys = list(dict.fromkeys(k for m in specs.values() for k in m.keys))
    sets = list(dict.fromkeys(frozenset(m.keys) for m in specs.values()))
    rows = base.withColumns({f"__k{i}": named(k) for i, k in enumerate(keys)})
    covers = {
        name: F.lit(True) if m.where is None else F.coalesce(m.where, F.lit(False)) for name, m in specs.items()}
    rows = rows.withColumns({f"__in{j}": c for j, c in enumerate(covers.values())})
    own = [f"__k{i}" for i in range(len(keys))]
    sums = [c for j in range(len(specs)) for c in (
        total(F.when(F.col(f"__in{j}"), named(value)), digits).alias(f"__v{j}"),
        F.count_if(F.col(f"__in{j}")).alias(f"__n{j}"))]
    grouped = rows.groupingSets([[F.col(f"__k{keys.index(k)}") for k in s] for s in sets], *own).agg(
        F.grouping_id(*own).alias("__set"), *sums)
    summed = stage(grouped, "marginals")
    out = {}
    for j, (name, m) in enumerate(specs.items()):
        # Bits of the grouping id mark the keys that a set leaves out, the first key the highest.
        left_out = sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in m.keys)
        part = summed.where((F.col("__set") == left_out) & (F.col(f"__n{j}") > 0)).select(
            *[F.col(f"__k{keys.index(k)}").alias(k) for k in m.keys], F.col(f"__v{j}").alias(value))
        out[name] = part.withColumnsRenamed(dict(m.rename))
    return out


def rollup_from(df: DataFrame, keys: Sequence[str], value: str = "value_usd") -> DataFrame:
    """Coarser table from a finer one (sums of its already rounded values)."""
    return df.groupBy(*[named(k) for k in keys]).agg(F.sum(named(value)).alias(value))


def annual_balance(df: DataFrame, value: str = "value_usd") -> DataFrame:
    """Exports and imports side by side with balance and total; NULL if one is absent."""
    sides = [
        F.sum(F.when(F.col("direction") == d, named(value))).alias(d) for d in ("Exports", "Imports")]
    return df.groupBy("year").agg(*sides).withColumns({
        "balance": F.col("Exports") - F.col("Imports"),
        "total_trade": F.col("Exports") + F.col("Imports"),
    })


def to_quarter_sum(
    df: DataFrame, keys: Sequence[str], month: str, value: str, name: str = "Quarter",
    digits: int | None = None,
) -> DataFrame:
    """Monthly flows to quarters; missing months are skipped and an empty quarter is 0."""
    return df.groupBy(*[named(k) for k in keys], F.trunc(named(month), "quarter").alias(name)).agg(
        F.coalesce(total(value, digits), F.lit(0.0)).alias(value))


def to_quarter_end(df: DataFrame, month: str, name: str = "Quarter") -> DataFrame:
    """Stocks at the end of each quarter: the rows of March, June, September, December."""
    return df.where(F.month(named(month)) % 3 == 0).withColumn(name, F.trunc(named(month), "quarter"))


def n_distinct(c: ColumnLike) -> Column:
    """Distinct values, a missing value counting as one."""
    col = as_col(c)
    return F.count_distinct(col) + F.max(col.isNull().cast("bigint"))


def distinct_sketch(c: ColumnLike, log2_slots: int = 12) -> Column:
    """A sketch of the distinct values, a missing value counting as one, of a few kilobytes whatever their number.

    Sketches of parts merge (`merged_sketch`) to the sketch of the whole, so distinct counts of any
    coarser grouping follow from stored ones without the rows. The standard error of a count is
    about 0.83 / sqrt(2^log2_slots): 1.3 % by default.
    """
    col = as_col(c)
    tagged = F.coalesce(F.concat(F.lit("v"), col.cast("string")), F.lit("missing"))
    return F.hll_sketch_agg(tagged, F.lit(log2_slots))


def merged_sketch(c: ColumnLike) -> Column:
    return F.hll_union_agg(as_col(c))


def sketch_count(c: ColumnLike) -> Column:
    return F.hll_sketch_estimate(as_col(c))


def share_where(flag: ColumnLike, value: ColumnLike) -> Column:
    """Part of the total that carries the flag."""
    v = as_col(value)
    return F.try_divide(F.coalesce(F.sum(F.when(as_col(flag), v)), F.lit(0)), F.sum(v))


def arg_max(key: ColumnLike, value: ColumnLike) -> Column:
    """Key of the largest value; the smallest key on a tie. Missing values do not count."""
    v, k = as_col(value), as_col(key)
    return F.when(F.count(v) > 0, F.min_by(k, F.when(v.isNotNull(), F.struct(-v, k))))


def code_profile(
    df: DataFrame, code: str, per: str, order: str, n_samples: int = 6
) -> DataFrame:
    """Per file: distinct codes, their length histogram as text, and the first few codes.

    Codes are reduced to one row each before anything is gathered; the gathered lists are
    bounded by the number of lengths and of samples.
    """
    codes = df.groupBy(named(per), named(code)).agg(F.min(named(order)).alias("__first"))
    lens = codes.groupBy(named(per), F.length(named(code)).alias("__len")).agg(
        F.count("*").alias("__n"))
    hist = lens.groupBy(named(per)).agg(
        F.sum("__n").alias("n_codes"),
        F.array_sort(F.collect_list(F.struct("__len", "__n"))).alias("__h"))
    w = Window.partitionBy(named(per)).orderBy("__first", named(code))
    first = (
        codes.withColumn("__k", F.row_number().over(w)).where(F.col("__k") <= n_samples)
        .groupBy(named(per))
        .agg(F.array_sort(F.collect_list(F.struct("__k", named(code).alias("__c")))).alias("__s")))
    text = lambda arr, fn: F.concat_ws(", ", F.transform(F.col(arr), fn))
    return hist.join(first, [per]).select(
        named(per), F.col("n_codes"),
        text("__h", lambda e: F.concat_ws(":", e["__len"], e["__n"])).alias("length_dist"),
        text("__s", lambda e: e["__c"]).alias("samples"))


def coverage_audit(annual: DataFrame, partner: DataFrame, commodity: DataFrame) -> DataFrame:
    """Per year: totals in billions, partners, codes, and commodity value as % of trade."""
    totals = annual.select(
        "year", round_even(F.col("Exports") / 1e9, 1).alias("exports_B"),
        round_even(F.col("Imports") / 1e9, 1).alias("imports_B"),
        (F.col("Exports") + F.col("Imports")).alias("__all"))
    who = partner.groupBy("year").agg(n_distinct("country").alias("countries"))
    what = commodity.groupBy("year").agg(
        n_distinct("code").alias("codes"), F.sum("value_usd").alias("__commodity"))
    cover = round_even(F.try_divide(F.lit(100.0) * F.col("__commodity"), F.col("__all")), 1)
    return (
        totals.join(who, ["year"], "left").join(what, ["year"], "left")
        .select("year", "exports_B", "imports_B", "countries", "codes",
                cover.alias("commodity_cover")))


def rounding_tolerance(n: Column) -> Column:
    """How far a sum of n values, each rounded to a whole unit, may lie from the sum of the exact ones."""
    return n * F.lit(0.5)


def reconcile(
    a: DataFrame, b: DataFrame, keys: Sequence[str], value: str, tolerance: float | None = 0.0
) -> DataFrame:
    """Totals of two tables side by side per key, their gap and whether it is tolerated.

    Missing keys match each other. Without a tolerance the two are taken for tables of whole
    units whose exact totals are the same: the gap may be half a unit for each row of either.
    """

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(*[named(k) for k in keys]).agg(
            F.sum(named(value)).alias(f"{name}_total"), F.count(named(value)).alias(f"__{name}_n"))

    both = natural_join(side(a, "left"), side(b, "right"), "full", list(keys), unique_keys=True)
    gap = F.abs(F.coalesce(F.col("left_total"), F.lit(0.0)) - F.coalesce(F.col("right_total"), F.lit(0.0)))
    rows = F.coalesce("__left_n", F.lit(0)) + F.coalesce("__right_n", F.lit(0))
    allowed = rounding_tolerance(rows) if tolerance is None else F.lit(tolerance)
    return both.withColumns({"gap": gap, "agrees": gap <= allowed}).drop("__left_n", "__right_n")


def residual_share(partner: DataFrame) -> DataFrame:
    """Share of each year's trade under residual (non-country) labels."""
    return partner.groupBy("year").agg(share_where("is_resid", "value_usd").alias("share"))


def residual_summary(shares: DataFrame) -> DataFrame:
    """One row: the largest share and its year (the first of equal ones), the last year and its share."""
    return shares.agg(
        F.max("share").alias("max_share"), arg_max("year", "share").alias("max_year"),
        F.max("year").alias("last_year"), F.max_by("share", "year").alias("last_share"))
