"""Trade: leaf records (year, direction, country, code, value) to seven tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cols import ColumnLike, as_col
from ..functions.labels import classify, in_set
from ..functions.numbers import round_even, units
from ..functions.text import as_int, pad, remove_all, squish
from ..operators.aggs import annual_balance, rollup_from
from ..operators.joins import label_lookup
from ..sources.workspace import stage
from . import trade_values as V


@dataclass(frozen=True)
class TradeConfig:
    hs_digits: int = V.HS_DIGITS
    include_pre_hs: bool = True
    value_digits: int | None = 2  # decimals of an amount, more raise; None sums as they are


# -- label and code rules --------------------------------------------------------------


def clean_country(c: ColumnLike) -> Column:
    """Upper-cased label without a trailing note mark (`1/`) or trailing `.,`."""
    upper = squish(F.upper(as_col(c)))
    return squish(remove_all(remove_all(upper, r"\s*\d+/\s*$"), r"[.,]+$"))


def canon_of_clean(c: ColumnLike) -> Column:
    """Canonical country of a cleaned label; the rule order is part of the result."""
    label = as_col(c)
    rules = []
    for rx, exact, unless, also, result in V.COUNTRY_RULES:
        hit = label.rlike(rx)
        if exact:
            hit = hit | label.isin(*exact)
        if also:
            hit = hit & label.rlike(also)
        if unless:
            hit = hit & ~label.rlike(unless)
        rules.append((hit, result))
    return classify(rules, label)


def canon_country(c: ColumnLike) -> Column:
    """Canonical country of a raw label."""
    return canon_of_clean(clean_country(c))


def with_canonical(df: DataFrame, raw: str = "country") -> DataFrame:
    """Canonical country in place of the raw label, cleaned once and not once per rule."""
    return df.withColumn("__label", clean_country(raw)).withColumn(
        raw, canon_of_clean("__label")).drop("__label")


def is_residual(raw: ColumnLike) -> Column:
    """Whether a raw label names a residual aggregate and not a country."""
    label = F.upper(as_col(raw))
    return label.rlike(V.RESIDUAL_RX) & ~label.rlike(V.RESIDUAL_NOT_RX)


def is_europe(country: ColumnLike) -> Column:
    c = as_col(country)
    return c.rlike(V.EUROPE_RX) & ~c.rlike(V.EUROPE_NOT_RX)


def is_asean(country: ColumnLike) -> Column:
    return in_set(country, V.ASEAN)


def region_of(country: ColumnLike) -> Column:
    """Region of a canonical country. Europe comes first: ROMANIA also holds OMAN."""
    c = as_col(country)
    return classify(
        [
            (is_europe(c), "Europe"),
            (c.isin(*V.EAST_ASIA), "East Asia"),
            (c.isin(*V.ASEAN), "ASEAN"),
            (c.isin(*V.NORTH_AMERICA), "North America"),
            (c.isin(*V.OCEANIA), "Oceania"),
            (c.rlike(V.MIDDLE_EAST_RX), "Middle East"),
            (c.rlike(V.SOUTH_ASIA_RX), "South Asia"),
        ],
        "Rest of world",
    )


def hs_era(code: ColumnLike) -> Column:
    return F.when(F.length(as_col(code)) >= V.HS_MIN_LENGTH, "HS").when(
        as_col(code).isNotNull(), "pre-HS")


def classification(code: ColumnLike) -> Column:
    return F.when(F.length(as_col(code)) >= V.HS_MIN_LENGTH, "HS").when(
        as_col(code).isNotNull(), "PSCC")


def code_key(code: ColumnLike, digits: int = V.HS_DIGITS) -> Column:
    """Harmonised codes cut to `digits`, older ones whole."""
    c = as_col(code)
    return F.when(F.length(c) >= V.HS_MIN_LENGTH, F.substring(c, 1, digits)).otherwise(c)


def chapter_group(chapter: ColumnLike) -> Column:
    number = as_int(chapter)
    return classify([(number.between(a, b), g) for a, b, g in V.CHAPTER_GROUPS], V.NO_GROUP)


def chapter_label(chapter: ColumnLike) -> Column:
    """Chapter name; `Chapter NN` for one that the table does not list."""
    two = pad(as_int(chapter), 2)
    return label_lookup(
        two, V.CHAPTER_LABELS, F.concat(F.lit("Chapter "), F.coalesce(two, F.lit("NA"))))


def mineral_type(code: ColumnLike) -> Column:
    c = as_col(code)
    return classify([(c.startswith(p), t) for p, t in V.MINERAL_TYPES], V.OTHER_MINERAL)


def semi_heading(heading: ColumnLike) -> Column:
    return as_col(heading).isin(*V.SEMI_PREFIXES)


def mineral_heading(heading: ColumnLike) -> Column:
    h = as_col(heading)
    return F.substring(h, 1, 2).isin(*V.MINERAL_CHAPTERS) | h.isin(*V.MINERAL_HEADINGS)


def is_semi(code: ColumnLike) -> Column:
    return (classification(code) == "HS") & semi_heading(F.substring(as_col(code), 1, 4))


def is_mineral(code: ColumnLike) -> Column:
    return (classification(code) == "HS") & mineral_heading(F.substring(as_col(code), 1, 4))


def with_country_labels(df: DataFrame, raw: str = "country") -> DataFrame:
    """Canonical country, region and flags of a small frame of raw labels.

    The raw label column is replaced by the canonical one. Use it after summing to raw
    labels, so that the rules run per label and not per record.
    """
    return (
        with_canonical(df.withColumn("__raw", F.col(raw)), raw)
        .withColumns({
            "region": region_of(raw), "is_europe": is_europe(raw), "is_asean": is_asean(raw),
            "is_resid": is_residual("__raw"),
        }).drop("__raw"))


def label_dimension(df: DataFrame, raw: str) -> DataFrame:
    """Every raw label of a large frame with its canonical country and flags."""
    return with_country_labels(
        df.select(raw).distinct().withColumn("country", F.col(raw)), "country")


# -- tables ---------------------------------------------------------------------------


def trade_leaf(fact: DataFrame, cfg: TradeConfig = TradeConfig()) -> DataFrame:
    """Positive records with the code parts that decide every table.

    Amounts become whole numbers of their smallest unit where the config gives one: such
    sums are exact, so rounding does not depend on how the records were partitioned.
    """
    amount = F.col("value")
    if cfg.value_digits is not None:
        amount = units(amount, cfg.value_digits)
    return fact.where(F.col("value") > 0).select(
        "year", "direction", "country", classification("code").alias("classification"),
        code_key("code", cfg.hs_digits).alias("code_key"),
        F.when(classification("code") == "HS", F.substring("code", 1, 4)).alias("heading"),
        amount.alias("value"))


def _summed(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.sum("value").alias("value"))


def trade_base(fact: DataFrame, cfg: TradeConfig = TradeConfig()) -> DataFrame:
    """Leaf records summed to raw label x code key, from which all tables follow."""
    return _summed(trade_leaf(fact, cfg), "year", "direction", "country", "classification",
                   "code_key", "heading")


def _usd(df: DataFrame, cfg: TradeConfig) -> DataFrame:
    """Whole currency units, rounded after the sum."""
    keys = [c for c in df.columns if c != "value"]
    amount = F.col("value").cast("double") / F.lit(float(10 ** (cfg.value_digits or 0)))
    return df.select(*keys, round_even(amount).alias("value_usd"))


# Each table first sums its rows to raw labels, a few rows per year, then applies the label
# rules, and sums again to canonical labels. `rows` is a trade base or the leaf itself.


def partner_table(rows: DataFrame, cfg: TradeConfig = TradeConfig()) -> DataFrame:
    raw = with_country_labels(_summed(rows, "year", "direction", "country"))
    return _usd(_summed(raw, "year", "direction", "country", "region", "is_europe", "is_asean",
                        "is_resid"), cfg)


def commodity_table(rows: DataFrame, cfg: TradeConfig = TradeConfig()) -> DataFrame:
    kept = F.col("code_key").isNotNull()
    if not cfg.include_pre_hs:
        kept = F.col("classification") == "HS"
    summed = _summed(rows.where(kept), "year", "direction", "classification", "code_key")
    return _with_chapter(_usd(summed.withColumnRenamed("code_key", "code"), cfg))


def partner_group_table(rows: DataFrame, cfg: TradeConfig = TradeConfig()) -> DataFrame:
    hs = rows.where(F.col("classification") == "HS").withColumn(
        "chapter", F.substring("heading", 1, 2))
    raw = with_canonical(_summed(hs, "year", "direction", "country", "chapter")).withColumn(
        "group", chapter_group("chapter"))
    return _usd(_summed(raw, "year", "direction", "country", "group"), cfg)


def semiconductor_table(rows: DataFrame, cfg: TradeConfig = TradeConfig()) -> DataFrame:
    raw = _summed(rows.where(semi_heading("heading")), "year", "direction", "country")
    return _usd(_summed(with_canonical(raw), "year", "direction", "country"), cfg)


def mineral_table(rows: DataFrame, cfg: TradeConfig = TradeConfig()) -> DataFrame:
    raw = _summed(rows.where(mineral_heading("heading")), "year", "direction", "country", "heading")
    named = with_canonical(raw).withColumn("mineral_type", mineral_type("heading"))
    return _usd(_summed(named, "year", "direction", "country", "mineral_type"), cfg)


MARGINAL_TABLES = {
    "trade_by_partner": partner_table,
    "trade_by_commodity": commodity_table,
    "trade_by_partner_group": partner_group_table,
    "trade_semiconductors": semiconductor_table,
    "trade_minerals": mineral_table,
}


def _with_chapter(commodity: DataFrame) -> DataFrame:
    hs = F.col("classification") == "HS"
    return commodity.withColumn("chapter", F.when(hs, F.substring("code", 1, 2))).select(
        "year", "direction", "classification", "code", "chapter",
        F.when(hs, chapter_label("chapter")).alias("chapter_label"),
        F.when(hs, chapter_group("chapter")).alias("group"), "value_usd")


def build_region(partner: DataFrame) -> DataFrame:
    return rollup_from(partner, ["year", "direction", "region"])


def build_annual(partner: DataFrame) -> DataFrame:
    return annual_balance(rollup_from(partner, ["year", "direction"]))


# order in which each table is published; `-` is descending
TABLE_ORDER = {
    "trade_annual": ["year"],
    "trade_by_partner": ["year", "direction", "-value_usd"],
    "trade_by_region": ["year", "direction", "region"],
    "trade_by_commodity": ["year", "direction", "-value_usd"],
    "trade_by_partner_group": ["year", "direction", "country", "-value_usd"],
    "trade_semiconductors": ["year", "direction", "-value_usd"],
    "trade_minerals": ["year", "direction", "-value_usd"],
}


def build_trade(fact: DataFrame, cfg: TradeConfig = TradeConfig()) -> dict[str, DataFrame]:
    """All seven tables.

    The base and the partner table are written once and read by what follows, so the leaf
    records are scanned and shuffled one time. The base is partitioned by direction and year,
    so what asks for some years reads no others.
    """
    base = stage(trade_base(fact, cfg).hint("rebalance", "direction", "year"), "trade-base", ["direction", "year"])
    tables = {name: build(base, cfg) for name, build in MARGINAL_TABLES.items()}
    tables["trade_by_partner"] = stage(tables["trade_by_partner"], "trade-partner")
    tables["trade_by_region"] = build_region(tables["trade_by_partner"])
    tables["trade_annual"] = build_annual(tables["trade_by_partner"])
    return {name: tables[name] for name in TABLE_ORDER}


def trade_meta(tables: dict[str, DataFrame], cfg: TradeConfig = TradeConfig()) -> dict:
    """What the bundle's meta row says: settings, years covered, start of the HS era."""
    years = tables["trade_annual"].agg(F.array_sort(F.collect_set("year"))).first()[0]
    first = (tables["trade_by_commodity"].where(F.col("classification") == "HS")
             .agg(F.min("year")).first()[0])
    return {
        "source": "annual merchandise trade values, exports FOB and imports CIF, current USD",
        "years": years, "hs_digits": cfg.hs_digits, "include_pre_hs": cfg.include_pre_hs,
        "hs_era_from": first, "semi_codes": V.SEMI_PREFIXES,
        "mineral_codes": [*V.MINERAL_CHAPTERS, *V.MINERAL_HEADINGS],
        "europe": "EU-27, UK and EFTA, by label pattern",
        "notes": "partner, region and annual span all years; group, semiconductor and mineral "
                 "tables hold the harmonised era only; is_resid marks non-country labels",
    }
