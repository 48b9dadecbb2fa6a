"""Labor force and poverty tables."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import parse_date, yq
from ..functions.text import as_double
from ..operators.frames import project, rename_by
from ..operators.reshape import unpivot_except


def build_labor(raw: DataFrame) -> DataFrame:
    """Survey rounds without the annual ones, with a period date after the round columns.

    Rounds are `1995 Q1` or `1995 Jan`. Blanks and plus signs leave the column names.
    """
    rounds = raw.where(F.col("Round") != "Annual")
    period = F.when(F.col("LFS Round").contains("Q"), yq("LFS Round")).otherwise(
        parse_date("LFS Round", "%Y %b"))
    clean = rename_by(rounds.withColumn("Period", period), fn=lambda n: re.sub(r"\s|\+", "", n))
    names = clean.columns
    lead = names[names.index("LFSRound") : names.index("Round") + 1]
    return project(clean, first=[*lead, "Period"])


def build_poverty(raw: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Years from columns to rows after the id columns."""
    long = unpivot_except(
        raw, ids, "Header", "Value", as_double, {"Year": lambda h: parse_date(h, "%Y")})
    return long.select(*ids, "Year", "Value")
