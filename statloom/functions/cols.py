"""Column references that survive blanks, dots and symbols in headers."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def named(name: str) -> Column:
    """The column called exactly `name`, whatever characters it holds."""
    return F.col(quoted(name))


def as_col(c: ColumnLike) -> Column:
    return named(c) if isinstance(c, str) else c


def quoted(name: str) -> str:
    """A column name inside an SQL expression."""
    return "`" + name.replace("`", "``") + "`"


def literal(value: str | int | date | None, kind: str = "string") -> str:
    """A value inside an SQL expression, of the given type.

    Wide tables have hundreds of columns; one SQL text for all of them is planned much
    faster than as many nested column objects.
    """
    if value is None:
        return f"CAST(NULL AS {kind})"
    if isinstance(value, date):
        return f"DATE'{value.isoformat()}'"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"CAST({value} AS {kind})"
