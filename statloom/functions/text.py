"""Text clean-up: squishing, case, regex edits, slugs and tolerant number parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .cols import ColumnLike, as_col


def squish(c: ColumnLike) -> Column:
    """Trim, and collapse every run of whitespace (also non-breaking) to one blank."""
    return F.trim(F.regexp_replace(as_col(c), r"(?U)\s+", " "))


def upper(c: ColumnLike) -> Column:
    return F.upper(as_col(c))


def lower(c: ColumnLike) -> Column:
    return F.lower(as_col(c))


def title(c: ColumnLike) -> Column:
    return F.initcap(as_col(c))


def replace_all(c: ColumnLike, pattern: str, replacement: str) -> Column:
    return F.regexp_replace(as_col(c), pattern, replacement)


def replace_first(c: ColumnLike, pattern: str, replacement: str) -> Column:
    """Spark's regexp_replace edits every match; the lazy prefix pins it to the first."""
    return F.regexp_replace(as_col(c), rf"(?s)\A(.*?)(?:{pattern})", "$1" + replacement)


def remove_all(c: ColumnLike, pattern: str) -> Column:
    return replace_all(c, pattern, "")


def remove_first(c: ColumnLike, pattern: str) -> Column:
    return replace_first(c, pattern, "")


def extract(c: ColumnLike, pattern: str, group: int = 0) -> Column:
    """First match, or NULL (Spark alone would give an empty string).

    A pattern that can match nothing keeps its empty match.
    """
    col = as_col(c)
    return F.when(F.regexp_like(col, F.lit(pattern)), F.regexp_extract(col, pattern, group))


def detect(c: ColumnLike, pattern: str) -> Column:
    return as_col(c).rlike(pattern)


def sub(c: ColumnLike, first: int, last: int) -> Column:
    """Characters `first` to `last`, both counted from 1 and both included."""
    return F.substring(as_col(c), first, last - first + 1)


def nchar(c: ColumnLike) -> Column:
    return F.length(as_col(c))


def pad(c: ColumnLike, width: int, fill: str = "0") -> Column:
    """Left-pad to `width` without cutting longer texts."""
    text = as_col(c).cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, fill))


def split_at(c: ColumnLike, pattern: str, index: int) -> Column:
    """The `index`-th piece (from 1) of a regex split, NULL when there are fewer."""
    return F.get(F.split(as_col(c), pattern), F.lit(index - 1))


def join_text(sep: str, *cols: ColumnLike) -> Column:
    """Concatenate with a separator; NULL if any part is NULL (unlike concat_ws)."""
    parts = [as_col(c).cast("string") for c in cols]
    missing = parts[0].isNull()
    for p in parts[1:]:
        missing = missing | p.isNull()
    return F.when(~missing, F.concat_ws(sep, *parts))


def slug(c: ColumnLike) -> Column:
    """Table title to file slug: the part before a price word or `by`, hyphenated."""
    head = split_at(c, r"(?i)(?:farmgate|wholesale|retail)", 1)
    head = split_at(head, r"(?i)\bby\b", 1)
    return F.regexp_replace(squish(F.regexp_replace(head, r"[():,/]", " ")), r"\s+", "-")


def safe_name(c: ColumnLike) -> Column:
    """Lower-case name of letters, digits and single underscores."""
    return F.lower(F.regexp_replace(F.regexp_replace(as_col(c), r"[^A-Za-z0-9]+", "_"), r"^_|_$", ""))


IDENT_NOISE = r"\s|-|/|\(|\)"


def ident(c: ColumnLike) -> Column:
    """Label to identifier: blanks, hyphens, slashes and brackets removed."""
    return remove_all(c, IDENT_NOISE)


def parse_number(c: ColumnLike) -> Column:
    """First number in the text, thousands commas ignored; NULL when there is none."""
    digits = F.regexp_extract(F.regexp_replace(as_col(c), ",", ""), r"-?(?:\d+\.?\d*|\.\d+)", 0)
    return digits.try_cast("double")


def as_double(c: ColumnLike) -> Column:
    return F.trim(as_col(c)).try_cast("double")


def as_int(c: ColumnLike) -> Column:
    return F.trim(as_col(c)).try_cast("int")


def strip_code_prefix(c: ColumnLike) -> Column:
    """Drop a leading `code - ` up to the last hyphen-and-blank."""
    return remove_first(c, r"^.+\-\s")


def normalise_label(c: ColumnLike, word: str) -> Column:
    """Drop the first occurrence of a word that only some vintages carry."""
    return remove_first(c, word)
