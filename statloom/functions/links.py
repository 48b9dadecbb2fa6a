"""Links of HTML pages as a parser sees them, in built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .cols import ColumnLike, as_col

# text that looks like tags and is none: comments, scripts and styles
NOT_TAGS = r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>"
A_TAG = r"""(?is)<a(?=[\s/])((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
# one attribute: its name, and its value in any of the three quote forms
ATTRIBUTE = r"""(?s)([^\s=>"'/]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>][^\s>]*))?"""
REFERENCE = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|amp|lt|gt|quot|apos|nbsp);"
# fixed values: named characters of HTML that addresses use
NAMED = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " "}


def character(code: Column) -> Column:
    """The character of a code point; the replacement character where there is none."""
    valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    number = F.when(valid, code).otherwise(F.lit(0xFFFD))
    return F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")


def unescaped(c: ColumnLike) -> Column:
    """Text with character references (numbers, and the names in `NAMED`) replaced once."""

    def one(part: Column) -> Column:
        ref = F.regexp_extract(part, f"^({REFERENCE})", 1)
        inner = F.substring(ref, F.lit(2), F.length(ref) - 2)
        hexa = inner.rlike("^#[xX]")
        code = F.when(hexa, F.conv(F.substring(inner, 3, 9), 16, 10)).otherwise(F.substring(inner, 2, 9)).cast("bigint")
        made = F.when(inner.startswith("#"), character(code))
        for name, char in NAMED.items():
            made = made.when(inner == name, F.lit(char))
        return F.when(ref == "", part).otherwise(F.concat(made, F.substring(part, F.length(ref) + 1, F.length(part))))

    col = as_col(c)
    return F.when(col.contains("&"), F.array_join(F.transform(F.split(col, f"(?={REFERENCE})"), one), "")).otherwise(col)


def hrefs(html: ColumnLike) -> Column:
    """Targets of the `a` tags of a page, in document order; null for a missing page."""

    def target(tag: Column) -> Column:
        names = F.transform(F.regexp_extract_all(tag, F.lit(ATTRIBUTE), F.lit(1)), F.lower)
        values = F.regexp_extract_all(tag, F.lit(ATTRIBUTE), F.lit(2))
        first = F.get(values, F.array_position(names, "href").cast("int") - 1)
        bare = F.when(first.rlike("^[\"']"), F.substring(first, F.lit(2), F.length(first) - 2)).otherwise(first)
        return F.trim(unescaped(bare))

    tags = F.regexp_extract_all(F.regexp_replace(as_col(html), NOT_TAGS, ""), F.lit(A_TAG), F.lit(1))
    return F.array_compact(F.transform(tags, target))


def without_dots(path: Column) -> Column:
    """A path without its `.` and `..` segments."""
    parts = F.split(path, "/", -1)

    def add(kept: Column, part: Column) -> Column:
        up = F.when(F.size(kept) > 1, F.slice(kept, F.lit(1), F.size(kept) - 1)).otherwise(kept)
        return F.when(part == "..", up).when(part == ".", kept).otherwise(F.array_append(kept, part))

    kept = F.aggregate(parts, F.array().cast("array<string>"), add)
    last = F.element_at(parts, -1)
    ended = F.when(last.isin(".", ".."), F.array_append(kept, F.lit(""))).otherwise(kept)
    return F.when(path.contains("/."), F.array_join(ended, "/")).otherwise(path)


def resolved(base: ColumnLike, href: ColumnLike) -> Column:
    """The address that `href` names on a page at the address `base`."""
    b, h = as_col(base), as_col(href)
    origin = F.regexp_extract(b, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    scheme = F.regexp_extract(b, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1)
    path = F.regexp_extract(b, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    query = F.regexp_extract(b, r"^[^?#]*(\?[^#]*)?", 1)
    own, rest = F.regexp_extract(h, r"^([^?#]*)", 1), F.regexp_extract(h, r"^[^?#]*(.*)$", 1)
    folder = F.coalesce(F.nullif(F.regexp_extract(path, r"^(.*/)", 1), F.lit("")), F.lit("/"))
    return (
        F.when(h.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), h)
        .when(h.startswith("//"), F.concat(scheme, h))
        .when(h.startswith("/"), F.concat(origin, without_dots(own), rest))
        .when(h.startswith("?"), F.concat(origin, path, rest))
        .when((h == "") | h.startswith("#"), F.concat(origin, path, query, rest))
        .otherwise(F.concat(origin, without_dots(F.concat(folder, own)), rest)))
