"""Text columns: Unicode-aware stripping, lines, optional casts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def replace_all(x: str | Column, pattern: str, by: str = "") -> Column:
    return F.regexp_replace(col(x), pattern, by)


def ustrip(x: str | Column) -> Column:
    """Without Unicode white space at either end (Spark's trim knows the space only)."""
    return replace_all(x, r"(?U)^\s++|\s+$")


def collapse_ws(x: str | Column) -> Column:
    return ustrip(replace_all(x, r"(?U)\s+", " "))


def compact(x: str | Column) -> Column:
    return replace_all(x, r"(?U)\s+")


def strip_chars(x: str | Column, chars: str) -> Column:
    """Without any of these characters at either end."""
    return F.btrim(col(x), F.lit(chars))


def lstrip_chars(x: str | Column, chars: str) -> Column:
    return F.regexp_replace(col(x), "^[" + "".join("\\" + c for c in chars) + "]++", "")


def empty_to_null(x: str | Column) -> Column:
    """Exactly the empty text becomes null."""
    return F.nullif(col(x), F.lit(""))


def blank_to_null(x: str | Column) -> Column:
    """Stripped; what is empty then becomes null."""
    return F.nullif(ustrip(x), F.lit(""))


def optional_double(x: str | Column) -> Column:
    return blank_to_null(x).try_cast("double")


def optional_int(x: str | Column) -> Column:
    """Whole part of a number in text; null where there is none."""
    return blank_to_null(x).try_cast("double").try_cast("int")


def _lines(x: Column, breaks: str, clean) -> Column:
    return F.filter(F.transform(F.split(F.coalesce(x, F.lit("")), breaks), clean), lambda v: v != "")


def page_lines(x: str | Column) -> Column:
    """Collapsed, non-empty lines; every line break that Unicode knows counts."""
    return _lines(col(x), "\r\n|[\n\r\u000b\u000c\u001c\u001d\u001e\u0085\u2028\u2029]", collapse_ws)


def label_lines(x: str | Column, edge: str = " |:：") -> Column:
    """Collapsed, non-empty lines without the edge characters; only CR and LF break lines."""
    return _lines(col(x), "[\r\n]", lambda v: strip_chars(replace_all(v, r"(?U)\s+", " "), edge))


def tokens(x: str | Column, by: str = "-") -> Column:
    return F.filter(F.split(F.coalesce(col(x), F.lit("")), by), lambda v: v != "")


def id_list(x: str | Column) -> Column:
    """Comma- or blank-separated ids, first of equals kept, in order."""
    return F.array_distinct(F.filter(F.split(F.coalesce(col(x), F.lit("")), r"[,\s]+"), lambda v: v != ""))


def free_name(name: str, columns: Sequence[str]) -> str:
    """name, with underscores before it until no column has it."""
    while name.lower() in {c.lower() for c in columns}:
        name = f"_{name}"
    return name
