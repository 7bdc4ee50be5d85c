"""Two sources for one field: comparison, merge, rollup of states."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from provlake.functions.text import blank_to_null, col

# Phrases that don't count in a comparison (removed in this order), and key words.
CLOSING = ("하세요", "하십시오", "보관하세요", "보관하십시오", "바랍니다")
FILLERS = ("에서", "즉시", "바로", "반드시", "해주세요", "해 주세요")
PUNCTUATION = r"(?U)[\s|:：\-_/.,·•()\[\]{}~～]"
KEY_TOKENS = "(?U)(\\d+|냉장|냉동|상온|실온|보관)"


def comparable(x: str | Column) -> Column:
    out = F.lower(F.coalesce(col(x), F.lit("")))
    for a in ("℃", "°c"):
        out = F.replace(out, F.lit(a), F.lit("도"))
    for phrase in CLOSING + FILLERS:
        out = F.replace(out, F.lit(phrase), F.lit(""))
    return F.regexp_replace(out, PUNCTUATION, "")


def same_meaning(a: str | Column, b: str | Column) -> Column:
    """Equal, one inside the other, or the same set of key tokens; never if either is empty."""
    x, y = comparable(a), comparable(b)
    keys = [F.array_sort(F.array_distinct(F.regexp_extract_all(v, F.lit(KEY_TOKENS), F.lit(1)))) for v in (x, y)]
    return (x != "") & (y != "") & (F.contains(x, y) | F.contains(y, x) | ((F.size(keys[0]) > 0) & (keys[0] == keys[1])))


def merge_field(first: str | Column, second: str | Column, names: tuple[str, str, str] = ("DOM", "OCR", "DOM_AND_OCR"), equal: Column | None = None) -> Column:
    """struct(value, source, status).  In conflict the first source's value stays, for review."""
    a, b = blank_to_null(first), blank_to_null(second)
    same = same_meaning(a, b) if equal is None else equal
    made = lambda v, s, t: F.struct(v.alias("value"), F.lit(s).alias("source"), F.lit(t).alias("status"))
    return (
        F.when(a.isNull() & b.isNull(), made(F.lit(None).cast("string"), "NOT_FOUND", "FIELD_NOT_FOUND"))
        .when(b.isNull(), made(a, names[0], "MATCHED"))
        .when(a.isNull(), made(b, names[1], "MATCHED"))
        .when(same, made(a, names[2], "MATCHED"))
        .otherwise(made(a, names[0], "REVIEW_REQUIRED"))
    )


def rollup_status(*states: str | Column) -> Column:
    """Any review: review; nothing found at all: not found; else matched."""
    s = F.array(*map(col, states))
    return F.when(F.exists(s, lambda v: v == "REVIEW_REQUIRED"), "REVIEW_REQUIRED").when(F.forall(s, lambda v: v == "FIELD_NOT_FOUND"),
        "FIELD_NOT_FOUND").otherwise("MATCHED")


def parse_status(*values: str | Column) -> Column:
    return F.when(F.coalesce(*[F.nullif(col(v), F.lit("")) for v in values]).isNotNull(), "COMPLETED").otherwise("FIELD_PARSE_FAILED")


def classify_error(error_type: str | Column, message: str | Column) -> Column:
    """File missing before empty text before bad value before anything else."""
    t, m = F.coalesce(col(error_type), F.lit("")), F.coalesce(col(message), F.lit(""))
    return F.when(t == "FileNotFoundError", "IMAGE_NOT_FOUND").when(F.contains(m, F.lit("OCR_TEXT_EMPTY")), "OCR_TEXT_EMPTY").when(t == "ValueError",
        "INVALID_INPUT").otherwise("OCR_FAILED")
