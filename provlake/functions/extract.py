"""Labelled fields from page text, as column expressions.

Labelled text: lines in order, in each line labels from the longest to the shortest.  A label stands at the start of
a line or after one bullet.  The rest of the line is the value unless it is empty, a residue of the label
or a placeholder; then the next line is, under the same rules; otherwise the search goes on.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from provlake.functions.text import blank_to_null, col, collapse_ws, compact, label_lines, lstrip_chars, page_lines, strip_chars, ustrip

# Labels, placeholders and word lists of the product pages.
EXPIRATION_LABELS = ("소비기한(또는 유통기한)정보", "소비기한 정보", "소비기한", "유통기한", "품질유지기한")
STORAGE_LABELS = ("보관방법 또는 취급방법", "보관방법", "보관 방법", "보관안내", "보관법")
SALES_UNIT_LABELS = ("판매단위", "판매 단위")
WEIGHT_LABELS = ("중량/용량", "중량", "용량")
QUANTITY_LABELS = ("팩 수량", "개수")
QUANTITY_WORDS = ("구매", "선택")
PLACEHOLDERS = ("상품설명 및 상품이미지 참조", "상품 설명 및 상품이미지 참조")
RESIDUES = ("정보", "또는유통기한", "또는취급방법", "또는품질유지기한", "(또는유통기한)정보")
RESIDUE_START = "또는"
BULLETS = ("", "・", "-", "·")
FOOD_TYPE_ALIASES = ("식품의 유형", "식품유형", "제품의 유형")
EXPIRATION_ALIASES = ("소비기한", "유통기한", "품질유지기한")
STORAGE_ALIASES = ("보관방법", "보관 및 취급방법", "보관 및 취급 시 주의사항", "보존 및 유통온도")
GATE_KEYWORDS = ("소비기한", "유통기한", "보관방법", "보관", "식품유형", "식품의 유형")
CHILLED, FROZEN, ROOM = ("냉장", "refrigerat"), ("냉동", "frozen"), ("상온", "실온", "room temperature")
ORIGIN_WORDS = ("호주산", "미국산", "국내산", "한우", "목초육", "곡물육")
WEIGHT = r"[0-9]+(?:[.,][0-9]+)?(?U:\s*)(?:kg|g|ml|l)"


def _label_pattern(label: str) -> str:
    return "(?iU)" + r"\s*".join(re.escape(p) for p in label.split(" "))


def is_residue(x: Column) -> Column:
    c = compact(x)
    return c.isin(*RESIDUES) | (c.startswith(RESIDUE_START) & (F.length(c) <= 20))


def is_placeholder(x: Column) -> Column:
    return ustrip(x).isin(*PLACEHOLDERS)


def _bound(x: Column, f: Callable[[Column], Column]) -> Column:
    """f(x) with x computed once, however often f uses it."""
    return F.get(F.transform(F.array(x), f), F.lit(0))


def _first_value(lines: Column, labels: Sequence[str], value: Callable[[Column, Column], Column]) -> Column:
    """The first non-null value(line, next line); only lines that hold a label (blanks aside) are looked at."""
    any_label = "|".join(f"\\Q{''.join(x.split())}\\E" for x in labels)
    pairs = _bound(lines, lambda ls: F.transform(ls, lambda v, i: F.struct(v.alias("line"), F.try_element_at(ls, i + 2).alias("after"))))
    found = F.transform(F.filter(pairs, lambda p: compact(p["line"]).rlike(any_label)), lambda p: value(p["line"], p["after"]))
    return F.try_element_at(F.filter(found, lambda v: v.isNotNull()), F.lit(1))


def labelled_text(text: str | Column, labels: Sequence[str]) -> Column:
    good = lambda v: v.isNotNull() & (v != "") & ~is_residue(v) & ~is_placeholder(v)

    def one(label: str, line: Column, tight: Column, after: Column) -> Column:
        at = F.instr(tight, F.lit("".join(label.split())))
        starts = (at > 0) & F.substring(tight, F.lit(1), at - 1).isin(*BULLETS)
        rest = ustrip(lstrip_chars(ustrip(F.regexp_replace(line, f"^(.*?){_label_pattern(label)}", "$1")), " |:：・·"))
        return F.when(starts, _bound(rest, lambda r: F.when(good(r), r).when(good(after), after)))

    def value(line: Column, after: Column) -> Column:
        return _bound(compact(line), lambda tight: F.coalesce(*[one(x, line, tight, after) for x in sorted(labels, key=len, reverse=True)]))

    return _first_value(page_lines(text), labels, value)


def disclosure_value(text: str | Column, aliases: Sequence[str]) -> Column:
    """The first line, then the first alias, that holds an alias: the rest of the line, or else the next line."""

    def one(alias: str, line: Column, tight: Column, after: Column) -> Column:
        rest = strip_chars(F.regexp_replace(line, f"^(.*?){_label_pattern(alias)}", "$1"), " |:：")
        return F.when(F.contains(tight, F.lit("".join(alias.split()))), F.coalesce(F.nullif(rest, F.lit("")), after))

    def value(line: Column, after: Column) -> Column:
        return _bound(compact(line), lambda tight: F.coalesce(*[one(x, line, tight, after) for x in aliases]))

    return _first_value(label_lines(text), aliases, value)


def disclosure_fields(text: str | Column) -> Column:
    """struct(food_type_raw, expiration_info_raw, storage_method_raw, has_any_value)."""
    f = [disclosure_value(text, a) for a in (FOOD_TYPE_ALIASES, EXPIRATION_ALIASES, STORAGE_ALIASES)]
    return F.struct(f[0].alias("food_type_raw"), f[1].alias("expiration_info_raw"), f[2].alias("storage_method_raw"),
        F.coalesce(*f).isNotNull().alias("has_any_value"))


def has_keywords(text: str | Column, keywords: Sequence[str] = GATE_KEYWORDS) -> Column:
    """Any keyword once plain spaces (and nothing else) are gone."""
    t = F.replace(F.coalesce(col(text), F.lit("")), F.lit(" "), F.lit(""))
    out = F.lit(False)
    for k in keywords:
        out = out | F.contains(t, F.lit(k.replace(" ", "")))
    return out


def _any_of(text: Column, words: Sequence[str]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | F.contains(text, F.lit(w.lower()))
    return out


def storage_type(*texts: str | Column, frozen_first: bool = False) -> Column:
    """Crawled text: chilled before frozen before room.  frozen_first: the order of the image text."""
    t = F.lower(F.concat_ws(" ", *map(col, texts)))
    rules = [("REFRIGERATED", CHILLED), ("FROZEN", FROZEN), ("ROOM_TEMPERATURE", ROOM)]
    if frozen_first:
        rules[:2] = rules[1::-1]
    out = F.when(_any_of(t, rules[0][1]), rules[0][0])
    for name, words in rules[1:]:
        out = out.when(_any_of(t, words), name)
    return out.otherwise("UNKNOWN")


def food_name(name: str | Column) -> Column:
    """A product name without brand, storage, weights and origin."""
    x = F.regexp_replace(ustrip(name), r"(?U)^\[[^\]]+\]\s*", "")
    x = F.regexp_replace(x, r"(?U)\s*\((?:냉장|냉동|상온|실온)\)\s*$", "")
    x = F.regexp_replace(x, rf"(?iU)\s*{WEIGHT}(?![\w])", "")
    for w in ORIGIN_WORDS:
        x = F.replace(x, F.lit(w), F.lit(" "))
    return F.nullif(strip_chars(collapse_ws(x), " -/"), F.lit(""))


def _found(text: Column, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def weight_in(text: str | Column) -> Column:
    return F.replace(_found(col(text), f"(?i)({WEIGHT})"), F.lit(" "), F.lit(""))


def weight(page_text: str | Column, name: str | Column) -> Column:
    line = _found(col(page_text), r"(?U)중량\s*[:：]\s*([^\n]+)")
    return F.coalesce(labelled_text(page_text, WEIGHT_LABELS), weight_in(line), weight_in(name))


def quantity(page_text: str | Column) -> Column:
    pieces = F.replace(_found(col(page_text), r"(?U)([0-9]+\s*개입)"), F.lit(" "), F.lit(""))
    value = labelled_text(page_text, QUANTITY_LABELS)
    return F.coalesce(pieces, F.when(~value.isin(*QUANTITY_WORDS), value))


def sales_unit(page_text: str | Column) -> Column:
    return labelled_text(page_text, SALES_UNIT_LABELS)


def expiration_info(page_text: str | Column) -> Column:
    return labelled_text(page_text, EXPIRATION_LABELS)


def storage_method(page_text: str | Column) -> Column:
    line = blank_to_null(_found(col(page_text), r"(?U)보관법\s*[:：]\s*([^\n]+)"))
    return F.coalesce(F.when(~is_placeholder(line), line), labelled_text(page_text, STORAGE_LABELS))


def first_filled(*values: str | Column) -> Column:
    """Field fallback: the first value that is neither null nor empty."""
    return F.coalesce(*[F.nullif(col(v), F.lit("")) for v in values])


def page_fields(page_text: str | Column, name: str | Column) -> list[Column]:
    """All fields of a page, named as in the crawl manifest."""
    method, info = storage_method(page_text), expiration_info(page_text)
    return [
        info.alias("expiration_info_dom"),
        method.alias("storage_method_dom"),
        storage_type(name, method).alias("storage_type_dom"),
        food_name(name).alias("food_name_candidate"),
        weight(page_text, name).alias("weight_raw"),
        quantity(page_text).alias("quantity_raw"),
        sales_unit(page_text).alias("sales_unit_raw"),
    ]
