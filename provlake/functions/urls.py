"""Product and category URLs: ids, canonical form, builders.  Hosts and paths are parameters."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from provlake.functions.text import blank_to_null, col, compact


@dataclass(frozen=True)
class UrlRules:
    """Two stores: ids are digits after a path.  The second store's path is looked for first."""

    goods_path: str = "/goods/"
    second_path: str = "/window-products/store/"
    second_host: str = "store.example"
    host: str = "www.shop.example"
    domain: str = "shop.example"
    categories_path: str = "/categories/"


RULES = UrlRules()


def _digits_after(url: Column, path: str) -> Column:
    return F.nullif(F.regexp_extract(url, rf"(?i)\Q{path}\E([0-9]+)", 1), F.lit(""))


def product_id(url: str | Column, rules: UrlRules = RULES) -> Column:
    """The digits after either path, anywhere in the URL; null for other URLs."""
    return F.coalesce(_digits_after(col(url), rules.second_path), _digits_after(col(url), rules.goods_path))


def canonical_url(url: str | Column, rules: UrlRules = RULES) -> Column:
    """One form for each product, without query and fragment; null if there is no id or the host is foreign."""
    u = F.trim(col(url))
    second, first = _digits_after(u, rules.second_path), _digits_after(u, rules.goods_path)
    scheme = F.coalesce(F.nullif(F.regexp_extract(u, "^([A-Za-z][A-Za-z0-9+.-]*)://", 1), F.lit("")), F.lit("https"))
    host = F.coalesce(F.nullif(F.regexp_extract(u, "^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1), F.lit("")), F.lit(rules.host))
    own = F.contains(F.lower(host), F.lit(rules.domain))
    return (
        F.when(second.isNotNull(), F.concat(F.lit(f"https://{rules.second_host}{rules.second_path}"), second))
        .when(first.isNotNull() & own, F.concat(F.lower(scheme), F.lit("://"), host, F.lit(rules.goods_path), first))
    )


def product_url(url: str | Column, rules: UrlRules = RULES) -> Column:
    """struct(requested_url, product_id, canonical_url), null without an id."""
    pid = product_id(url, rules)
    return F.when(pid.isNotNull(), F.struct(col(url).alias("requested_url"), pid.alias("product_id"), canonical_url(url, rules).alias("canonical_url")))


def percent_encode(x: str | Column) -> Column:
    """As a URL part: blanks become %20, the slash stays."""
    return F.replace(F.replace(F.replace(F.url_encode(col(x)), F.lit("+"), F.lit("%20")), F.lit("%2F"), F.lit("/")), F.lit("%7E"), F.lit("~"))


def search_url(keyword: str | Column, base: str = "https://www.shop.example/search?sword=") -> Column:
    return F.concat(F.lit(base), percent_encode(blank_to_null(keyword)))


def category_url(code: str | Column, base: str = "https://www.shop.example/categories/") -> Column:
    return F.when(compact(code).rlike("^[0-9]+$"), F.concat(F.lit(base), compact(code)))


def category_code(url: str | Column, rules: UrlRules = RULES) -> Column:
    return _digits_after(col(url), rules.categories_path)


def category_input_ok(code: str | Column, url: str | Column) -> Column:
    """Exactly one of both is given."""
    return blank_to_null(code).isNull() != blank_to_null(url).isNull()


def _without_dots(path: Column) -> Column:
    """A path without its . and .. parts."""
    step = lambda acc, p: F.when(p == ".", acc).when(p == "..",
        F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(F.concat(acc, F.array(p)))
    parts = F.split(path, "/")
    folder = F.when(F.element_at(parts, -1).isin(".", ".."), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
    inner = F.slice(F.concat(parts, folder), 2, F.size(parts) + F.size(folder))
    return F.concat(F.lit("/"), F.array_join(F.aggregate(inner, F.array().cast("array<string>"), step), "/"))


def absolute(url: str | Column, base: str | Column) -> Column:
    """url as seen from the page `base`; addresses with a scheme stay as they are."""
    u, b = F.trim(col(url)), col(base)
    scheme, origin = F.regexp_extract(b, "^([A-Za-z][A-Za-z0-9+.-]*:)", 1), F.regexp_extract(b, "^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    path = F.regexp_extract(b, "^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    folder = F.concat(F.regexp_replace(path, "[^/]*$", ""), F.when(path == "", "/").otherwise(""))
    own, rest = F.regexp_extract(u, "^[^?#]*", 0), F.regexp_extract(u, "[?#].*$", 0)
    return (
        F.when(u.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), u)
        .when(u.startswith("//"), F.concat(scheme, u))
        .when(u.startswith("/"), F.concat(origin, _without_dots(own), rest))
        .when(own == "", F.concat(origin, path, rest))
        .otherwise(F.concat(origin, _without_dots(F.concat(folder, own)), rest))
    )


def image_url(url: str | Column, base: str | Column | None = None) -> Column:
    """Absolute URLs without their fragment, relative ones resolved against base; null for others and for data: URLs."""
    u = F.regexp_replace(F.trim(col(url)) if base is None else F.when(F.trim(col(url)) != "", absolute(url, base)), "#.*$", "")
    return F.when(u.rlike("^[A-Za-z][A-Za-z0-9+.-]*://[^/]+") & ~F.lower(u).startswith("data:"), u)


def preview_text(text: str | Column) -> Column:
    """A link's text for a preview: stripped, and null if nothing is left."""
    return blank_to_null(text)
