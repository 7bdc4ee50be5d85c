"""Line dedup by site-relative frequency, in DataFrame operations only.

A line's frequency on a host is the number of the host's pages that hold it over the number of the host's pages.  Lines
above RATIO are boilerplate and are dropped from all pages of the host.  At most lines-per-page / RATIO lines of a host can be
boilerplate, whatever its size.  Two parameters depart from the plain ratio: min_pages (1: no further condition) spares lines
of fewer pages, for hosts with few pages; copies_count=False takes exact copies of a page as one page.

Counts: a page's distinct lines are reduced to 128-bit hashes before the shuffle and counted by partial aggregation, so a
host with a third of all pages is no burden.  Each host's boilerplate is one array.  It is broadcast if there are at most
BROADCAST_LINES of them in all; otherwise it is joined by shuffles that skewed hosts split.

Lines are compared without blanks at either end; lines that are empty then are kept.  Null text stays null, has no lines and
counts as a page.  Null host: a host of its own.  Every row is a page, repeated rows and exact copies too, unless
copies_count is False.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provlake.llm.common import free_name, written

RATIO = 0.1
MIN_PAGES = 1
BROADCAST_LINES = 20_000


def _mark(line: Column) -> Column:
    return F.unhex(F.md5(F.trim(line)))


def boilerplate_lines(pages: DataFrame, host: str = "source", ratio: float = RATIO, min_pages: int = MIN_PAGES, copies_count: bool = True) -> DataFrame:
    """(host, bad): the hashes of each host's boilerplate lines; hosts without any are left out."""
    src = pages.select(F.coalesce(F.col(host).cast("string"), F.lit("\u0000")).alias("_host"), F.col("text").cast("string").alias("_text"), F.xxhash64("text").alias("_page"))
    of_page = (lambda t: t) if copies_count else DataFrame.distinct  # copies fall together as hashes
    totals = of_page(src.select("_host", "_page")).groupBy("_host").agg(F.count("*").alias("pages"))
    lines = F.filter(F.split(F.coalesce("_text", F.lit("")), "\n", -1), lambda x: F.trim(x) != "")
    marks = src.select("_host", "_page", F.explode(F.array_distinct(F.transform(lines, _mark))).alias("mark"))
    counts = of_page(marks).groupBy("_host", "mark").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages)
    bad = written(counts.join(written(totals), "_host").where(F.col("n") > ratio * F.col("pages")))
    return bad.groupBy("_host").agg(F.collect_list("mark").alias("_bad"))


def count_names(pages: DataFrame) -> tuple[str, str]:
    """The columns in which drop_boilerplate counts a page's lines and those dropped: _n_lines and _n_dropped, with more underscores if pages has them."""
    return free_name("_n_lines", pages.columns), free_name("_n_dropped", pages.columns)


def drop_boilerplate(pages: DataFrame, host: str = "source", ratio: float = RATIO, min_pages: int = MIN_PAGES, copies_count: bool = True) -> DataFrame:
    """pages with their text cleaned, plus the two counts of `count_names`.  All other columns stay as they were."""
    own = {n: free_name(n, pages.columns) for n in ("_host", "_bad", "_lines", "_kept")}
    bad = written(boilerplate_lines(pages, host, ratio, min_pages, copies_count))
    few = bad.agg(F.coalesce(F.sum(F.size("_bad")), F.lit(0))).first()[0] <= BROADCAST_LINES
    bad = bad.select(F.col("_host").alias(own["_host"]), F.col("_bad").alias(own["_bad"]))
    bad = F.broadcast(bad) if few else bad
    key = F.coalesce(F.col(host).cast("string"), F.lit("\u0000"))
    out = pages.withColumn(own["_lines"], F.split("text", "\n", -1)).join(bad, key == F.col(own["_host"]), "left")
    drop = lambda x: (F.trim(x) != "") & F.array_contains(own["_bad"], _mark(x))
    kept = F.when(F.col(own["_bad"]).isNull(), F.col(own["_lines"])).otherwise(F.filter(own["_lines"], lambda x: ~drop(x)))
    out = out.withColumn(own["_kept"], kept)
    text = F.when(F.size(own["_kept"]) == F.size(own["_lines"]), F.col("text")).otherwise(F.array_join(own["_kept"], "\n"))
    n = lambda c: F.greatest(F.size(own[c]), F.lit(0)).cast("long")
    n_lines, n_dropped = count_names(pages)
    columns = [text.alias(c) if c == "text" else F.col(c) for c in pages.columns]
    return out.select(*columns, n("_lines").alias(n_lines), (n("_lines") - n("_kept")).alias(n_dropped))
