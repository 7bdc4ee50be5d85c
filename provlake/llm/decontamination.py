"""Benchmark decontamination by a prefix-filtered set join, in DataFrame operations only.

A benchmark item is a set of windows of 10 successive words, a window a set of word shingles (5 words; shorter
windows: the window itself).  A document holds a window only if it holds all its shingles, so one of
them, the rarest in the corpus, is a sufficient prefix.

1. One pass over the documents finds every occurrence of an item's shingle.  An occurrence keeps
   the words around it, so the texts are not read again.  The table of item shingles is broadcast if it has at
   most BROADCAST_ROWS rows; a larger one is joined by a shuffle.
2. The occurrences give each shingle's frequency; a window's rarest shingle is its prefix.
3. Occurrences of prefixes are the candidates.  Bounds: the window must begin and end inside the text.
   Its words must equal the words there.
4. Hit words are counted once, however many windows cover them.

Null text or item: no words.  Items without words never occur.  Repeated document rows: each row gets its own
result.  Repeated items with different ids: each counts.  No benchmark rows: nothing is hit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provlake.llm.common import KEY, join_key, keyed, written

WINDOW = 10
SHINGLE = 5
BROADCAST_ROWS = 200_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def item_words(text: Column) -> Column:
    """Lower-cased runs of ASCII letters, digits and all characters beyond ASCII."""
    low = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.filter(F.split(low, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda w: w != "")


def item_windows(items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """(item_id, words, w, off, h): each distinct window of each item with its shingles."""
    words = items.select(F.col("item_id").cast("string").alias("item_id"), item_words(F.col("text").cast("string")).alias("all")).where(F.size("all") > 0)
    at = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("all") - window))
    wins = words.select("item_id", "all", F.explode(at).alias("i")).select("item_id", F.slice("all", F.col("i") + 1, F.lit(window)).alias("words")).distinct()
    wins = wins.withColumn("s", F.least(F.lit(shingle), F.size("words")))
    rows = wins.select("item_id", "words", "s", F.explode(F.sequence(F.lit(0), F.size("words") - F.col("s"))).alias("off"))
    return rows.withColumn("h", F.xxhash64("s", F.slice("words", F.col("off") + 1, F.col("s"))))


def hit_documents(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, _th, n_hit, items): the documents that hold a window."""
    wins = written(item_windows(items, window, shingle))
    sizes = sorted(r.s for r in wins.select("s").distinct().collect())  # at most `shingle` numbers
    known = wins.select("s", "h").distinct()
    if wins.count() <= BROADCAST_ROWS:
        known = F.broadcast(known)
    src = keyed(docs).withColumn("words", item_words(F.col("text")))
    rows = src.select(*KEY, "words", F.posexplode("words").alias("i", "_w"))
    side = window - 1
    found = None
    for s in sizes:
        here = rows.where(F.col("i") + s <= F.size("words")).select(*KEY, "words", "i", F.lit(s).alias("s"), F.xxhash64(F.lit(s), F.slice("words", F.col("i") + 1, F.lit(s))).alias("h"))
        here = here.join(known.where(F.col("s") == s).select("h") if len(sizes) > 1 else known.select("h"), "h", "left_semi")
        start = F.greatest(F.lit(0), F.col("i") - side)
        here = here.select(*KEY, "s", "h", "i", start.alias("from"), F.slice("words", start + 1, F.lit(2 * window + shingle)).alias("near"))
        found = here if found is None else found.unionAll(here)
    if found is None:
        found = rows.where("false").select(*KEY, F.lit(0).alias("s"), F.lit(0).cast("long").alias("h"), "i", F.col("i").alias("from"), F.col("words").alias("near"))
    found = written(found)
    often = found.groupBy("s", "h").agg(F.count("*").alias("n"))
    ranked = wins.join(often, ["s", "h"])  # a window with a shingle that never occurs can't occur
    complete = ranked.groupBy("item_id", "words", "s").agg(F.count("*").alias("seen"), F.min(F.struct("n", "off", "h")).alias("p")).where(F.col("seen") == F.size("words") - F.col("s") + 1)
    prefix = written(complete.select("item_id", F.col("words").alias("win"), "s", F.col("p.off").alias("off"), F.col("p.h").alias("h")))
    start = F.col("i") - F.col("off")
    cand = found.join(prefix, ["s", "h"]).where(start >= 0).where(F.col("from") + F.size("near") >= start + F.size("win"))
    hits = cand.where(F.slice("near", start - F.col("from") + 1, F.size("win")) == F.col("win")).select(*KEY, "item_id", start.alias("a"), F.size("win").alias("n"))
    hits = written(hits.distinct())
    spots = hits.groupBy(*KEY, "a").agg(F.max("n").alias("n")).groupBy(*KEY).agg(F.size(F.array_distinct(F.flatten(F.collect_list(F.sequence("a", F.col("a") + F.col("n") - 1))))).cast("long").alias("n_hit"))
    ids = hits.select(*KEY, "item_id").distinct().groupBy(*KEY).agg(F.array_sort(F.collect_list("item_id")).alias("items"))
    return written(join_key(spots, ids))


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """One row per document: n_words, n_hit, n_items, items (ids), items_sha256, contaminated."""
    base = keyed(docs).select(*KEY, F.size(item_words(F.col("text"))).cast("long").alias("n_words"))
    out = join_key(base, hit_documents(docs, items, window, shingle))
    ids = F.coalesce("items", F.array().cast("array<string>"))
    return out.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.size(ids).cast("long").alias("n_items"), ids.alias("items"), F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"))


def keep_clean(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """The rows of docs that hold no window of an item; all columns as they were."""
    hits = hit_documents(docs, items, window, shingle).select(F.col("doc_id").alias("_hit"), F.col("_th").alias("_hit_th"))
    return docs.join(hits, docs["doc_id"].eqNullSafe(hits["_hit"]) & (F.xxhash64(docs["text"]) == hits["_hit_th"]), "left_anti")
