"""Mixing sources to target weights by Sainte-Lague apportionment, in DataFrame operations only.

A document's size is its number of words.  Sources, numbered by code point with null last, weigh `weights` in turn, and share `share` times
the words of all.  No source gets more than `most` times its words: what is above is shared anew by weight among the
others until none is above.  What a source gets is its target.

1. Words are dealt in blocks of BLOCK words.  All sources together get as many blocks as the targets have words for, each block
   going to the source with the highest quotient target / (2 * blocks + 1).  The quotients that compete are numbered by ranges, so
   the table of sources may be large; only sums over it reach the driver.
2. A source's documents are dealt into shards, about as many as a shard has documents: a source with a third of all rows becomes
   thousands of groups.  Its blocks go to its shards by highest quotients of their words, which gives integer quotas.
3. A shard's documents stand in a line, in an order that the seed decides, and the line is cut into blocks.  The quota's whole rounds take every
   block; the rest are successive blocks, around the line's end, from one that the seed decides.  So at most two documents of a shard
   are cut, and none is taken more than `most` times.  A line's last block may be short.

Reruns agree: nothing depends on how rows are dealt to tasks.  A source's words differ from its target by at most half a block and the
short last blocks of its shards.

Null text: no words, taken 0.  Null source: a source of its own.  Rows that share id and text take their places in the line in any order,
which gives the same rows.  No words at all: every target is 0.  Empty table: no rows.  Other columns are left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from provlake.llm.common import ranked, words_of, written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
BLOCK = 16
SEED = 7
#: Quotients of a source or shard that compete for the blocks beyond its certain ones (its share rounded down, less one).
NEXT = 4


def _marked(docs: DataFrame, seed: int) -> DataFrame:
    """doc_id, source, size and mark, 32 hexadecimal digits that decide a document's place."""
    dash = F.lit("-")
    mark = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), dash), F.coalesce(F.md5("text"), dash)))
    size = F.size(words_of(F.col("text"))).cast("long")
    return docs.select("doc_id", F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text")).select("doc_id",
        "source", size.alias("size"), mark.alias("mark"))


def _number(mark: Column, digits: int = 8) -> Column:
    return F.conv(F.substring(mark, 1, digits), 16, 10).cast("long")


def targets(sources: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """sources (source, words) with number, weight and target.  One pass of sums for each time that sources reach their bound."""
    numbered = ranked(sources.withColumn("_last", F.col("source").isNull()), [], ["_last", "source"], "number").drop("_last")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("number") % len(weights) + 1).cast("int"))
    out = written(numbered.withColumn("weight", weight))
    cap, capped, level = most * F.col("words"), F.lit(False), 0.0
    while True:
        sums = out.agg(F.sum("words").alias("all"), F.sum(F.when(capped, F.col("words"))).alias("full"),
            F.sum(F.when(~capped, F.col("weight"))).alias("weight")).first()
        left = share * (sums["all"] or 0) - most * (sums["full"] or 0)
        now = left / sums["weight"] if sums["weight"] else level
        if now <= level:  # no further source has reached its bound
            break
        level = now
        capped = cap <= F.lit(level) * F.col("weight")
    return out.withColumn("target", F.least(cap.cast("double"), F.lit(level) * F.col("weight")))


def _competing(parts: DataFrame, fair: Column) -> DataFrame:
    """parts with `sure`, blocks that a part of this fair share has in any case, once for each of its next NEXT quotients, numbered i."""
    sure = F.greatest(F.lit(0).cast("long"), F.floor(fair) - 1)
    return parts.withColumn("sure", sure).select("*", F.explode(F.sequence(F.lit(0), F.lit(NEXT - 1))).alias("i"))


def _quotient(size: str) -> Column:
    return F.col(size) / (2 * (F.col("sure") + F.col("i")) + 1)


def apportion_sources(sources: DataFrame, words: float, block: int = BLOCK) -> DataFrame:
    """sources (source, number, target, ...) with their blocks, as many as `words` fill: the highest quotients of all; ties by number.

    Quotients are equal if they are so in six decimals: equal targets in the ratio of weights are not told apart by rounding.
    """
    seats = int(words / block + 0.5)
    each = written(_competing(sources.select("number", "target"), F.col("target") / block).withColumn("low", -F.round(_quotient("target"), 6)))
    rest = seats - (each.where("i = 0").agg(F.sum("sure")).first()[0] or 0)
    won = ranked(each.where("target > 0"), [], ["low", "number", "i"], "turn").where(F.col("turn") < rest).groupBy("number").agg(F.count("*").alias("won"))
    own = each.where("i = 0").select("number", "sure").join(won, "number", "left")
    return sources.join(own.select("number", (F.col("sure") + F.coalesce("won", F.lit(0))).alias("blocks")), "number")


def apportion_shards(shards: DataFrame) -> DataFrame:
    """shards (number, shard, words, n_words and blocks of its source) with quota: its source's blocks by highest quotients of words; ties by shard."""
    each = _competing(shards, F.col("words").cast("double") * F.col("blocks") / F.greatest(F.col("n_words"), F.lit(1)))
    source = W.partitionBy("number")
    turn = F.row_number().over(source.orderBy(_quotient("words").desc(), "shard", "i"))
    rest = F.col("blocks") - F.sum(F.when(F.col("i") == 0, F.col("sure"))).over(source)
    won = F.count_if((F.col("turn") <= F.col("rest")) & (F.col("words") > 0))
    each = each.withColumns({"turn": turn, "rest": rest})
    return each.groupBy("number", "shard").agg(F.any_value("words").alias("words"), (F.any_value("sure") + won).alias("quota"))


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: int = MOST, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """doc_id, size, source_size, target, taken (words, repeats counted), rounds and pieces.

    rounds: how often the whole text is taken; pieces: the stretches (start, words) of it that are taken once more.
    """
    rows = written(_marked(docs, seed))
    sums = written(rows.groupBy("source").agg(F.sum("size").alias("words"), F.count("*").alias("n")))
    all_words = sums.agg(F.sum("words")).first()[0] or 0
    sources = apportion_sources(targets(sums, weights, share, most), min(share, most) * all_words, block)
    sources = written(sources.select(F.col("source").alias("_source"), "number", F.col("words").alias("n_words"), "target", "blocks",
        F.ceil(F.sqrt("n")).alias("n_shards")))
    placed = rows.join(sources, rows["source"].eqNullSafe(sources["_source"]))
    placed = written(placed.select("doc_id", "size", "mark", "number", "n_words", "target", "blocks",
        (_number(F.col("mark")) % F.col("n_shards")).alias("shard")))
    shards = placed.groupBy("number", "shard").agg(F.sum("size").alias("words"), F.any_value("n_words").alias("n_words"), F.any_value("blocks").alias("blocks"))
    shards = written(apportion_shards(shards)).select(F.col("number").alias("_number"), F.col("shard").alias("_shard"), "words", "quota")
    line = W.partitionBy("number", "shard").orderBy("mark").rowsBetween(W.unboundedPreceding, -1)
    at = placed.withColumn("at", F.coalesce(F.sum("size").over(line), F.lit(0)))
    at = at.join(shards, (F.col("number") == F.col("_number")) & (F.col("shard") == F.col("_shard")))
    length, words = F.greatest(F.col("words"), F.lit(1)), F.least(F.col("quota") * block, F.col("words") * most)
    n_blocks = F.ceil(length / block)
    begin = block * (_number(F.md5(F.concat_ws(":", F.lit(seed), "number", "shard"))) % n_blocks)
    at = at.withColumns({"rounds": F.floor(words / length), "rest": words % length, "begin": begin}).withColumn("stop", F.col("begin") + F.col("rest"))
    a, b = F.col("at"), F.col("at") + F.col("size")
    ahead = F.greatest(F.lit(0), F.least(b, F.col("stop")) - F.greatest(a, F.col("begin")))
    around = F.greatest(F.lit(0), F.least(b, F.col("stop") - length) - a)
    piece = lambda start, n: F.when(n > 0, F.struct(start.cast("long").alias("start"), n.cast("long").alias("words")))
    pieces = F.array_compact(F.array(piece(F.lit(0), around), piece(F.greatest(F.lit(0), F.col("begin") - a), ahead)))
    out = at.select("doc_id", "size", F.col("n_words").alias("source_size"), "target", F.when(b > a, F.col("rounds")).otherwise(0).alias("rounds"),
        pieces.alias("pieces"))
    taken = F.col("rounds") * F.col("size") + F.aggregate("pieces", F.lit(0).cast("long"), lambda n, p: n + p["words"])
    return out.withColumn("taken", taken)
