"""Merkle manifest of a dataset: a nested-struct rollup of row digests, with a proof for every row.

A row's leaf is H of the named columns' values: `-` for null, else the length in UTF-8 bytes, `:`, the value; H is the SHA-256 in lowercase
hexadecimal.  In each group (source) the leaves stand in the order of `order` (doc_id; nulls first; ties by leaf).  While more than one node
is left, every FAN successive ones become H of their concatenation.  What is left is the group's subroot.  The subroots in the
order of groups (null first, bytewise) give the root in the same way.

1. Leaves are computed once and written without the texts; ranks inside groups come from ranges of rows (`common.ranked`).
2. The rank's digits to the base FAN are columns.  In blocks of FAN * FAN rows the last digit is grouped away, then the one before it; each
   time the children become an array of structs inside their parent.  A block is one row of bounded size.  The blocks' nodes are the
   rows of the next tier, without their children, until every group has one node; a tier is 1 / 256 of the one below it.
3. From the top down, a transform over a block's nested arrays writes beside each child what stands left and right of it on each level, and
   an explode emits the children with their proofs; there is no join inside a block.  Between two tiers a block's row meets its own proof by (group,
   block), a key that has one row on either side.  (Nesting whole groups would need no join at all, but rows without a bound.)

A group with a third of all rows is dealt in ranges and blocks like any other.  Null group: a group of its own.  Repeated rows: each is a leaf.  Empty
table: no rows.  Columns that aren't named may have any names.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provlake.llm.common import ranked, written

FAN = 16
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_STEP = "struct<pre:string,post:string>"


def leaf_digest(values: Sequence[Column]) -> Column:
    """H of the values, each as `-` or length, `:`, text."""
    text = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text]), 256)


def _joined(nodes: Column) -> Column:
    return F.array_join(F.transform(nodes, lambda x: x["h"]), "")


def _nested(nodes: DataFrame, fan: int) -> DataFrame:
    """Blocks (g, block, n, h, runs) of nodes (g, rank, n, h, item); n: nodes of the group at this tier.  A group of one node isn't hashed."""
    last, before, block = F.col("rank") % fan, F.floor(F.col("rank") / fan) % fan, F.floor(F.col("rank") / (fan * fan))
    digits = nodes.select("g", block.alias("block"), before.alias("d1"), last.alias("d0"), "n", "h", "item").repartition("g", "block")
    kids = F.array_sort(F.collect_list(F.struct("d0", "h", "item")))
    node = lambda over, least: F.when(F.col("n") > least, F.sha2(_joined(F.col(over)), 256)).otherwise(F.col(over)[0]["h"]).alias("h")
    low = digits.groupBy("g", "block", "n", "d1").agg(kids.alias("kids")).select("g", "block", "n", "d1", node("kids", 1), "kids")
    runs = F.array_sort(F.collect_list(F.struct("d1", "h", "kids")))
    return low.groupBy("g", "block", "n").agg(runs.alias("runs")).select("g", "block", "n", node("runs", fan), "runs")


def _step(nodes: Column, i: Column) -> Column:
    """What stands left and right of the i-th of some nodes."""
    return F.struct(_joined(F.slice(nodes, F.lit(1), i)).alias("pre"), _joined(F.slice(nodes, i + 2, F.size(nodes))).alias("post"))


def _emitted(blocks: DataFrame, above: DataFrame, fan: int) -> DataFrame:
    """(g, rank, h, item, path, subroot, root) of a tier's nodes; above: (g, rank, path, subroot, root) of its blocks."""
    up = above.select(F.col("g").alias("_g"), F.col("rank").alias("_rank"), "path", "subroot", "root")
    own = blocks.join(up, blocks["g"].eqNullSafe(up["_g"]) & (blocks["block"] == up["_rank"]))
    steps = lambda kids, i, runs, j: F.concat(
        F.when(F.col("n") > 1, F.array(_step(kids, i))).otherwise(F.array().cast(f"array<{_STEP}>")),
        F.when(F.col("n") > fan, F.array(_step(runs, j))).otherwise(F.array().cast(f"array<{_STEP}>")),
    )
    number = lambda i, j: (F.col("block") * fan + j) * fan + i
    child = lambda kids, j: F.transform(kids, lambda x,
        i: F.struct(number(i, j).alias("rank"), x["h"].alias("h"), x["item"].alias("item"), steps(kids, i, F.col("runs"), j).alias("low")))
    rows = own.select("g", "path", "subroot", "root", F.explode(F.flatten(F.transform("runs", lambda r, j: child(r["kids"], j)))).alias("x"))
    return rows.select("g", "x.rank", "x.h", "x.item", F.concat("x.low", "path").alias("path"), "subroot", "root")


def _climbed(nodes: DataFrame, largest: int, fan: int) -> list[DataFrame]:
    """The blocks of each tier, from the leaves up to the one where every group is one block."""
    tiers = [written(_nested(nodes, fan))]
    while largest > fan * fan:
        largest = -(-largest // (fan * fan))
        up = tiers[-1].select("g", F.col("block").alias("rank"), F.ceil(F.col("n") / (fan * fan)).alias("n"), "h", F.lit(None).cast("int").alias("item"))
        tiers.append(written(_nested(up, fan)))
    return tiers


def _descended(tiers: list[DataFrame], above: DataFrame, fan: int) -> DataFrame:
    """(g, rank, h, item, path, subroot, root) of the lowest tier's nodes; above: (g, path, subroot, root)."""
    paths = above.withColumn("rank", F.lit(0).cast("long"))
    for blocks in tiers[:0:-1]:
        paths = written(_emitted(blocks, paths, fan).drop("item", "h"))
    return _emitted(tiers[0], paths, fan)


def proofs(rows: DataFrame, columns: Sequence[str] = COLUMNS, group: str = "source", order: str = "doc_id", carry: Mapping[str, Column] | None = None,
    fan: int = FAN) -> DataFrame:
    """One row for each row: `order`, leaf, path, subroot, root, and the values of `carry`, expressions over rows.

    path: for each level, from the leaf's up to the root's, the digests left and right of the row's node, concatenated.
    """
    carry = carry or {}
    item = F.struct(F.col(order).alias("key"), *[c.alias(f"c{i}") for i, c in enumerate(carry.values())])
    leaves = written(rows.select(F.col(group).cast("string").alias("g"), F.col(order).alias("o"), leaf_digest([F.col(c) for c in columns]).alias("h"),
        item.alias("item")))
    sizes = written(leaves.groupBy("g").agg(F.count("*").alias("n")))
    total = sizes.agg(F.max("n"), F.count("*")).first()
    own = sizes.select(F.col("g").alias("_g"), "n")
    numbered = ranked(leaves, ["g"], ["o", "h"], "rank")
    tiers = _climbed(numbered.join(own, numbered["g"].eqNullSafe(own["_g"])).drop("_g"), total[0] or 0, fan)
    subroots = written(tiers[-1].select(F.lit(0).alias("g"), F.col("g").alias("item"), "h"))
    top = _climbed(ranked(subroots, ["g"], ["item"], "rank").withColumn("n", F.lit(total[1]).cast("long")), total[1], fan)
    nothing = F.array().cast(f"array<{_STEP}>").alias("path")
    roots = top[-1].select("g", nothing, F.lit(None).cast("string").alias("subroot"), F.col("h").alias("root"))
    above = _descended(top, roots, fan).select(F.col("item").alias("g"), "path", "root")
    above = above.join(subroots.select(F.col("item").alias("_g"), F.col("h").alias("subroot")), F.col("g").eqNullSafe(F.col("_g"))).drop("_g")
    out = _descended(tiers, written(above), fan)
    more = [F.col(f"item.c{i}").alias(name) for i, name in enumerate(carry)]
    return out.select(F.col("item.key").alias(order), F.col("h").alias("leaf"), "path", "subroot", "root", *more)


def siblings_digest(path: Column) -> Column:
    """H of all siblings on the way to the root, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda p: F.concat(p["pre"], p["post"])), ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, leaf, lambda h, p: F.sha2(F.concat(p["pre"], h, p["post"]), 256))


def verified(rows: DataFrame) -> DataFrame:
    """proofs with `verified`: whether the leaf and its path lead to the root."""
    return rows.withColumn("verified", folded(F.col("leaf"), F.col("path")) == F.col("root"))
