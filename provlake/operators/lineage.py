"""Lineage: ancestors and cycles over an edge table, by path doubling over written tables.

A table of jumps holds the pairs at exactly 1, 2, 4, ... edges from each other; each round joins what is known with the jumps
and the jumps with themselves.  So a chain of thousands takes a dozen rounds, and a plan reads a dozen tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from provlake.sources.shared import Scratch, written


def _joined(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out


def _doubled(jumps: DataFrame) -> DataFrame:
    """Jumps (low, high) of twice the length."""
    far = jumps.select(F.col("low").alias("mid"), F.col("high").alias("far"))
    return jumps.join(far, F.col("high") == F.col("mid")).select("low", F.col("far").alias("high")).distinct()


def ancestors(spark: SparkSession, edges: DataFrame, start: DataFrame) -> DataFrame:
    """(root, ancestor, child, relation, depth), once each; edges (parent, child, relation), start (root).

    An artifact that is reached at two depths has two rows.  The rounds end when no root has ancestors at the length reached, whatever the
    depth; a way longer than there are artifacts proves a cycle, which is an error.
    """
    with Scratch(spark) as scratch:
        e = scratch.written(edges.select("parent", "child", "relation").distinct(), "edges")
        most = e.select("child").distinct().count()
        jumps = scratch.written(e.select(F.col("child").alias("low"), F.col("parent").alias("high")).distinct(), "jumps")
        parts, length = [scratch.written(start.select("root", F.col("root").alias("at"), F.lit(0).alias("depth")).distinct(), "reached")], 1
        while True:
            known = _joined(parts)
            more = scratch.written(known.join(jumps, F.col("at") == F.col("low")).select("root", F.col("high").alias("at"),
                (F.col("depth") + length).alias("depth")).distinct(), "reached")
            if more.isEmpty():
                break
            if length > most:
                raise ValueError("the edges hold a cycle")
            parts.append(more)
            jumps, length = scratch.written(_doubled(jumps), "jumps"), 2 * length
        out = _joined(parts).join(e, F.col("at") == F.col("child"))
        return written(out.select("root", F.col("parent").alias("ancestor"), "child", "relation", (F.col("depth") + 1).alias("depth")), "ancestors")


def reached(spark: SparkSession, edges: DataFrame, start: DataFrame) -> DataFrame:
    """(root, ancestor), once each, the root itself included, however the edges run.

    A round that adds nothing ends it: an ancestor further away would have one on its shortest way that the round had found.
    """
    with Scratch(spark) as scratch:
        jumps = scratch.written(edges.select(F.col("child").alias("low"), F.col("parent").alias("high")).distinct(), "jumps")
        parts = [scratch.written(start.select("root", F.col("root").alias("ancestor")).distinct(), "reached")]
        while True:
            known = _joined(parts)
            step = known.join(jumps, F.col("ancestor") == F.col("low")).select("root", F.col("high").alias("ancestor")).distinct()
            more = scratch.written(step.join(known, ["root", "ancestor"], "left_anti"), "reached")
            if more.isEmpty():
                return written(known, "reached")
            parts.append(more)
            jumps = scratch.written(_doubled(jumps), "jumps")


def would_cycle(spark: SparkSession, edges: DataFrame, proposed: DataFrame) -> DataFrame:
    """proposed (parent, child) with `rejected`: the child is the parent or one of its ancestors already."""
    up = reached(spark, edges, proposed.select(F.col("parent").alias("root")).distinct()).select(F.col("root").alias("parent"),
        F.col("ancestor").alias("child"))
    marked = proposed.join(up.withColumn("_hit", F.lit(True)), ["parent", "child"], "left")
    return marked.select("parent", "child", (F.coalesce("_hit", F.lit(False)) | (F.col("parent") == F.col("child"))).alias("rejected"))


def on_cycles(edges: DataFrame, some: DataFrame) -> DataFrame:
    """some (parent, child) of the edges with `rejected`: the edge lies on a cycle of all edges."""
    return would_cycle(edges.sparkSession, edges, some)


def ancestor_artifacts(found: DataFrame, artifacts: DataFrame, key: str = "artifact_id") -> DataFrame:
    """found (root, ancestor, ...) with the columns of the ancestor's artifact; ancestors without one go."""
    return found.join(artifacts, F.col("ancestor") == F.col(key)).drop(key)
