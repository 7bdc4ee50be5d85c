"""First-wins dedupe, caps, slices, upserts, discovery rounds, incremental skips."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def _cols(x: str | Sequence[str]) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def first_wins(df: DataFrame, key: str | Sequence[str], order: str | Sequence[str], keep_null_keys: bool = False) -> DataFrame:
    """The first row of each key.  keep_null_keys: rows without a (first) key all stay; they go past the window, so many are no hot task."""
    keys = _cols(key)
    keyed = df.where(F.col(keys[0]).isNotNull()) if keep_null_keys else df
    first = keyed.withColumn("_rn", F.row_number().over(W.partitionBy(*keys).orderBy(*_cols(order)))).where("_rn = 1").drop("_rn")
    return first.unionAll(df.where(F.col(keys[0]).isNull())) if keep_null_keys else first


def last_wins(df: DataFrame, key: str | Sequence[str], order: str) -> DataFrame:
    w = W.partitionBy(*_cols(key)).orderBy(F.col(order).desc())
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def numbered(df: DataFrame, group: str | Sequence[str], order: str | Sequence[str], name: str = "discovery_order", cap: int | None = None) -> DataFrame:
    """1, 2, ... in each group; at most cap rows of a group (the cap is the feature)."""
    out = df.withColumn(name, F.row_number().over(W.partitionBy(*_cols(group)).orderBy(*_cols(order))))
    return out if cap is None else out.where(F.col(name) <= cap)


def chunk(df: DataFrame, group: str | Sequence[str], order: str, offset: int, limit: int | None) -> DataFrame:
    """Rows offset + 1 ... offset + limit of each group, in order, after all filters."""
    rn = F.row_number().over(W.partitionBy(*_cols(group)).orderBy(order))
    out = df.withColumn("_rn", rn).where(F.col("_rn") > offset)
    return (out if limit is None else out.where(F.col("_rn") <= offset + limit)).drop("_rn")


def skip_known(new: DataFrame, known: DataFrame, keys: Sequence[str], known_key: str = "key") -> DataFrame:
    """Rows none of whose keys is known: one anti join for each key, never a join with OR."""
    for k in keys:
        new = new.join(known.select(F.col(known_key).alias("_known")), F.col(k) == F.col("_known"), "left_anti")
    return new


def existing_keys(df: DataFrame, *keys: Column) -> DataFrame:
    """All keys of the stored rows, once each."""
    return df.select(F.explode(F.array(*keys)).alias("key")).where(F.col("key").isNotNull() & (F.col("key") != "")).distinct()


def append_new(existing: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """existing, and those rows of new whose keys it has not."""
    return existing.unionByName(new.join(existing.select(*keys).distinct(), list(keys), "left_anti"), allowMissingColumns=True)


def failures(*tables: DataFrame) -> DataFrame:
    """Failure tables of several commands as one; columns that a table lacks are null."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def upsert(existing: DataFrame, new: DataFrame, key: str, order: str) -> DataFrame:
    """Last payload wins, at the place where the key first appeared (`position`)."""
    rows = existing.withColumn("_src", F.lit(0)).unionByName(new.withColumn("_src", F.lit(1)))
    w = W.partitionBy(key)
    rank = F.row_number().over(w.orderBy(F.col("_src").desc(), F.col(order).desc()))
    first = F.min(F.struct("_src", order)).over(w)
    return rows.withColumn("_rn", rank).withColumn("_first", first).where("_rn = 1").withColumn("position", F.col("_first")[order]).drop("_rn",
        "_first", "_src")


def reuse_or_fetch(wanted: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """wanted with `action`: reuse what is stored, fetch the rest."""
    keys = stored.select(key).distinct()
    return wanted.join(keys, key, "left_semi").withColumn("action",
        F.lit("REUSE")).unionByName(wanted.join(keys, key, "left_anti").withColumn("action", F.lit("FETCH")))


def drop_checked(rows: DataFrame, checks: DataFrame, key: str, where: str | Column) -> DataFrame:
    """Rows without a check that meets the condition; rows without a key stay."""
    return rows.join(checks.where(where).select(F.col(key).alias("_checked")).distinct(), F.col(key) == F.col("_checked"), "left_anti")


def scroll_stop(candidates: DataFrame, batch: str, round_: str, item: str, max_items: int, unchanged_limit: int) -> DataFrame:
    """One row for each batch: stop_round, stop_reason, discovered, duplicates.

    Rounds in order; an item is new in its first round.  Stop at the first round where the running number of
    items reaches max_items, or after unchanged_limit rounds in a row without a new one, else at the last round.
    duplicates: appearances, up to the stop, of items known from an earlier round.
    """
    first = candidates.groupBy(batch, item).agg(F.min(round_).alias("_first"))
    per_round = candidates.select(batch, round_).distinct()
    new = first.groupBy(batch, F.col("_first").alias(round_)).agg(F.count("*").alias("_new"))
    runs = per_round.join(new, [batch, round_], "left").fillna(0, ["_new"])
    w = W.partitionBy(batch).orderBy(round_)
    runs = runs.withColumn("_cum", F.sum("_new").over(w)).withColumn("_island", F.sum((F.col("_new") > 0).cast("int")).over(w))
    runs = runs.withColumn("_streak", F.sum((F.col("_new") == 0).cast("int")).over(W.partitionBy(batch, "_island").orderBy(round_)))
    reason = F.when(F.col("_cum") >= max_items, "MAX_PRODUCTS_REACHED").when(F.col("_streak") >= unchanged_limit, "NO_NEW_PRODUCTS")
    runs = runs.withColumn("_reason", reason)
    stop = runs.groupBy(batch).agg(
        F.coalesce(F.min(F.when(F.col("_reason").isNotNull(), F.col(round_))), F.max(round_)).alias("stop_round"),
        F.coalesce(F.min_by("_reason", F.when(F.col("_reason").isNotNull(), F.col(round_))), F.lit("SCROLL_LIMIT_REACHED")).alias("stop_reason"),
    )
    seen = candidates.join(first, [batch, item]).join(stop, batch).where(F.col(round_) <= F.col("stop_round"))
    hits = seen.groupBy(batch).agg(F.count_if(F.col("_first") < F.col(round_)).alias("duplicates"),
        F.least(F.count_distinct(item), F.lit(max_items)).cast("long").alias("discovered"))
    return stop.join(hits, batch).select(batch, "stop_round", "stop_reason", "discovered", "duplicates")
