"""Runs, steps, artifacts and quality results as tables: inserts, conflicts, states, snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

# The state machine of runs and steps.
TRANSITIONS = {
    "PENDING": ("RUNNING", "CANCELLED"),
    "RUNNING": ("SUCCEEDED", "FAILED", "PARTIAL", "CANCELLED"),
    "SUCCEEDED": (),
    "FAILED": (),
    "PARTIAL": (),
    "CANCELLED": (),
}
TERMINAL = ("SUCCEEDED", "FAILED", "PARTIAL", "CANCELLED")


def insert_or_return(existing: DataFrame, new: DataFrame, key: str | Sequence[str], compared: Sequence[str]) -> DataFrame:
    """new with `outcome`: INSERTED, RETURNED (the same is there) or CONFLICT (another is there under the key)."""
    keys = [key] if isinstance(key, str) else list(key)
    there = existing.select(*keys, *[F.col(c).alias(f"_was_{c}") for c in compared], F.lit(True).alias("_there"))
    same = F.lit(True)
    for c in compared:
        same = same & F.col(c).eqNullSafe(F.col(f"_was_{c}"))
    outcome = F.when(F.col("_there").isNull(), "INSERTED").when(same, "RETURNED").otherwise("CONFLICT")
    return new.join(there, keys, "left").withColumn("outcome", outcome).select(*new.columns, "outcome")


def insert_missing(existing: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    return existing.unionByName(new.join(existing.select(*keys), list(keys), "left_anti"))


def keep_first_id(rows: DataFrame, keys: Sequence[str], order: str, id_: str) -> DataFrame:
    """Last payload for each key under the id of the first."""
    w = W.partitionBy(*keys)
    rows = rows.withColumn("_id", F.first(id_).over(w.orderBy(order))).withColumn("_rn", F.row_number().over(w.orderBy(F.col(order).desc())))
    return rows.where("_rn = 1").withColumn(id_, F.col("_id")).drop("_id", "_rn")


def allowed(current: str | Column, target: str | Column) -> Column:
    a, b = (F.col(x) if isinstance(x, str) else x for x in (current, target))
    ok = a == b
    for state, after in TRANSITIONS.items():
        if after:
            ok = ok | ((a == state) & b.isin(*after))
    return ok


def checked_transitions(events: DataFrame, entity: str, order: str, status: str) -> DataFrame:
    """events with previous and `valid`; the first state of an entity must be PENDING."""
    before = F.lag(status).over(W.partitionBy(entity).orderBy(order))
    return events.withColumn("previous", before).withColumn("valid", F.when(before.isNull(), F.col(status) == "PENDING").otherwise(allowed(before, status)))


def current_state(events: DataFrame, entity: str, order: str, status: str, at: str) -> DataFrame:
    """The folded event log: last state, started_at (first RUNNING), finished_at (first terminal state)."""
    return events.groupBy(entity).agg(
        F.max_by(status, order).alias(status),
        F.min(F.when(F.col(status) == "RUNNING", F.col(at))).alias("started_at"),
        F.min(F.when(F.col(status).isin(*TERMINAL), F.col(at))).alias("finished_at"),
    )


def snapshot(runs: DataFrame, run_id: str, **children: tuple[DataFrame, Sequence[str]]) -> DataFrame:
    """runs with one sorted array of structs for each child table: children=(table, columns, first sorts)."""
    for name, (table, columns) in children.items():
        nested = table.groupBy(run_id).agg(F.array_sort(F.collect_list(F.struct(*columns))).alias(name))
        runs = runs.join(nested, run_id, "left").withColumn(name, F.coalesce(name, F.array().cast(nested.schema[name].dataType)))
    return runs


def recent(runs: DataFrame, order: str, tie: str, k: int) -> DataFrame:
    """The k latest runs, 1 to 1000 (a top-k report)."""
    if not 1 <= k <= 1000:
        raise ValueError("k must be 1 to 1000")
    return runs.orderBy(F.col(order).desc(), tie).limit(k)


def migrations_to_apply(found: DataFrame, applied: DataFrame) -> DataFrame:
    """(version, checksum, action): APPLY, SKIP or CHECKSUM_CHANGED."""
    was = applied.select("version", F.col("checksum").alias("_was"))
    action = F.when(F.col("_was").isNull(), "APPLY").when(F.col("_was") == F.col("checksum"), "SKIP").otherwise("CHECKSUM_CHANGED")
    return found.join(was, "version", "left").select("version", "checksum", action.alias("action"))


def found_migrations(files: DataFrame) -> DataFrame:
    """(version, name, checksum) of files (name, sha256) named NNNN_<what>.up.sql."""
    return files.where(F.col("name").rlike(r"^[0-9]{4}_.*\.up\.sql$")).select(F.left("name", F.lit(4)).alias("version"), "name",
        F.col("sha256").alias("checksum"))


def with_trigger(runs: DataFrame, trigger: str | Column, logs: str, run_id: str = "run_id") -> DataFrame:
    """runs with what started them and where their log lies."""
    t = F.lit(trigger) if isinstance(trigger, str) else trigger
    return runs.withColumns({"trigger": t, "log_path": F.concat(F.lit(f"{logs.rstrip('/')}/"), F.col(run_id), F.lit(".log"))})
