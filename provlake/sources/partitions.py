"""Dynamic partitions: named sets of keys that grow, and tables of which only the partitions that are written change."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from provlake.sources.table_log import Change, Snapshot, TableLog

#: The sets that batches, reference batches and published versions belong to.
SETS = ("collection_batches", "reference_batches", "gold_dataset_versions")


def registry(spark: SparkSession, path: str) -> TableLog:
    return TableLog(spark, path, {"partitions": "set_name string, key string, since long"})


def register(log: TableLog, keys: DataFrame) -> DataFrame:
    """keys (set_name, key) with `added`: whether the key was new.  Safe with several writers; a key is registered once."""
    def change(now: Snapshot) -> Change:
        there = now.table("partitions").select("set_name", "key", F.lit(False).alias("_new"))
        rows = keys.select("set_name", "key").where("key is not null").distinct().join(there, ["set_name", "key"], "left")
        rows = rows.select("set_name", "key", F.coalesce("_new", F.lit(True)).alias("added"))
        fresh = rows.where("added").select("set_name", "key", F.lit(now.version + 1).cast("long").alias("since"))
        return Change(add={"partitions": fresh}, outcome=rows)

    return log.commit(change)[1]


def keys_of(log: TableLog, set_name: str) -> DataFrame:
    return log.snapshot().table("partitions").where(F.col("set_name") == set_name).select("key", "since")


def overwrite(rows: DataFrame, path: str, by: str) -> None:
    """Replaces the partitions of `by` that rows hold; all others keep their files.  Rows of a partition are written together."""
    rows.repartition(by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def of_partitions(spark: SparkSession, path: str, by: str, keys: DataFrame, where: str | Column) -> DataFrame:
    """The rows of the partitions whose key (column `key`) meets the condition; others are pruned when the keys are known, at run time."""
    wanted = keys.where(where).select(F.col("key").alias("_key"))
    return spark.read.parquet(path).join(wanted, F.col(by) == F.col("_key")).drop("_key")
