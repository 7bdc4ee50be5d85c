"""Accepted batches as a stream: the checkpoint is the set of batches that are known."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def new_batches(accepted: DataFrame, known: DataFrame, key: str = "batch_id") -> DataFrame:
    """Accepted batches that are not known, with their run key."""
    return accepted.select(key).distinct().join(known.select(key), key, "left_anti").select(key,
        F.concat(F.lit("accepted:"), F.col(key).cast("string")).alias("run_key"))


def accepted_stream(spark: SparkSession, root: str) -> DataFrame:
    """(batch_id, manifest, run_key) of every accepted/<batch>/manifest.json, as it appears."""
    lines = spark.readStream.option("pathGlobFilter", "manifest.json").option("recursiveFileLookup", True).text(root, wholetext=True)
    batch = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    return lines.select(batch.alias("batch_id"), F.col("value").alias("manifest")).withColumn("run_key", F.concat(F.lit("accepted:"), "batch_id"))


def register_accepted(spark: SparkSession, root: str, checkpoint: str, register: Callable[[DataFrame, int], None]) -> None:
    """One tick: hand all new batches to register (idempotent by run_key), then stop."""
    query = accepted_stream(spark, root).writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(register).start()
    query.awaitTermination()
