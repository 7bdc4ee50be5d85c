"""Queries over keyed state: the events as files that arrive one after another, each in a trigger of its own."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from provlake.plans.discovery import _SCROLL, table
from provlake.sources.shared import fresh_path
from provlake.streaming import discovery

#: Parts, each a trigger of its own, that the events come in.
FILES = 4
FILES_OF_A_TRIGGER = 8


@contextmanager
def _state_store(spark: SparkSession):
    was = {k: spark.conf.get(k, None) for k in discovery.STATE_STORE}
    for k, v in discovery.STATE_STORE.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in was.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _replayed(rows: DataFrame, order: str, last: list[DataFrame], transform: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What transform gives of rows that come in FILES parts by order, and then in one part for each table of last."""
    spark = rows.sparkSession
    path = fresh_path(spark, "stream")
    edges = [float("-inf"), *sorted(set(rows.approxQuantile(order, [i / FILES for i in range(1, FILES)], 0.001))), float("inf")]
    parts = [rows.where((F.col(order) > a) & (F.col(order) <= b)) for a, b in zip(edges, edges[1:], strict=False)]
    for i, part in enumerate([*parts, *last]):
        part.repartition(FILES_OF_A_TRIGGER).write.parquet(f"{path}/in/{i:03d}")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", FILES_OF_A_TRIGGER).parquet(f"{path}/in/*")
    with _state_store(spark):
        q = transform(stream).writeStream.trigger(availableNow=True).option("checkpointLocation", f"{path}/checkpoint").format("parquet").start(f"{path}/out")
        q.awaitTermination()
    return spark.read.parquet(f"{path}/out")


def scroll_stream(spark, d):
    e = table(spark, d, "events").select(F.to_date("ts").cast("string").alias("batch"), F.hour("ts").alias("round"), F.col("user_id").alias("item"),
        F.col("ts").cast("timestamp").alias("at"), "event_id")
    ends = [e.limit(1).withColumn("batch", F.lit("end")).withColumn("at", F.to_timestamp(F.lit(f"21{i}0-01-01")))
        for i in (0, 1)]  # rows of no batch, to move the watermark on
    out = _replayed(e, "event_id", ends, lambda s: discovery.scroll_stream(s, 60, 3))
    return out.where("batch <> 'end'").select("batch", "stop_round", "stop_reason", "discovered", "duplicates")


def seen_stream(spark, d):
    e = table(spark, d, "events").select("user_id", "event_type", F.col("event_id").alias("position"))
    return _replayed(e, "position", [], lambda s: discovery.seen_once(s, "user_id", "event_type"))


QUERIES = [
    (scroll_stream, _SCROLL),
    (seen_stream, "SELECT user_id, event_type, min(event_id) AS position FROM events GROUP BY ALL"),
]
