"""The folder that driver and executors share, and tables written there to cut lineage.

Tables of a Scratch go when it is left; all others when the interpreter ends.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; only a local session may do without it, in a temporary folder."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir is not set: executors need a folder that they share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="provlake-"))
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def _delete_last(spark: SparkSession, path: str) -> None:
    try:
        delete(spark, path)
    except Exception:  # noqa: BLE001  the session is gone; the folder's owner clears it
        pass


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path that is not in use; what is there when the interpreter ends is deleted."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    atexit.register(_delete_last, spark, path)
    return path


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """df as a Parquet table in the shared folder."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """df's rows dealt evenly over four tasks a core at least: rows of a few small files, on which much is computed, would else share a few tasks."""
    spark = df.sparkSession
    return df.repartition(max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))


class Scratch:
    """Tables that are needed until the result that is made from them is written."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_: object) -> None:
        for path in self.paths:
            delete(self.spark, path)

    def written(self, df: DataFrame, name: str = "table") -> DataFrame:
        path = f"{shared_folder(self.spark)}/{name}-{uuid.uuid4().hex}"
        self.paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)
