"""What the text operators share: input columns, reliable cuts of lineage, null-safe joins, sorted groups."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: A document row is told by its id together with a hash of its text, so rows that share an id stay apart.
KEY = ["doc_id", "_th"]


def keyed(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, text (null stays null), _th and the columns named; whatever else the table holds is left out."""
    return docs.select("doc_id", F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("_th"), *more)


def free_name(name: str, columns: list[str]) -> str:
    """name, with underscores before it until no column has it."""
    while name.lower() in {c.lower() for c in columns}:
        name = f"_{name}"
    return name


def words_of(text: Column) -> Column:
    """Words of `[^\\x20\\x09-\\x0D]+`; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a temporary one only in a local session where none is set, as in tests."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir is not set: executors need a folder that they share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="provlake-"))
        found = spark.sparkContext.getCheckpointDir()
    return found


def _drop(spark: SparkSession, path: str) -> None:
    try:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # noqa: BLE001  the session is gone; the folder's owner clears it
        pass


def written(df: DataFrame) -> DataFrame:
    """df as a Parquet table in the shared folder: lineage ends there, and a lost executor loses nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/provlake-{uuid.uuid4().hex}"
    df.write.parquet(path)
    atexit.register(_drop, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def join_key(left: DataFrame, right: DataFrame, how: str = "left") -> DataFrame:
    """Join on KEY; null ids meet null ids.  right's key columns are dropped."""
    r = right.withColumnsRenamed({k: f"_r{k}" for k in KEY})
    on = left["doc_id"].eqNullSafe(r["_rdoc_id"]) & (left["_th"] == r["_r_th"])
    out = left.join(r, on, how)
    return out if how in ("left_semi", "left_anti") else out.drop(*[f"_r{k}" for k in KEY])


#: Rows of an Arrow batch: texts can be long, and Spark's usual 10,000 of them fill a worker's memory.
BATCH_ROWS = 1000


def small_batches(df: DataFrame) -> DataFrame:
    """df; its session sends Python workers at most BATCH_ROWS rows at a time from now on."""
    conf = df.sparkSession.conf
    if int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return df


#: Rows that a text kernel holds as Python objects at a time, whatever the size of Arrow's batches.
SLICE = 256
_ARROW = {"long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string(), "array<int>": pa.list_(pa.int32()), "array<string>": pa.list_(pa.string())}


def per_text(docs: DataFrame, f: Callable[[str], tuple], schema: str) -> DataFrame:
    """doc_id and f(text) of every row, in slices of Arrow batches; null counts as the empty text.  Ids pass as they are."""
    names, types = zip(*[c.split(" ", 1) for c in schema.split(", ")], strict=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, SLICE):
                part = b.slice(i, SLICE)
                cols = list(zip(*[f(t or "") for t in part.column(1).to_pylist()], strict=True))
                made = [pa.array(c, _ARROW[t]) for c, t in zip(cols, types, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), *made], names=["doc_id", *names])

    src = small_batches(docs).select("doc_id", F.col("text").cast("string").alias("text"))
    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, {schema}")


def sorted_groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Chunks of rows that are sorted by keys, cut only between groups: one batch and one group are in memory."""
    held: list[pd.DataFrame] = []
    for b in batches:
        if not len(b):
            continue
        same = np.ones(len(b), bool)
        for k in keys:
            same &= (b[k] == b[k].iloc[-1]).to_numpy()
        cut = len(b) if not same.any() else int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        if cut == 0 and held and not all(held[-1][k].iloc[-1] == b[k].iloc[0] for k in keys):
            yield pd.concat(held, ignore_index=True)
            held = []
        if cut:
            yield pd.concat([*held, b.iloc[:cut]], ignore_index=True)
            held = []
        if cut < len(b):
            held.append(b.iloc[cut:])
    if held:
        yield pd.concat(held, ignore_index=True)


def ranked(df: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """df with the number of each row inside its group, from 0 in the order of the columns named, nulls first.

    Rows are dealt by ranges of group and order, so a large group lies in many parts; a part's rows are numbered by themselves and moved
    on by the group's rows in earlier parts.  Rows that are equal in all these columns are numbered in any order.  df is read
    twice (ranges are found by sampling): it should be a written table.
    """
    part, before = free_name("_part", df.columns), free_name("_before", df.columns)
    rows = written(df.repartitionByRange(*group, *order).withColumn(part, F.spark_partition_id()))
    sizes = rows.groupBy(*group, part).agg(F.count("*").alias(before))
    earlier = W.partitionBy(*group).orderBy(part).rowsBetween(W.unboundedPreceding, -1)  # a row for each part at most
    sizes = sizes.select(*[F.col(c).alias(f"_of_{c}") for c in [*group, part]], F.coalesce(F.sum(before).over(earlier), F.lit(0)).alias(before))
    own = rows.withColumn(name, F.row_number().over(W.partitionBy(*group, part).orderBy(*order)) - 1)
    on = [own[c].eqNullSafe(sizes[f"_of_{c}"]) for c in [*group, part]]
    return own.join(sizes, on).withColumn(name, F.col(name) + F.col(before)).select(*df.columns, name)
