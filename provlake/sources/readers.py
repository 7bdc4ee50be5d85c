"""Readers of the batch layout and the sinks that pair with them."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from provlake.functions.urls import RULES, UrlRules, product_id
from provlake.operators.dedupe import first_wins

LAYOUT = ("discovery", "crawl_raw", "detail_images", "ocr_raw", "outcome", "inbox/accepted", "silver", "gold")


def strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def read_flat(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """CSV with header, all strings, BOM and embedded line breaks allowed; ragged rows keep their text in `_corrupt`."""
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("mode", "PERMISSIVE")
    if columns:
        reader = reader.schema(strings(*columns, "_corrupt")).option("columnNameOfCorruptRecord", "_corrupt").option("enforceSchema", False)
    paths = [path] if isinstance(path, str) else list(path)
    return reader.csv(paths)


def from_path(part: int) -> Column:
    """The part-th last folder of the row's file (1: the folder that holds it)."""
    return F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1 - part)


def read_batches(spark: SparkSession, pattern: str, columns: Sequence[str]) -> DataFrame:
    """read_flat over a glob; the folder's name is batch_path, so a glob on it prunes files."""
    plain = spark.read.schema(strings(*columns)).option("header", True).option("multiLine", True).option("escape", '"').csv(pattern)
    return plain.select("*", from_path(1).alias("batch_path"))


def read_json_strict(spark: SparkSession, path: str) -> DataFrame:
    """(path, payload, error): INVALID_JSON where the file is no JSON object."""
    raw = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("payload"))
    ok = F.schema_of_variant(F.try_parse_json("payload")).startswith("OBJECT")
    return raw.withColumn("error", F.when(~F.coalesce(ok, F.lit(False)), "INVALID_JSON"))


def read_json_lenient(spark: SparkSession, path: str) -> DataFrame:
    """(path, payload): anything that is no JSON object becomes {}."""
    strict = read_json_strict(spark, path)
    return strict.select("path", F.when(F.col("error").isNull(), F.col("payload")).otherwise("{}").alias("payload"))


def read_nested(spark: SparkSession, path: str, schema: T.StructType | str, lines: bool = False) -> DataFrame:
    """JSON files of one object or array each; lines: of one object a line, as write_nested leaves them."""
    return spark.read.schema(schema).option("multiLine", not lines).json(path)


def read_urls(spark: SparkSession, path: str, rules: UrlRules = RULES) -> DataFrame:
    """A list of URLs: comments and blanks go, first of each id stays, lines without an id all stay."""
    lines = spark.read.text(path).select(F.trim("value").alias("url"), F.monotonically_increasing_id().alias("position"))
    lines = lines.where((F.col("url") != "") & ~F.col("url").startswith("#")).withColumn("product_id", product_id("url", rules))
    return first_wins(lines, "product_id", "position", keep_null_keys=True)


def file_hashes(spark: SparkSession, pattern: str) -> DataFrame:
    """(path, name, size, sha256) of files."""
    return spark.read.format("binaryFile").load(pattern).select("path", F.element_at(F.split("path", "/"), -1).alias("name"),
        F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))


def list_batches(spark: SparkSession, root: str, contains: str = "", required: str | None = None) -> DataFrame:
    """Folders below root, names descending; optionally by a part of the name or by a file that they must hold."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path")
    rest = F.split_part(F.col("path"), F.lit(f"{root.rstrip('/')}/"), F.lit(2))
    rows = files.select(F.split_part(rest, F.lit("/"), F.lit(1)).alias("batch_id"),
        F.element_at(F.split("path", "/"), -1).alias("name")).where(F.contains("batch_id", F.lit(contains)))
    rows = rows.groupBy("batch_id").agg(F.bool_or(F.col("name") == F.lit(required or "")).alias("has"))
    return (rows.where("has") if required else rows).select("batch_id").orderBy(F.col("batch_id").desc())


def accepted_batches(spark: SparkSession, root: str) -> DataFrame:
    return list_batches(spark, root, required="manifest.json").orderBy("batch_id")


def write_flat(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def write_nested(df: DataFrame, path: str, partition: str | None = None, mode: str = "overwrite") -> None:
    writer = df.write.mode(mode)
    (writer.partitionBy(partition) if partition else writer).json(path)


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def create_layout(spark: SparkSession, root: str) -> None:
    """All folders of the layout; those that are there stay."""
    for name in LAYOUT:
        fs, p = _fs(spark, f"{root.rstrip('/')}/{name}")
        fs.mkdirs(p)


def commit_folder(df: DataFrame, path: str, fmt: str = "parquet", fresh: bool = True) -> None:
    """Write beside path, then rename once: readers see all of it or nothing.  fresh: an existing path is refused."""
    spark = df.sparkSession
    staging = f"{path.rstrip('/')}.staging-{uuid.uuid4().hex}"
    fs, target = _fs(spark, path)
    if fs.exists(target):
        if fresh:
            raise FileExistsError(path)
        old = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}.old-{uuid.uuid4().hex}")
    else:
        old = None
    source = spark._jvm.org.apache.hadoop.fs.Path(staging)
    try:
        df.write.format(fmt).save(staging)
        if old is not None:
            fs.rename(target, old)
        if not fs.rename(source, target):
            raise OSError(f"could not rename to {path}")
    finally:
        fs.delete(source, True)
    if old is not None:
        fs.delete(old, True)


def compact(spark: SparkSession, pattern: str, schema: T.StructType | str, path: str, rows_per_file: int = 5_000_000) -> None:
    """Many small JSON files as Parquet at path, in one commit: few large files, no row in two of them."""
    spark.read.schema(schema).json(pattern).hint("rebalance").write.option("maxRecordsPerFile", rows_per_file).parquet(path)
