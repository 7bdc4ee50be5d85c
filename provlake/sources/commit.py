"""Small files as commit points: created whole or not at all, and never over another."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """(file system, path) of Hadoop."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def create_file(spark: SparkSession, path: str, data: bytes) -> bool:
    """A new file with these bytes; False, and nothing changed, if there is one already.  Of several writers one gets True.

    The bytes are written beside the path first.  Then the file appears by one atomic step that refuses an existing target: a rename without
    overwriting, or on a local disk a hard link.  Object stores whose rename is a copy do not give this guarantee.
    """
    fs, target = file_system(spark, path)
    folder = target.getParent()
    fs.mkdirs(folder)
    beside = spark._jvm.org.apache.hadoop.fs.Path(folder, f".{target.getName()}-{uuid.uuid4().hex}")
    stream = fs.create(beside)
    stream.write(data)
    stream.close()
    try:
        if fs.getScheme() == "file":
            link = spark._jvm.java.nio.file.Paths
            none = spark.sparkContext._gateway.new_array(spark._jvm.java.lang.String, 0)
            local = lambda p: link.get(p.toUri().getPath(), none)
            spark._jvm.java.nio.file.Files.createLink(local(target), local(beside))
        else:
            rename = spark._jvm.org.apache.hadoop.fs.Options.Rename
            options = spark.sparkContext._gateway.new_array(rename, 1)
            options[0] = rename.NONE
            spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(beside, target, options)
    except Py4JJavaError as e:
        if "AlreadyExists" not in e.java_exception.getClass().getName():
            raise
        return False
    finally:
        fs.delete(beside, False)
    return True


def read_file(spark: SparkSession, path: str) -> bytes | None:
    """The bytes of a small file; None if there is none."""
    fs, p = file_system(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    finally:
        stream.close()


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the visible files and folders of a folder, sorted; none if it is not there."""
    fs, p = file_system(spark, path)
    return sorted(n for n in (s.getPath().getName() for s in fs.listStatus(p)) if not n.startswith(".")) if fs.exists(p) else []


def delete(spark: SparkSession, path: str) -> None:
    fs, p = file_system(spark, path)
    fs.delete(p, True)
