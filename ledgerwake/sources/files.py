"""Small operations on the shared file system that hold no rows: names, marks and manifests.

They go through the Hadoop client of the driver's JVM, so they work wherever Spark's own readers
and writers do. That needs a classic session (not Spark Connect).
"""

from __future__ import annotations

from pyspark.errors import PySparkException
from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that a glob pattern fits, sorted; none if even its folder is missing."""
    store, where = _at(spark, pattern)
    return sorted(f.getPath().toString() for f in store.globStatus(where) or ())


def exists(spark: SparkSession, path: str) -> bool:
    store, where = _at(spark, path)
    return store.exists(where)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder with all it holds; nothing happens if it is missing."""
    store, where = _at(spark, path)
    store.delete(where, True)


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files below a folder."""
    store, where = _at(spark, path)
    return store.getContentSummary(where).getLength()


def modified(spark: SparkSession, path: str) -> int:
    store, where = _at(spark, path)
    return store.getFileStatus(where).getModificationTime()


def read_text(spark: SparkSession, path: str) -> str:
    store, where = _at(spark, path)
    stream = store.open(where)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a new file in one step; False, and nothing done, if the path is taken.

    The text is written beside its place and renamed, which never replaces a file on HDFS and on
    local disks. An object store without such a rename needs one writer at a time.
    """
    store, where = _at(spark, path)
    if store.exists(where):
        return False
    draft = where.suffix(f".{spark.sparkContext._jvm.java.util.UUID.randomUUID().toString()}.tmp")
    stream = store.create(draft, False)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    try:
        if store.rename(draft, where):
            return True
    except (Py4JJavaError, PySparkException):
        pass
    store.delete(draft, False)
    return False
