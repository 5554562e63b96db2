"""Shared scratch space for tables that cut lineage or feed a stream.

On a cluster it lies under the folder named by ``spark.checkpoint.dir``, which every
executor can reach, so a lost executor loses nothing. Only where that setting is missing,
as in tests on one machine, a temporary folder stands in.

What an application has put there is deleted when its Python process ends, or by :func:`clear`.
Results that are still lazy read from it, so nothing is deleted before.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

from ledgerwake.sources import files

SETTING = "spark.checkpoint.dir"


# Stand-in folder of each application that names none.
_local_roots: dict[str, str] = {}
# What each application has been given, to be deleted at its end.
_given: dict[str, list[str]] = {}


def scratch_root(spark: SparkSession) -> str:
    root = spark.conf.get(SETTING, None)
    if root:
        return root.rstrip("/")
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise ValueError(f"set {SETTING} to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="ledgerwake-")
    return _local_roots[app]


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new, empty location; no two calls share one."""
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    _given.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def clear(spark: SparkSession) -> None:
    """Delete all locations this application was given. Nothing may read from them any more."""
    app = spark.sparkContext.applicationId
    for path in _given.pop(app, []):
        files.delete(spark, path)
    root = _local_roots.pop(app, None)
    if root is not None:
        files.delete(spark, root)


@atexit.register
def _clear_at_exit() -> None:
    spark = SparkSession.getActiveSession()
    if spark is None:
        return
    try:
        clear(spark)
    except (Py4JError, OSError):  # the context has been stopped or its JVM has gone
        pass


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and go on from the written table."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unstage(df: DataFrame) -> None:
    """Delete the tables that :func:`staged` wrote for ``df``, which nothing reads any more.

    Other tables that it reads stay.
    """
    spark = df.sparkSession
    given = _given.get(spark.sparkContext.applicationId, [])
    read = {name.rsplit("/", 2)[1] for name in df.inputFiles()}
    for path in [p for p in given if p.rsplit("/", 1)[1] in read]:
        files.delete(spark, path)
        given.remove(path)
