"""Send this library to the executors of an application that was started without it."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import ledgerwake

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Add the package as a Python dependency, once for each application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.abspath(ledgerwake.__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="ledgerwake-code-"), "ledgerwake.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(package)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
