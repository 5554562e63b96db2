"""Row filters. Plain predicates, so they reach the Parquet scan."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def require(df: DataFrame, *columns: str) -> DataFrame:
    """Keep rows where every named column is present."""
    return df.filter(reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in columns)))


def positive(df: DataFrame, column: str) -> DataFrame:
    """Keep rows with a value above 0; NULL goes too."""
    return df.filter(F.col(column) > 0)


def still_open(df: DataFrame, column: str = "cumulative_position") -> DataFrame:
    """Drop positions that were closed to exactly 0."""
    return df.filter(F.col(column) != 0)
