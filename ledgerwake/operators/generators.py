"""Row generators."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def spine_between(bounds: DataFrame, start: str, end: str) -> DataFrame:
    """Every day from ``start`` up to, not including, ``end`` for each row of ``bounds``."""
    # An empty span is filtered out, but the optimizer may evaluate its sequence first.
    last = F.greatest(F.col(start), F.date_sub(F.col(end), 1))
    days = F.sequence(F.col(start), last, F.expr("INTERVAL 1 DAY"))
    return bounds.filter(F.col(start) < F.col(end)).select(F.explode(days).alias("date_day"))


def date_spine(spark: SparkSession, start: dt.date, end: dt.date | None = None) -> DataFrame:
    """Calendar from ``start`` to ``end``; no ``end`` means one year from today."""
    last = F.add_months(F.current_date(), 12) if end is None else F.lit(end)
    bounds = spark.range(1).select(F.lit(start).alias("first_day"), last.alias("last_day"))
    return spine_between(bounds, "first_day", "last_day")
