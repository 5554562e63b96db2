"""Time-ordered operators per entity.

Run these at one row per entity and day, never at trade or tick grain: a window partition
is then bounded by the number of calendar days, however hot the entity is in the feed.
Columns built from the same ``timeline`` share one exchange and one sort.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ledgerwake.functions.scalar import log_growth


def timeline(entity: Sequence[str], day: str) -> WindowSpec:
    return Window.partitionBy(*entity).orderBy(day)


def running(fn: Callable[[Column], Column], value: Column, line: WindowSpec) -> Column:
    """``fn`` over every row from the entity's first up to this one."""
    return fn(value).over(line.rowsBetween(Window.unboundedPreceding, Window.currentRow))


def rolling(fn: Callable[[Column], Column], value: Column, rows: int, line: WindowSpec) -> Column:
    """``fn`` over the last ``rows`` rows, this one included."""
    return fn(value).over(line.rowsBetween(1 - rows, Window.currentRow))


def previous(value: Column, line: WindowSpec) -> Column:
    return F.lag(value, 1).over(line)


def compound(rate: Column, line: WindowSpec) -> Column:
    """Growth since the first row: the product of ``1 + rate``, minus 1."""
    return F.exp(running(F.sum, log_growth(rate), line)) - 1


def last_per_day(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str
) -> DataFrame:
    """The ``value`` of the latest row per key, latest by ``order``.

    Either form keeps one row per key and task before the shuffle, so a key with a third of
    all rows is no heavier than any other. One order column fits a hash aggregate; several
    would make ``max_by`` sort, where ``row_number`` with its group limit is faster.
    """
    if len(order) == 1:
        return df.groupBy(*keys).agg(F.max_by(value, order[0]).alias(name))
    newest = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    return (
        df.withColumn("_nth", F.row_number().over(newest)).filter(F.col("_nth") == 1)
        .select(*keys, F.col(value).alias(name))
    )
