"""Column expressions shared by the models. All of them stay inside codegen."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Milliseconds of 0001-01-01 and of the last instant of 9999; outside of them a wire
# timestamp cannot be a SQL timestamp.
MIN_MILLIS = -62_135_596_800_000
MAX_MILLIS = 253_402_300_799_999


def signed(value: Column, kind: Column, plus: Iterable[str], minus: Iterable[str]) -> Column:
    """``value`` for kinds in ``plus``, its negation for ``minus``, NULL for anything else."""
    return F.when(kind.isin(*plus), value).when(kind.isin(*minus), -value)


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient that is NULL, not an error, when the denominator is 0."""
    return numerator / F.nullif(denominator, F.lit(0.0))


def rel_change(current: Column, base: Column, otherwise: float | None = None) -> Column:
    """Change relative to a positive base; ``otherwise`` when the base is not positive."""
    change = F.when(base > 0, (current - base) / base)
    return change if otherwise is None else change.otherwise(F.lit(otherwise))


def log_growth(rate: Column) -> Column:
    """``ln(1 + rate)``, NULL once the whole base is lost (rate <= -1)."""
    return F.when(rate > -1, F.log(rate + 1))


def annualize(volatility: Column, periods: int) -> Column:
    return volatility * F.sqrt(F.lit(float(periods)))


def pct(ratio: Column) -> Column:
    return ratio * 100


def to_day(moment: Column) -> Column:
    return moment.cast("date")


def from_millis(millis: Column) -> Column:
    """Epoch milliseconds to a zone-free timestamp, NULL when out of range.

    Adding an interval to a literal epoch does not look at the session time zone, so the
    result is the same on every cluster.
    """
    epoch = F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")
    in_range = F.when(millis.between(MIN_MILLIS, MAX_MILLIS), millis)
    return epoch + in_range * F.expr("INTERVAL '0.001' SECOND")


def to_millis(moment: Column) -> Column:
    """Inverse of :func:`from_millis`, rounded down.

    Built from calendar fields, since ``timestamp_diff`` would go through the session zone
    and move times that its clock skips.
    """
    minutes = F.unix_date(moment.cast("date")).cast("bigint") * 1440 \
        + F.hour(moment) * 60 + F.minute(moment)
    millis = F.floor(F.extract(F.lit("SECOND"), moment) * 1000).cast("bigint")
    return minutes * 60_000 + millis


def stamp(df: DataFrame, name: str) -> DataFrame:
    """Audit column: when this run computed the row."""
    return df.withColumn(name, F.current_timestamp())
