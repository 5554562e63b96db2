"""Small hand-made inputs."""

from __future__ import annotations

import datetime as dt

from ledgerwake.schemas import RAW_CASH_SCHEMA, RAW_PRICES_SCHEMA, RAW_TRADES_SCHEMA


def day(n: int) -> dt.date:
    return dt.date(2024, 1, n)


def at(n: int, hour: int = 12, minute: int = 0) -> dt.datetime:
    return dt.datetime(2024, 1, n, hour, minute)


def trades(spark, *rows):
    """Rows of (id, account, symbol, side, quantity, price, timestamp)."""
    return spark.createDataFrame([(*row, "1.0", None) for row in rows], RAW_TRADES_SCHEMA)


def prices(spark, *rows):
    """Rows of (symbol, price, timestamp[, source])."""
    full = [(r[0], r[1], r[2], r[3] if len(r) > 3 else None, "1.0", None) for r in rows]
    return spark.createDataFrame(full, RAW_PRICES_SCHEMA)


def cash(spark, *rows):
    """Rows of (id, account, amount, type, timestamp)."""
    return spark.createDataFrame([(*row, None, "1.0", None) for row in rows], RAW_CASH_SCHEMA)


def rows(df, *columns):
    """Sorted plain tuples of the named columns."""
    found = [tuple(r) for r in df.select(*columns).collect()]
    return sorted(found, key=lambda r: tuple((v is None, v if v is not None else 0) for v in r))
