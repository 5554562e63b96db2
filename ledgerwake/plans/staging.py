"""Clean views over the landing tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwake.functions.scalar import to_day
from ledgerwake.operators.filters import positive, require


def stg_trades(raw_trades: DataFrame) -> DataFrame:
    return require(raw_trades, "trade_id", "timestamp").select(
        "trade_id",
        "account_id",
        "symbol",
        F.upper("side").alias("side"),
        "quantity",
        "price",
        F.col("timestamp").alias("trade_timestamp"),
        to_day(F.col("timestamp")).alias("trade_date"),
        "event_version",
        "ingestion_time",
    )


def stg_prices(raw_prices: DataFrame, *carried: str) -> DataFrame:
    """``carried`` keeps extra columns, such as the arrival order of an unresolved log."""
    return positive(require(raw_prices, "symbol", "timestamp"), "price").select(
        "symbol",
        "price",
        F.col("timestamp").alias("price_timestamp"),
        to_day(F.col("timestamp")).alias("price_date"),
        F.coalesce("source", F.lit("unknown")).alias("source"),
        "event_version",
        "ingestion_time",
        *carried,
    )


def stg_cash_events(raw_cash_events: DataFrame) -> DataFrame:
    return positive(require(raw_cash_events, "event_id", "timestamp"), "amount").select(
        "event_id",
        "account_id",
        "amount",
        F.upper("type").alias("cash_type"),
        F.col("timestamp").alias("cash_timestamp"),
        to_day(F.col("timestamp")).alias("cash_date"),
        "description",
        "event_version",
        "ingestion_time",
    )
