"""Grouped reductions. Each is a partial + final hash aggregate.

Grouping is always by entity *and* day, so a hot account or symbol is first reduced on
the map side to one row per day and only then shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwake.functions.scalar import safe_ratio, signed
from ledgerwake.operators.sets import union_all


def signed_quantity() -> Column:
    return signed(F.col("quantity"), F.col("side"), ["BUY"], ["SELL"])


def daily_change(df: DataFrame, keys: Sequence[str], value: Column) -> DataFrame:
    """Net movement per key, where ``keys`` ends in the day column."""
    return df.groupBy(*keys).agg(F.sum(value).alias("daily_change"))


def side_totals() -> list[Column]:
    """Value and quantity bought and sold. A missing side counts as 0."""
    value = F.col("quantity") * F.col("price")
    quantity = F.col("quantity")
    return [
        F.sum(F.when(F.col("side") == side, measure).otherwise(0.0)).alias(name)
        for side, measure, name in (
            ("BUY", value, "buy_value"),
            ("BUY", quantity, "buy_quantity"),
            ("SELL", value, "sell_value"),
            ("SELL", quantity, "sell_quantity"),
        )
    ]


def buy_sell_totals(trades: DataFrame) -> DataFrame:
    return trades.groupBy("account_id", "symbol", "trade_date").agg(*side_totals())


def realized_gain() -> Column:
    """Sales minus their cost at the average price of the buys of the same day."""
    cost = safe_ratio(F.col("buy_value"), F.col("buy_quantity"))
    return F.col("sell_value") - F.col("sell_quantity") * cost


def realized_pnl(totals: DataFrame) -> DataFrame:
    """Realized PnL of every account, symbol and day that sold something."""
    return totals.filter(F.col("sell_quantity") > 0).select(
        "account_id", "symbol", F.col("trade_date").alias("pnl_date"),
        realized_gain().alias("realized_pnl"),
    )


def account_value(marked: DataFrame) -> DataFrame:
    """Value of all marked positions of an account on a day."""
    return marked.groupBy("account_id", F.col("position_date").alias("value_date")).agg(
        F.sum("position_value").alias("total_position_value")
    )


def distinct_keys(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its row count."""
    return union_all(
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items())
