"""Day-grain building blocks. This is where the feeds shrink; everything later is small."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwake.functions.scalar import signed
from ledgerwake.operators import aggregates as agg
from ledgerwake.operators.windows import last_per_day, running, timeline
from ledgerwake.schemas import CASH_INFLOWS, CASH_OUTFLOWS


def signed_amount() -> Column:
    return signed(F.col("amount"), F.col("cash_type"), CASH_INFLOWS, CASH_OUTFLOWS)


def int_daily_prices(stg_prices: DataFrame, *arrival: str) -> DataFrame:
    """Close of each symbol and day.

    Without ``arrival`` there has to be one tick per symbol and instant. With it the input
    may be an unresolved log: of several ticks at one instant the last to arrive counts,
    which is the price the upsert would have kept, without paying for the upsert.
    """
    return last_per_day(
        stg_prices, ["symbol", "price_date"], ["price_timestamp", *arrival],
        "price", "close_price")


def int_cash_balances(stg_cash_events: DataFrame) -> DataFrame:
    """Net cash of each account and day, and the balance it leads to."""
    daily = agg.daily_change(stg_cash_events, ["account_id", "cash_date"], signed_amount())
    balance = running(F.sum, F.col("daily_change"), timeline(["account_id"], "cash_date"))
    return daily.select(
        "account_id", F.col("cash_date").alias("balance_date"), "daily_change",
        balance.alias("cash_balance"))


def int_trade_days(stg_trades: DataFrame) -> DataFrame:
    """Every total that positions, PnL and average cost need, from one pass over trades.

    Positions and PnL group trades by the same account, symbol and day. Taking all sums at
    once means the trade feed is scanned and shuffled once for both.
    """
    return stg_trades.groupBy("account_id", "symbol", "trade_date").agg(
        F.sum(agg.signed_quantity()).alias("daily_change"), *agg.side_totals())
