"""Fact tables. Rows exist only for days with activity; nothing is filled forward."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwake.functions.scalar import stamp
from ledgerwake.operators.aggregates import realized_gain
from ledgerwake.operators.joins import mark_to_market
from ledgerwake.operators.windows import running, timeline

HOLDING = ["account_id", "symbol"]


def fact_trades(stg_trades: DataFrame) -> DataFrame:
    return stg_trades.select(
        "trade_id", "account_id", "symbol", "side", "quantity", "price",
        (F.col("quantity") * F.col("price")).alias("trade_value"),
        "trade_timestamp", "trade_date", "event_version",
    )


def positions(trade_days: DataFrame) -> DataFrame:
    """Running position next to the day's totals."""
    line = timeline(HOLDING, "trade_date")
    return trade_days.withColumn(
        "cumulative_position", running(F.sum, F.col("daily_change"), line)
    ).withColumnRenamed("trade_date", "position_date")


def fact_positions_daily(trade_days: DataFrame) -> DataFrame:
    return stamp(
        positions(trade_days).select(
            "account_id", "symbol", "position_date", "daily_change", "cumulative_position"),
        "calculated_at",
    )


def fact_portfolio_value_daily(
    positions_daily: DataFrame, closes: DataFrame, cash_balances: DataFrame
) -> DataFrame:
    """Marked positions plus cash of each account and day; a missing side counts as 0.

    The full outer join of the two day series is written as union + sum: one exchange
    instead of three, map-side combine, and a filter on the account reaches both inputs.
    A NULL account matches nothing in a join, so there the two inputs are kept apart.
    """
    marked = mark_to_market(positions_daily, closes).select(
        "account_id", F.col("position_date").alias("value_date"),
        "position_value", F.lit(None).cast("double").alias("cash_balance"),
        F.lit("positions").alias("side"))
    cash = cash_balances.select(
        "account_id", F.col("balance_date").alias("value_date"),
        F.lit(None).cast("double").alias("position_value"), "cash_balance",
        F.lit("cash").alias("side"))
    unmatched = F.when(F.col("account_id").isNull(), F.col("side"))
    merged = marked.unionByName(cash).groupBy(
        "account_id", "value_date", unmatched.alias("side"),
    ).agg(
        F.coalesce(F.sum("position_value"), F.lit(0.0)).alias("positions_value"),
        F.coalesce(F.sum("cash_balance"), F.lit(0.0)).alias("cash_balance"),
    )
    return stamp(
        merged.select(
            "account_id", "value_date", "positions_value", "cash_balance",
            (F.col("positions_value") + F.col("cash_balance")).alias("total_value")),
        "calculated_at",
    )


def fact_pnl_daily(trade_days: DataFrame, closes: DataFrame) -> DataFrame:
    """Realized PnL merged with the open positions of the day."""
    return pnl_of(positions(trade_days), closes)


def pnl_of(positions_daily: DataFrame, closes: DataFrame) -> DataFrame:
    """PnL of positions that still have the totals of their day beside them.

    Sales and open positions come from the same account-symbol-day rows, so their full
    outer join needs no join: a row is a sale, an open priced position, or both. The
    symbol belongs to the open position and is NULL for a pure sale. A NULL account
    matches nothing in a join, so there a row that is both comes out as two.
    """
    priced = closes.select(
        "symbol", F.col("price_date").alias("position_date"), F.lit(True).alias("priced"))
    joined = positions_daily.join(priced, on=["symbol", "position_date"], how="left")
    sold = F.col("sell_quantity") > 0
    held = (F.col("cumulative_position") != 0) & F.col("priced").isNotNull()
    apart = F.col("account_id").isNull() & sold & held
    gain = F.when(sold, F.coalesce(realized_gain(), F.lit(0.0))).otherwise(0.0)

    def merged(symbol: Column, realized: Column) -> Column:
        return F.struct(
            "account_id",
            F.col("position_date").alias("pnl_date"),
            symbol.alias("symbol"),
            realized.alias("realized_pnl"),
            F.lit(0).alias("unrealized_pnl"),
            realized.alias("total_pnl"),
        )

    no_symbol = F.lit(None).cast("string")
    rows = F.when(
        apart, F.array(merged(no_symbol, gain), merged(F.col("symbol"), F.lit(0.0)))
    ).otherwise(F.array(merged(F.when(held, F.col("symbol")), gain)))
    return stamp(joined.filter(sold | held).select(F.inline(rows)), "calculated_at")
