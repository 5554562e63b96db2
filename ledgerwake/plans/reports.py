"""Ready-made reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwake.functions.scalar import pct, safe_ratio
from ledgerwake.operators.filters import still_open
from ledgerwake.operators.joins import mark_to_market
from ledgerwake.operators.windows import running, timeline
from ledgerwake.plans.facts import HOLDING, positions
from ledgerwake.plans.metrics import DAY, performance
from ledgerwake.params import Params

EXACT = "decimal(28,6)"


def value_history(values: DataFrame, account: str, n: int = 30) -> DataFrame:
    """Newest ``n`` portfolio values of one account."""
    return (
        values.filter(F.col("account_id") == account)
        .select("account_id", "value_date", "total_value", "cash_balance", "positions_value")
        .orderBy(F.desc("value_date")).limit(n)
    )


def holdings(trade_days: DataFrame, closes: DataFrame) -> DataFrame:
    """Open holdings with average cost and unrealized PnL, best first.

    The average cost covers all buys so far and is NULL before the first one. Bought value is
    added up as decimals, whose sum is the same in every order.
    """
    line = timeline(HOLDING, "position_date")
    bought = running(F.sum, F.col("buy_value").cast(EXACT), line).cast("double")
    costed = positions(trade_days).withColumn(
        "avg_cost_per_share",
        safe_ratio(bought, running(F.sum, F.col("buy_quantity"), line)))
    gain = F.col("cumulative_position") * (F.col("close_price") - F.col("avg_cost_per_share"))
    return (
        mark_to_market(costed, closes)
        .select("account_id", "symbol", "position_date", "cumulative_position",
                "avg_cost_per_share", gain.alias("unrealized_pnl"))
        .orderBy(F.desc_nulls_last("unrealized_pnl"))
    )


def open_positions(positions_daily: DataFrame) -> DataFrame:
    """Listing of all open positions, largest first."""
    return still_open(positions_daily).select(*HOLDING, "position_date", "cumulative_position") \
        .orderBy(F.desc_nulls_last("cumulative_position"))


def returns_report(returns: DataFrame, cumulative: DataFrame, n: int = 30) -> DataFrame:
    """Daily next to cumulative return; accounts in order, newest day first."""
    return (
        returns.select(*DAY, "daily_return_pct")
        .join(cumulative.select(*DAY, "cumulative_return_pct"), on=DAY, how="inner")
        .orderBy("account_id", F.desc("value_date")).limit(n)
    )


def risk_summary(
    cumulative: DataFrame, drawdowns: DataFrame, volatility: DataFrame
) -> DataFrame:
    """Best cumulative return, worst drawdown and mean volatility of each account."""
    return (
        cumulative.select(*DAY, "cumulative_return_pct")
        .join(drawdowns.select(*DAY, "max_drawdown_pct"), on=DAY, how="left")
        .join(volatility.select(*DAY, "annualized_volatility_pct"), on=DAY, how="left")
        .groupBy("account_id").agg(
            F.max("cumulative_return_pct").alias("total_return_pct"),
            F.min("max_drawdown_pct").alias("max_drawdown_pct"),
            F.avg("annualized_volatility_pct").alias("avg_volatility_pct"))
    )


def returns_report_from_values(values: DataFrame, params: Params) -> DataFrame:
    """Same rows as :func:`returns_report`, straight from the fact and without a join."""
    known = performance(values, params).filter(
        F.col("daily_return").isNotNull() & F.col("account_id").isNotNull())
    return known.select(
        *DAY,
        pct(F.col("daily_return")).alias("daily_return_pct"),
        pct(F.col("cumulative_return")).alias("cumulative_return_pct"),
    ).orderBy("account_id", F.desc("value_date")).limit(params.report_rows)


def risk_summary_from_values(values: DataFrame, params: Params) -> DataFrame:
    """Same rows as :func:`risk_summary`, straight from the fact: one exchange, no join."""
    known = performance(values, params).filter(F.col("daily_return").isNotNull())
    # A NULL account finds no partner in the left joins of the view form.
    joined = F.col("account_id").isNotNull()
    return known.groupBy("account_id").agg(
        F.max(pct(F.col("cumulative_return"))).alias("total_return_pct"),
        F.min(F.when(joined, pct(F.col("max_drawdown")))).alias("max_drawdown_pct"),
        F.avg(F.when(joined, pct(F.col("annualized_volatility")))).alias("avg_volatility_pct"))


def account_values(values: DataFrame) -> DataFrame:
    """Every account value, ordered for reading."""
    return values.select(
        "account_id", "value_date", "total_value", "cash_balance", "positions_value",
    ).orderBy(*DAY)


def return_listing(returns: DataFrame) -> DataFrame:
    return returns.select(*DAY, "daily_return_pct").orderBy(*DAY)
