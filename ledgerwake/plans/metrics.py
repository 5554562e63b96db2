"""Daily performance and risk series per account.

All series hang off one ``timeline`` per account, so a query that uses several of them
still needs one exchange and one sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, WindowSpec
from pyspark.sql import functions as F

from ledgerwake.functions.scalar import annualize, pct, rel_change, stamp
from ledgerwake.operators.windows import compound, previous, rolling, running, timeline
from ledgerwake.params import Params

DAY = ["account_id", "value_date"]


def account_line() -> WindowSpec:
    return timeline(["account_id"], "value_date")


def with_drawdown(values: DataFrame) -> DataFrame:
    """Add the drop from the running peak and the worst drop so far."""
    peak = running(F.max, F.col("total_value"), account_line())
    return (
        values.withColumn("peak_value", peak)
        .withColumn("drawdown", rel_change(F.col("total_value"), F.col("peak_value"), 0.0))
        .withColumn("max_drawdown", running(F.min, F.col("drawdown"), account_line()))
    )


def with_return(values: DataFrame) -> DataFrame:
    """Add the return over the account's previous row; its first row goes away."""
    return (
        values.withColumn("previous_value", previous(F.col("total_value"), account_line()))
        .filter(F.col("previous_value").isNotNull())
        .withColumn("daily_return", rel_change(F.col("total_value"), F.col("previous_value")))
    )


def with_cumulative(returns: DataFrame) -> DataFrame:
    """Add the compounded return. Only defined where the daily return is."""
    growth = compound(F.col("daily_return"), account_line())
    return returns.withColumn(
        "cumulative_return", F.when(F.col("daily_return").isNotNull(), growth))


def with_volatility(returns: DataFrame, params: Params) -> DataFrame:
    """Add the rolling sample deviation. A NULL return still takes up a row of the frame."""
    spread = rolling(F.stddev_samp, F.col("daily_return"), params.volatility_rows, account_line())
    return returns.withColumn("volatility_30d", spread).withColumn(
        "annualized_volatility", annualize(F.col("volatility_30d"), params.trading_days))


def daily_returns(values: DataFrame) -> DataFrame:
    return stamp(
        with_return(values).select(
            *DAY, "daily_return", pct(F.col("daily_return")).alias("daily_return_pct")),
        "calculated_at",
    )


def cumulative_returns(returns: DataFrame) -> DataFrame:
    known = returns.filter(F.col("daily_return").isNotNull())
    return stamp(
        with_cumulative(known).select(
            *DAY, "cumulative_return",
            pct(F.col("cumulative_return")).alias("cumulative_return_pct")),
        "calculated_at",
    )


def drawdown(values: DataFrame) -> DataFrame:
    return stamp(
        with_drawdown(values).select(
            *DAY,
            "drawdown", pct(F.col("drawdown")).alias("drawdown_pct"),
            "max_drawdown", pct(F.col("max_drawdown")).alias("max_drawdown_pct")),
        "calculated_at",
    )


def rolling_volatility(returns: DataFrame, params: Params) -> DataFrame:
    known = with_volatility(returns, params).filter(F.col("volatility_30d").isNotNull())
    return stamp(
        known.select(
            *DAY,
            "volatility_30d", pct(F.col("volatility_30d")).alias("volatility_30d_pct"),
            "annualized_volatility",
            pct(F.col("annualized_volatility")).alias("annualized_volatility_pct")),
        "calculated_at",
    )


def performance(values: DataFrame, params: Params) -> DataFrame:
    """Every series side by side, for reports that would otherwise join the views.

    One row per day with a previous value. Columns are NULL where the single-series model
    has no row.
    """
    base = values.select(*DAY, "total_value")
    series = with_cumulative(with_return(with_drawdown(base)))
    return with_volatility(series, params)
