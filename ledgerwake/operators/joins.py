"""Joins between day-grain tables. No hints: sizes decide, at run time, through AQE."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwake.operators.filters import still_open


def mark_to_market(positions: DataFrame, closes: DataFrame) -> DataFrame:
    """Open positions valued at the close of the same day.

    A holding without a close on that day drops out.
    """
    return (
        still_open(positions)
        .join(closes.withColumnRenamed("price_date", "position_date"),
              on=["symbol", "position_date"], how="inner")
        .withColumn("position_value", F.col("cumulative_position") * F.col("close_price"))
    )


def outer_merge(
    left: DataFrame, right: DataFrame, keys: Sequence[str], fill: float = 0.0
) -> DataFrame:
    """Full outer join with coalesced keys; a missing side counts as ``fill``."""
    values = [c for c in left.columns + right.columns if c not in keys]
    return left.join(right, on=list(keys), how="full_outer").fillna(fill, subset=values)


def merge_pnl(realized: DataFrame, marked: DataFrame) -> DataFrame:
    """Full outer join of realized PnL and open positions.

    Account and day are taken from whichever side exists. The symbol comes from the open
    position alone, so a sale that closed the position has no symbol.
    """
    sale, held = realized.alias("sale"), marked.alias("held")
    matched = (
        (F.col("sale.account_id") == F.col("held.account_id"))
        & (F.col("sale.symbol") == F.col("held.symbol"))
        & (F.col("sale.pnl_date") == F.col("held.position_date"))
    )
    gain = F.coalesce(F.col("sale.realized_pnl"), F.lit(0.0))
    return sale.join(held, matched, "full_outer").select(
        F.coalesce("sale.account_id", "held.account_id").alias("account_id"),
        F.coalesce("sale.pnl_date", "held.position_date").alias("pnl_date"),
        F.col("held.symbol").alias("symbol"),
        gain.alias("realized_pnl"),
        F.lit(0).alias("unrealized_pnl"),
        gain.alias("total_pnl"),
    )
