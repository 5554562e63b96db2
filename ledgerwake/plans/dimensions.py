"""Dimension tables. Inputs may be the feeds or anything built from them with all keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerwake.functions.scalar import stamp
from ledgerwake.operators.generators import date_spine
from ledgerwake.operators.sets import key_union
from ledgerwake.params import Params


def dim_account(trades: DataFrame, cash: DataFrame) -> DataFrame:
    return stamp(key_union("account_id", trades, cash), "created_at")


def dim_symbol(trades: DataFrame, prices: DataFrame) -> DataFrame:
    return stamp(key_union("symbol", trades, prices), "created_at")


def dim_date(spark: SparkSession, params: Params) -> DataFrame:
    return date_spine(spark, params.date_start, params.date_end)
