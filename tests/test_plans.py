"""Shapes of the physical plans that scale depends on."""

from __future__ import annotations

import inspect
import pkgutil
import importlib
import re

import pytest
from pyspark.sql import functions as F

import ledgerwake
from ledgerwake.params import Params
from ledgerwake.plans import facts, intermediate, metrics, reports, staging
from ledgerwake.sources import market

SF = "/root/testdata/sf0.001"


@pytest.fixture
def no_aqe(spark):
    """Static plans, so that every exchange shows."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df) -> int:
    return len(re.findall(r"Exchange (?:hash|range|single)", plan(df), re.IGNORECASE))


@pytest.fixture
def values(spark, tmp_path):
    path = str(tmp_path / "values")
    spark.createDataFrame([], "account_id string, value_date date, total_value double, "
                              "cash_balance double, positions_value double").write.parquet(path)
    return spark.read.parquet(path)


def test_all_metrics_of_a_report_share_one_shuffle_and_sort(no_aqe, values):
    for df in (metrics.performance(values, Params()),
               reports.risk_summary_from_values(values, Params()),
               metrics.drawdown(values)):
        assert shuffles(df) == 1
        assert plan(df).count("Sort [") == 1


def test_account_filter_reaches_the_scan_of_the_fact(no_aqe, values):
    text = plan(reports.value_history(values, "ACC001"))
    assert "PushedFilters: [IsNotNull(account_id), EqualTo(account_id,ACC001)]" in text
    assert "TakeOrderedAndProject" in text


def test_account_filter_reaches_both_sides_of_the_portfolio_value(no_aqe):
    positions = no_aqe.createDataFrame([], "account_id string, symbol string, "
                                           "position_date date, cumulative_position double")
    closes = no_aqe.createDataFrame([], "symbol string, price_date date, close_price double")
    balances = no_aqe.createDataFrame([], "account_id string, balance_date date, "
                                          "cash_balance double")
    value = facts.fact_portfolio_value_daily(positions, closes, balances)
    optimized = value.filter("account_id = 'A'")._jdf.queryExecution().optimizedPlan().toString()
    below_union = optimized[optimized.index("Union"):]
    assert below_union.count("= A)") == 2


def test_staging_filters_and_columns_reach_the_scan(no_aqe, tmp_path):
    path = str(tmp_path / "raw_prices")
    market.raw_prices(no_aqe, SF).write.parquet(path)
    closes = intermediate.int_daily_prices(staging.stg_prices(no_aqe.read.parquet(path)))
    text = plan(closes)
    assert "GreaterThan(price,0.0)" in text
    assert "ReadSchema: struct<symbol:string,price:double,timestamp:timestamp_ntz>" in text
    assert "SortAggregate" not in text
    assert shuffles(closes) == 1


def test_close_of_a_log_keeps_one_row_per_group_before_the_shuffle(no_aqe):
    log = staging.stg_prices(market.raw_price_log(no_aqe, SF), "seq")
    text = plan(intermediate.int_daily_prices(log, "seq"))
    exchange = text.index("Exchange hashpartitioning(symbol")
    assert "WindowGroupLimit" in text[exchange:] and "Partial" in text[exchange:]


def test_trade_days_reduce_before_they_shuffle_and_skip_unused_columns(no_aqe):
    days = intermediate.int_trade_days(staging.stg_trades(market.raw_trades(no_aqe, SF)))
    text = plan(facts.fact_positions_daily(days))
    assert "partial_sum" in text
    assert "buy_value" not in text and "l_discount" not in text


def test_pnl_scans_trades_once(no_aqe):
    days = intermediate.int_trade_days(staging.stg_trades(market.raw_trades(no_aqe, SF)))
    closes = no_aqe.createDataFrame([], "symbol string, price_date date, close_price double")
    text = plan(facts.fact_pnl_daily(days, closes))
    assert text.count("lineitem.parquet") == 1
    assert "FullOuter" not in text


def test_no_python_runs_in_the_executors():
    """Built-in expressions only: no UDF, RDD, collect or local checkpoint in the core."""
    banned = re.compile(
        r"\.rdd\b|\budf\(|pandas_udf|mapInPandas|applyInPandas|\.collect\(|toPandas|"
        r"localCheckpoint|crossJoin|toLocalIterator")
    for module in pkgutil.walk_packages(ledgerwake.__path__, "ledgerwake."):
        if module.name.startswith("ledgerwake.llm"):
            continue
        source = inspect.getsource(importlib.import_module(module.name))
        assert not banned.search(source), module.name


def test_a_hot_account_and_symbol_shrink_to_days(spark):
    """Nine tenths of all trades in one account, symbol and day meet as one row per task."""
    hot = spark.range(90_000).select(
        F.lit("HOT").alias("account_id"), F.lit("X").alias("symbol"),
        F.lit("BUY").alias("side"), F.lit(1.0).alias("quantity"), F.lit(2.0).alias("price"),
        F.to_date(F.lit("2024-01-01")).alias("trade_date"))
    cold = spark.range(10_000).select(
        F.concat(F.lit("A"), F.col("id") % 100).alias("account_id"), F.lit("X").alias("symbol"),
        F.lit("SELL").alias("side"), F.lit(1.0).alias("quantity"), F.lit(2.0).alias("price"),
        F.to_date(F.lit("2024-01-02")).alias("trade_date"))
    found = facts.positions(intermediate.int_trade_days(hot.unionByName(cold)))
    assert found.count() == 101
    assert found.filter("account_id = 'HOT'").first().cumulative_position == 90_000
