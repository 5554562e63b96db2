"""Hand-computed cases for the semantics of every model."""

from __future__ import annotations

import math
import statistics

import pytest
from pyspark.sql import functions as F

from ledgerwake.functions import scalar
from ledgerwake.operators import aggregates as agg
from ledgerwake.operators import joins
from ledgerwake.operators.generators import date_spine
from ledgerwake.params import Params
from ledgerwake.plans import intermediate, metrics, pipeline, reports, staging
from tests.helpers import at, cash, day, prices, rows, trades


def models(spark, t=(), p=(), c=()):
    raw = {
        "raw_trades": trades(spark, *t),
        "raw_prices": prices(spark, *p),
        "raw_cash_events": cash(spark, *c),
    }
    return pipeline.Models(spark, raw, Params(date_start=day(1), date_end=day(4)))


def values_frame(spark, *numbers, account="A"):
    data = [(account, day(i + 1), float(v)) for i, v in enumerate(numbers)]
    return spark.createDataFrame(data, "account_id string, value_date date, total_value double")


def test_staging_cleans_each_feed(spark):
    m = models(
        spark,
        t=[("t1", "A", "X", "buy", 1.0, 2.0, at(1)), (None, "A", "X", "BUY", 1.0, 2.0, at(1)),
           ("t2", "A", "X", "Sell", -1.0, 2.0, at(2)), ("t3", "A", "X", "BUY", 1.0, 2.0, None)],
        p=[("X", 1.0, at(1)), ("X", 0.0, at(2)), ("X", None, at(3)), (None, 1.0, at(1)),
           ("X", 2.0, at(3), "feed")],
        c=[("c1", "A", 5.0, "deposit", at(1)), ("c2", "A", 0.0, "DEPOSIT", at(1)),
           ("c3", "A", -1.0, "DEPOSIT", at(1)), (None, "A", 1.0, "DEPOSIT", at(1))],
    )
    assert rows(m["stg_trades"], "trade_id", "side", "trade_date") == [
        ("t1", "BUY", day(1)), ("t2", "SELL", day(2))]
    assert rows(m["stg_prices"], "price", "price_date", "source") == [
        (1.0, day(1), "unknown"), (2.0, day(3), "feed")]
    assert rows(m["stg_cash_events"], "event_id", "cash_type") == [("c1", "DEPOSIT")]


def test_positions_are_sparse_running_and_may_be_short(spark):
    m = models(spark, t=[
        ("t1", "A", "X", "BUY", 10.0, 1.0, at(1)), ("t2", "A", "X", "SELL", 4.0, 1.0, at(1)),
        ("t3", "A", "X", "SELL", 9.0, 1.0, at(5)), ("t4", "A", "Y", "BUY", 1.0, 1.0, at(3))])
    assert rows(m["fact_positions_daily"], "symbol", "position_date", "daily_change",
                "cumulative_position") == [
        ("X", day(1), 6.0, 6.0), ("X", day(5), -9.0, -3.0), ("Y", day(3), 1.0, 1.0)]


def test_unknown_side_and_type_have_no_sign(spark):
    m = models(spark,
               t=[("t1", "A", "X", "HOLD", 10.0, 1.0, at(1))],
               c=[("c1", "A", 10.0, "FEE", at(1)), ("c2", "A", 3.0, "WITHDRAWAL", at(1))])
    assert rows(m["fact_positions_daily"], "daily_change", "cumulative_position") == [(None, None)]
    assert rows(m["int_cash_balances"], "daily_change", "cash_balance") == [(-3.0, -3.0)]


def test_close_is_the_last_tick_of_the_day(spark):
    m = models(spark, p=[("X", 1.0, at(1, 9)), ("X", 2.0, at(1, 17)), ("X", 3.0, at(1, 12)),
                         ("X", 9.0, at(2, 1))])
    assert rows(m["int_daily_prices"], "symbol", "price_date", "close_price") == [
        ("X", day(1), 2.0), ("X", day(2), 9.0)]


def test_close_of_a_log_uses_arrival_for_ties(spark):
    log = prices(spark, ("X", 1.0, at(1, 17)), ("X", 2.0, at(1, 17)), ("X", 3.0, at(1, 9)))
    log = log.withColumn("seq", 10 - F.col("price"))
    closes = intermediate.int_daily_prices(staging.stg_prices(log, "seq"), "seq")
    assert rows(closes, "close_price") == [(1.0,)]


def test_portfolio_value_counts_a_missing_side_as_zero(spark):
    m = models(
        spark,
        t=[("t1", "A", "X", "BUY", 10.0, 1.0, at(1)), ("t2", "A", "X", "BUY", 5.0, 1.0, at(3)),
           ("t3", "A", "Y", "BUY", 7.0, 1.0, at(1))],
        p=[("X", 2.0, at(1)), ("X", 3.0, at(2)), ("X", 4.0, at(3))],
        c=[("c1", "A", 100.0, "DEPOSIT", at(1)), ("c2", "A", 30.0, "WITHDRAWAL", at(2))],
    )
    # Y has no price on day 1, X is not traded on day 2, no cash moves on day 3.
    assert rows(m["fact_portfolio_value_daily"], "value_date", "positions_value",
                "cash_balance", "total_value") == [
        (day(1), 20.0, 100.0, 120.0), (day(2), 0.0, 70.0, 70.0), (day(3), 60.0, 0.0, 60.0)]


def test_portfolio_value_equals_the_full_outer_join(spark):
    m = models(
        spark,
        t=[("t1", "A", "X", "BUY", 10.0, 1.0, at(1)), ("t2", None, "X", "BUY", 5.0, 1.0, at(1)),
           ("t3", "B", "X", "BUY", 5.0, 1.0, at(2))],
        p=[("X", 2.0, at(1)), ("X", 3.0, at(2))],
        c=[("c1", "A", 1.0, "DEPOSIT", at(1)), ("c2", None, 2.0, "DEPOSIT", at(1)),
           ("c3", "C", 3.0, "DEPOSIT", at(2))],
    )
    marked = joins.mark_to_market(m["fact_positions_daily"], m["int_daily_prices"])
    balances = m["int_cash_balances"].select(
        "account_id", F.col("balance_date").alias("value_date"), "cash_balance")
    joined = joins.outer_merge(agg.account_value(marked), balances, ["account_id", "value_date"])
    assert rows(m["fact_portfolio_value_daily"], "account_id", "value_date", "positions_value",
                "cash_balance") == rows(
        joined, "account_id", "value_date", "total_position_value", "cash_balance")
    assert m["fact_portfolio_value_daily"].filter("account_id is null").count() == 2


def test_closed_positions_leave_the_valuation_only(spark):
    m = models(spark,
               t=[("t1", "A", "X", "BUY", 3.0, 1.0, at(1)),
                  ("t2", "A", "X", "SELL", 3.0, 1.0, at(2))],
               p=[("X", 5.0, at(1)), ("X", 5.0, at(2))])
    assert m["fact_positions_daily"].count() == 2
    assert rows(m["fact_portfolio_value_daily"], "value_date") == [(day(1),)]


def test_pnl_uses_buys_of_the_same_day_and_symbol_of_open_positions(spark):
    t = [
        # Day 1: buy 10 at 2, sell 4 at 5 -> 20 - 4 * 2 = 12, position stays open.
        ("t1", "A", "X", "BUY", 10.0, 2.0, at(1)), ("t2", "A", "X", "SELL", 4.0, 5.0, at(1)),
        # Day 2: sell without a buy -> no cost basis, 0; closes the position.
        ("t3", "A", "X", "SELL", 6.0, 5.0, at(2)),
        # Day 3: buy only.
        ("t4", "A", "X", "BUY", 1.0, 5.0, at(3)),
        # Unpriced symbol: the sale is there, its symbol is not; the buy has no row at all.
        ("t5", "A", "Y", "BUY", 2.0, 1.0, at(1)), ("t6", "A", "Y", "SELL", 1.0, 4.0, at(1)),
        ("t7", "A", "Y", "BUY", 2.0, 1.0, at(2)),
        # No account: sale and open position do not match each other.
        ("t8", None, "X", "BUY", 2.0, 1.0, at(1)), ("t9", None, "X", "SELL", 1.0, 6.0, at(1)),
    ]
    m = models(spark, t=t, p=[("X", 1.0, at(n)) for n in (1, 2, 3)])
    expected = [
        (day(1), "X", 0.0, 0, 0.0), (day(1), "X", 12.0, 0, 12.0),
        (day(1), None, 3.0, 0, 3.0), (day(1), None, 5.0, 0, 5.0),
        (day(2), None, 0.0, 0, 0.0), (day(3), "X", 0.0, 0, 0.0)]
    columns = ["pnl_date", "symbol", "realized_pnl", "unrealized_pnl", "total_pnl"]
    assert rows(m["fact_pnl_daily"], *columns) == expected
    assert dict(m["fact_pnl_daily"].dtypes)["unrealized_pnl"] == "int"
    marked = joins.mark_to_market(m["fact_positions_daily"], m["int_daily_prices"])
    sales = agg.realized_pnl(agg.buy_sell_totals(m["stg_trades"]))
    assert rows(joins.merge_pnl(sales, marked), *columns) == expected


def test_return_needs_a_positive_previous_value(spark):
    got = metrics.daily_returns(values_frame(spark, 100, 110, 0, 50, -10, 20))
    found = rows(got, "value_date", "daily_return", "daily_return_pct")
    assert [r[0] for r in found] == [day(n) for n in (2, 3, 4, 5, 6)]
    assert [r[1] for r in found] == pytest.approx([0.1, -1.0, None, -1.2, None])
    assert found[0][2] == pytest.approx(10.0)


def test_compounding_skips_null_and_total_losses(spark):
    values = values_frame(spark, 100, 110, 0, 50, 75)
    got = metrics.cumulative_returns(metrics.daily_returns(values))
    found = rows(got, "value_date", "cumulative_return")
    assert [r[0] for r in found] == [day(2), day(3), day(5)]
    assert [r[1] for r in found] == pytest.approx([0.1, 0.1, 1.1 * 1.5 - 1])


def test_compounding_is_null_until_a_factor_exists(spark):
    got = metrics.cumulative_returns(metrics.daily_returns(values_frame(spark, 10, 0)))
    assert rows(got, "cumulative_return") == [(None,)]


def test_drawdown_is_zero_without_a_positive_peak_and_can_pass_minus_one(spark):
    got = metrics.drawdown(values_frame(spark, -5, 100, 50, 120, -60))
    found = rows(got, "value_date", "drawdown", "max_drawdown")
    assert [r[1] for r in found] == pytest.approx([0.0, 0.0, -0.5, 0.0, -1.5])
    assert [r[2] for r in found] == pytest.approx([0.0, 0.0, -0.5, -0.5, -1.5])


def test_volatility_frame_is_rows_and_null_returns_take_a_slot(spark):
    data = [("A", day(i + 1), r) for i, r in enumerate([0.1, None, 0.3, 0.5])]
    returns = spark.createDataFrame(
        data, "account_id string, value_date date, daily_return double")
    got = metrics.rolling_volatility(returns, Params(volatility_rows=3))
    found = rows(got, "value_date", "volatility_30d", "annualized_volatility")
    assert [r[0] for r in found] == [day(3), day(4)]
    first, second = statistics.stdev([0.1, 0.3]), statistics.stdev([0.3, 0.5])
    assert [r[1] for r in found] == pytest.approx([first, second])
    assert found[0][2] == pytest.approx(first * math.sqrt(252))


def test_volatility_covers_thirty_rows(spark):
    data = [("A", i, float(i * i % 17)) for i in range(40)]
    returns = spark.createDataFrame(data, "account_id string, n int, daily_return double") \
        .withColumn("value_date", F.expr("date_add(date'2024-01-01', n * 3)"))
    last = metrics.rolling_volatility(returns, Params()).orderBy(F.desc("value_date")).first()
    assert last.volatility_30d == pytest.approx(statistics.stdev(r[2] for r in data[10:]))


def test_fused_reports_equal_the_joined_views(spark):
    one = values_frame(spark, 100, 110, 0, 50, 75, -20, 60, 90)
    values = one.unionByName(values_frame(spark, 5, 6, 7, account="B")) \
        .unionByName(values_frame(spark, 8, 6, 9, account=None))
    returns = metrics.daily_returns(values)
    cumulative = metrics.cumulative_returns(returns)
    params = Params()
    joined = reports.risk_summary(
        cumulative, metrics.drawdown(values), metrics.rolling_volatility(returns, params))
    columns = ["account_id", "total_return_pct", "max_drawdown_pct", "avg_volatility_pct"]
    assert rows(reports.risk_summary_from_values(values, params), *columns) == rows(
        joined, *columns)
    listed = reports.returns_report(returns, cumulative)
    assert rows(reports.returns_report_from_values(values, params), *listed.columns) == rows(
        listed, *listed.columns)


def test_value_history_takes_the_newest_rows_of_one_account(spark):
    values = values_frame(spark, 1, 2, 3).unionByName(values_frame(spark, 9, account="B")) \
        .withColumns({"cash_balance": F.lit(0.0), "positions_value": F.lit(0.0)})
    got = reports.value_history(values, "A", 2)
    assert [(r.account_id, r.total_value) for r in got.collect()] == [("A", 3.0), ("A", 2.0)]


def test_holdings_average_all_buys_so_far(spark):
    m = models(spark,
               t=[("t0", "A", "Z", "SELL", 1.0, 9.0, at(1)),
                  ("t1", "A", "X", "BUY", 10.0, 2.0, at(1)),
                  ("t2", "A", "X", "BUY", 10.0, 4.0, at(2)),
                  ("t3", "A", "X", "SELL", 5.0, 9.0, at(2))],
               p=[("X", 5.0, at(1)), ("X", 6.0, at(2)), ("Z", 1.0, at(1))])
    got = reports.holdings(m["int_trade_days"], m["int_daily_prices"]).collect()
    assert [(r.symbol, r.position_date, r.avg_cost_per_share, r.unrealized_pnl) for r in got] == [
        ("X", day(2), 3.0, 45.0), ("X", day(1), 2.0, 30.0), ("Z", day(1), None, None)]


def test_dimensions_are_distinct_over_both_feeds(spark):
    m = models(spark,
               t=[("t1", "A", "X", "BUY", 1.0, 1.0, at(1)), ("t2", "A", "X", "BUY", 1.0, 1.0, at(1))],
               p=[("Y", 1.0, at(1)), ("X", 1.0, at(1))],
               c=[("c1", "B", 1.0, "DEPOSIT", at(1))])
    assert rows(m["dim_account"], "account_id") == [("A",), ("B",)]
    assert rows(m["dim_symbol"], "symbol") == [("X",), ("Y",)]
    assert rows(m["dim_date"], "date_day") == [(day(1),), (day(2),), (day(3),)]


def test_spine_is_half_open_and_may_be_empty(spark):
    assert date_spine(spark, day(1), day(1)).count() == 0
    assert date_spine(spark, day(5), day(1)).count() == 0
    year = date_spine(spark, day(1)).agg(F.min("date_day"), F.max("date_day")).first()
    assert year[0] == day(1)
    last = spark.range(1).select(F.date_sub(F.add_months(F.current_date(), 12), 1)).first()[0]
    assert year[1] == last


def test_millis_round_trip_in_any_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.createDataFrame([(1704067200123,), (1710037800000,), (-1,), (2**62,), (None,)], "ms bigint")
        got = df.select(scalar.from_millis(F.col("ms")).alias("t")).select(
            F.col("t").cast("string"), scalar.to_millis(F.col("t")))
        assert [tuple(r) for r in got.collect()] == [
            ("2024-01-01 00:00:00.123", 1704067200123),
            # 02:30 on a day New York's clocks skip it.
            ("2024-03-10 02:30:00", 1710037800000), ("1969-12-31 23:59:59.999", -1),
            (None, None), (None, None)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_ratio_is_null_for_zero(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0)], "a double, b double")
    got = [r[0] for r in df.select(scalar.safe_ratio(F.col("a"), F.col("b"))).collect()]
    assert got == [0.5, None]
