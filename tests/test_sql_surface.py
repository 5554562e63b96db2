"""The documented reports as SQL text over the built tables, next to the functions."""

from __future__ import annotations

import pytest

from ledgerwake.params import Params
from ledgerwake.plans import pipeline, reports
from ledgerwake.sources import market
from tests.helpers import rows

SF = "/root/testdata/sf0.001"
PARAMS = Params()


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    raw = {
        "raw_trades": market.raw_trades(spark, SF),
        "raw_prices": market.raw_prices(spark, SF),
        "raw_cash_events": market.raw_cash_events(spark, SF),
    }
    return pipeline.run(spark, raw, str(tmp_path_factory.mktemp("models")), PARAMS, "main_",
                        layers_as={"metrics": pipeline.TABLE})


def same(spark, sql: str, df) -> None:
    assert rows(spark.sql(sql), *df.columns) == rows(df, *df.columns)


def test_value_history(spark, built):
    spark.sql("""
        CREATE OR REPLACE TEMP VIEW recent AS
        SELECT v.*, row_number() OVER (PARTITION BY account_id ORDER BY value_date DESC) AS age
        FROM main_facts.fact_portfolio_value_daily v""")
    same(spark, "SELECT * FROM recent WHERE age <= 30 AND account_id LIKE '%1'",
         reports.value_history(built["fact_portfolio_value_daily"], "ACC001"))


def test_returns(spark, built):
    # Both series as one narrow table, folded back by day.
    same(spark, """
        WITH series AS (
            SELECT account_id, value_date, daily_return_pct AS d, NULL AS c
            FROM main_metrics.daily_returns
            UNION ALL
            SELECT account_id, value_date, NULL, cumulative_return_pct
            FROM main_metrics.cumulative_returns),
        days AS (
            SELECT account_id, value_date, max(d) AS daily_return_pct,
                   max(c) AS cumulative_return_pct
            FROM series GROUP BY account_id, value_date HAVING count(c) = 1)
        SELECT * FROM (
            SELECT *, rank() OVER (ORDER BY account_id, value_date DESC) AS nth FROM days)
        WHERE nth <= 30""",
         reports.returns_report_from_values(built["fact_portfolio_value_daily"], PARAMS))


def test_risk(spark, built):
    summary = reports.risk_summary(
        built["cumulative_returns"], built["drawdown"], built["rolling_volatility"])
    best = {r.account_id: tuple(r)[1:] for r in summary.collect()}
    # A figure of each metric table by itself; only the days with a cumulative return count.
    counted = ("(account_id, value_date) IN "
               "(SELECT account_id, value_date FROM main_metrics.cumulative_returns)")
    figures = {
        "max(cumulative_return_pct) FROM main_metrics.cumulative_returns": 0,
        f"min(max_drawdown_pct) FROM main_metrics.drawdown WHERE {counted}": 1,
        "avg(annualized_volatility_pct) FROM main_metrics.rolling_volatility "
        f"WHERE {counted}": 2}
    for figure, place in figures.items():
        got = dict(map(tuple, spark.sql(
            f"SELECT account_id, {figure} GROUP BY account_id").collect()))
        assert got == pytest.approx({a: row[place] for a, row in best.items()})


def test_reports_come_in_their_order(spark, built):
    values = built["fact_portfolio_value_daily"]

    def listed(df, *columns):
        return [tuple(r) for r in df.select(*columns).collect()]

    history = listed(reports.value_history(values, "ACC001"), "value_date")
    assert history == sorted(history, reverse=True) and len(history) == 30
    returns = listed(reports.returns_report_from_values(values, PARAMS),
                     "account_id", "value_date")
    assert returns == sorted(returns, key=lambda r: (r[0], -r[1].toordinal()))
    held = listed(reports.open_positions(built["fact_positions_daily"]), "cumulative_position")
    assert held == sorted(held, reverse=True)
    for df in (reports.account_values(values), reports.return_listing(built["daily_returns"])):
        days = listed(df, "account_id", "value_date")
        assert days == sorted(days)


def test_open_positions_and_listings(spark, built):
    same(spark, """
        SELECT account_id, symbol, position_date, cumulative_position
        FROM main_facts.fact_positions_daily WHERE cumulative_position <> 0""",
         reports.open_positions(built["fact_positions_daily"]))
    same(spark, """SELECT account_id, value_date, total_value, cash_balance, positions_value
         FROM main_facts.fact_portfolio_value_daily""",
         reports.account_values(built["fact_portfolio_value_daily"]))
    same(spark, "SELECT account_id, value_date, daily_return_pct FROM main_metrics.daily_returns",
         reports.return_listing(built["daily_returns"]))


def test_the_one_known_duplicate_is_reported(spark, built):
    failing = pipeline.check(built).filter("failures > 0")
    assert rows(failing, "model", "column_name", "kind", "failures") == [
        (model, "trade_id", "unique", 1) for model in ("fact_trades", "raw_trades", "stg_trades")]
