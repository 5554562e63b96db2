"""Every registered query against the SQL oracle, at the smallest scale."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from ledgerwake import catalog, oracle
from tests.compare import ROOT, connect, difference

SF_DIR = f"{ROOT}/sf0.001"
QUERIES, SQL = catalog.QUERIES, oracle.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == SQL.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, con, name):
    assert difference(spark, con, QUERIES[name], SQL[name], SF_DIR) is None


def test_entry_returns_the_flagship(spark):
    df = contract.entry(spark)
    assert df.columns == [
        "account_id", "value_date", "positions_value", "cash_balance", "total_value"]
    assert df.count() == 5619


def test_invariants(spark):
    q = {name: QUERIES[name](spark, SF_DIR) for name in (
        "fact_positions_daily", "fact_portfolio_value_daily", "drawdown")}
    for name, df in q.items():
        df.createOrReplaceTempView(f"inv_{name}")
    broken = {
        "net changes add up to the last position": """
            SELECT account_id FROM inv_fact_positions_daily GROUP BY account_id, symbol
            HAVING sum(daily_change) <> max_by(cumulative_position, position_date)""",
        "total is positions plus cash": """
            SELECT * FROM inv_fact_portfolio_value_daily
            WHERE abs(total_value - positions_value - cash_balance) > 0.001""",
        "drawdown is never positive, the worst never recovers": """
            SELECT * FROM (SELECT *, lag(max_drawdown) OVER
                (PARTITION BY account_id ORDER BY value_date) AS before FROM inv_drawdown)
            WHERE drawdown > 0 OR max_drawdown > drawdown OR max_drawdown > before""",
    }
    for rule, sql in broken.items():
        assert spark.sql(sql).count() == 0, rule
