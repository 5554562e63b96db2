"""The declared data tests, layer by layer."""

from __future__ import annotations

from ledgerwake.operators.quality import Check
from ledgerwake.schemas import CASH_TYPES, SIDES

# Which columns of which model carry which test.
NOT_NULL = {
    "raw_trades": ["trade_id", "timestamp"],
    "raw_prices": ["symbol", "price", "timestamp"],
    "raw_cash_events": ["event_id", "timestamp"],
    "stg_trades": ["trade_id", "account_id", "symbol", "side", "quantity", "price",
                   "trade_timestamp", "trade_date"],
    "stg_prices": ["symbol", "price", "price_timestamp", "price_date"],
    "stg_cash_events": ["event_id", "account_id", "amount", "cash_type", "cash_timestamp",
                        "cash_date"],
    "dim_account": ["account_id"],
    "dim_symbol": ["symbol"],
    "dim_date": ["date_day"],
    "fact_trades": ["trade_id", "trade_value"],
    "fact_positions_daily": ["account_id", "symbol", "position_date"],
    "fact_portfolio_value_daily": ["account_id", "value_date"],
    "fact_pnl_daily": ["account_id", "pnl_date"],
    "daily_returns": ["account_id", "value_date"],
    "cumulative_returns": ["account_id", "value_date"],
    "drawdown": ["account_id", "value_date"],
    "rolling_volatility": ["account_id", "value_date"],
}
UNIQUE = {
    "raw_trades": "trade_id",
    "raw_cash_events": "event_id",
    "stg_trades": "trade_id",
    "stg_cash_events": "event_id",
    "dim_account": "account_id",
    "dim_symbol": "symbol",
    "dim_date": "date_day",
    "fact_trades": "trade_id",
}
ACCEPTED = {("stg_trades", "side"): SIDES, ("stg_cash_events", "cash_type"): CASH_TYPES}
POSITIVE = [
    ("stg_trades", "quantity"),
    ("stg_trades", "price"),
    ("stg_prices", "price"),
    ("stg_cash_events", "amount"),
]

CHECKS: tuple[Check, ...] = (
    *(Check(model, column, "not_null") for model, cols in NOT_NULL.items() for column in cols),
    *(Check(model, column, "unique") for model, column in UNIQUE.items()),
    *(Check(model, column, "accepted_values", values=tuple(values))
      for (model, column), values in ACCEPTED.items()),
    *(Check(model, column, "expression_is_true", rule="> 0") for model, column in POSITIVE),
)
