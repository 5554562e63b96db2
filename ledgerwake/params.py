"""Model variables, passed as plain arguments so Catalyst folds them into the plan."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    """``date_end`` of None means one year after the day the job runs."""

    date_start: dt.date = dt.date(2024, 1, 1)
    date_end: dt.date | None = None
    trading_days: int = 252
    volatility_rows: int = 30
    report_rows: int = 30
    # For ratios users build on top; no model reads it.
    risk_free: float = 0.0
