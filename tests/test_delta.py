"""Updates of a build against full builds of the same rows."""

from __future__ import annotations

import random

import pytest

from ledgerwake.params import Params
from ledgerwake.plans import delta, pipeline
from ledgerwake.schemas import RAW_TABLES, RAW_TRADES
from ledgerwake.sources import landing
from tests.helpers import at, cash, day, prices, rows, trades
from tests.test_streaming import TRADES, Topic, land, trade

PARAMS = Params(day(1), day(28))
STAMPS = ("calculated_at", "created_at", "ingestion_time")


def build(spark, raw, path):
    return delta.tables(pipeline.run(spark, raw, str(path), PARAMS))


def plain(df):
    kept = sorted(c for c in df.columns if c not in STAMPS)
    return rows(df.selectExpr(*[
        f"round({c}, 6) + 0.0 AS {c}" if t == "double" else c
        for c, t in df.dtypes if c in kept]), *kept)


def feeds(draw, n):
    def some(values):
        return draw.choice(values)

    accounts, symbols = ["A", "B", "C", None], ["X", "Y", "Z"]
    return (
        {f"t{draw.randrange(n * 2)}": (some(accounts), some(symbols), some(["BUY", "sell"]),
                                       float(draw.randrange(1, 9)), float(draw.randrange(1, 99)),
                                       at(draw.randrange(1, 20))) for _ in range(n)},
        {(some(symbols), at(draw.randrange(1, 20), draw.randrange(3))): float(
            draw.randrange(1, 99)) for _ in range(n)},
        {f"c{draw.randrange(n * 2)}": (some(accounts[:3]), float(draw.randrange(1, 99)),
                                       some(["DEPOSIT", "withdrawal"]),
                                       at(draw.randrange(1, 20))) for _ in range(n // 2)})


def frames(spark, t, p, c):
    return {
        "raw_trades": trades(spark, *[(k, *v) for k, v in t]),
        "raw_prices": prices(spark, *[(s, v, when) for (s, when), v in p]),
        "raw_cash_events": cash(spark, *[(k, *v) for k, v in c])}


@pytest.mark.parametrize("seed", range(3))
def test_an_update_equals_a_full_build(spark, tmp_path, seed):
    draw = random.Random(seed)
    old, new = feeds(draw, 40), feeds(draw, 12)
    # Later rows add keys and replace what others held, on other days and for other accounts.
    now = tuple({**a, **b} for a, b in zip(old, new, strict=True))
    before = build(spark, frames(spark, *[x.items() for x in old]), tmp_path / "old")
    changed = frames(spark, *[
        [*b.items(), *[(k, v) for k, v in a.items() if k in b]]
        for a, b in zip(old, new, strict=True)])
    raw = frames(spark, *[x.items() for x in now])
    got = delta.update(before, raw, changed)
    want = build(spark, raw, tmp_path / "new")
    assert got.keys() == want.keys()
    for name in want:
        if not name.startswith("dim_"):
            assert plain(got[name]) == plain(want[name]), name
    # Keys stay in the dimensions.
    for name in ("dim_account", "dim_symbol"):
        assert set(plain(got[name])) >= set(plain(want[name]))


def test_an_update_without_changes_copies_the_build(spark, tmp_path):
    raw = frames(spark, *[x.items() for x in feeds(random.Random(5), 30)])
    before = build(spark, raw, tmp_path / "old")
    got = delta.update(before, raw, {n: df.limit(0) for n, df in raw.items()})
    for name, df in before.items():
        assert plain(got[name]) == plain(df), name


def test_late_trades_reach_only_later_days_of_their_account(spark, tmp_path):
    t = [(f"t{n}", ("A" if n % 2 else "B", "X", "BUY", 1.0, 2.0, at(1 + n))) for n in range(10)]
    p = [(("X", at(n)), 2.0) for n in range(1, 12)]
    before = build(spark, frames(spark, t, p, []), tmp_path / "old")
    late = [("late", ("A", "X", "BUY", 5.0, 2.0, at(6)))]
    got = delta.update(before, frames(spark, t + late, p, []), frames(spark, late, [], []))
    stamps = {(r.account_id, r.position_date): r.calculated_at
              for r in before["fact_positions_daily"].collect()}
    moved = {(r.account_id, r.position_date) for r in got["fact_positions_daily"].collect()
             if stamps.get((r.account_id, r.position_date)) != r.calculated_at}
    assert moved == {("A", day(6)), ("A", day(8)), ("A", day(10))}
    values = {(r.account_id, r.value_date): r.calculated_at
              for r in before["fact_portfolio_value_daily"].collect()}
    again = {(r.account_id, r.value_date)
             for r in got["fact_portfolio_value_daily"].collect()
             if values.get((r.account_id, r.value_date)) != r.calculated_at}
    assert again == moved


def test_changes_come_from_behind_the_mark(spark, tmp_path):
    topic = Topic(spark, tmp_path / "topic")
    root = str(tmp_path / "root")
    topic.send(trade(1), trade(2), minutes=10)
    out, _ = land(spark, tmp_path, topic)
    since = delta.marks(spark, root)
    assert set(since) == set(RAW_TABLES)
    assert delta.changes(spark, root, since)["raw_trades"].count() == 0
    topic.send(trade(2, price=9.0), trade(3), "bad")
    land(spark, tmp_path, topic)

    def found():
        return rows(delta.changes(spark, root, since)["raw_trades"], "trade_id", "price")

    want = [("t2", 2.0), ("t2", 9.0), ("t3", 2.0)]
    assert found() == want
    # The row that was first until now is known for one compaction more.
    landing.compact(spark, out, RAW_TRADES)
    assert found() == want
    topic.send(trade(4))
    land(spark, tmp_path, topic)
    assert found() == [*want, ("t4", 2.0)]
    landing.compact(spark, out, RAW_TRADES)
    with pytest.raises(ValueError, match="folded and deleted"):
        delta.changes(spark, root, since)
    since = delta.marks(spark, root)
    assert delta.changes(spark, root, since)["raw_trades"].count() == 0
    assert TRADES.table.name in since
