"""Bring built models up to date with what has landed since, without building them anew.

A build remembers how far it has read (:func:`ledgerwake.sources.landing.mark`). From the rows that
landed behind that mark follow the keys that are new or changed, and from these the (entity, day)
groups and the accounts they touch:

* trades and totals of touched groups are taken again from the raw tables, which are read within
  the days concerned and never shuffled beyond these groups;
* running positions and balances are recomputed from the first touched day of an entity on. What
  came before is carried in as one row that holds the running total so far;
* value and PnL are recomputed for the (account, day) pairs that any of this, or a changed close,
  reaches; all other rows are copied from the earlier build.

Entities may be NULL, so groups are compared null-safely. An update without changes copies the
build. Keys do not leave the dimensions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwake.operators.aggregates import daily_change
from ledgerwake.operators.joins import mark_to_market
from ledgerwake.operators.sets import union_all
from ledgerwake.operators.windows import running, timeline
from ledgerwake.plans import dimensions, facts, intermediate, pipeline, staging
from ledgerwake.schemas import RAW_TABLES, RAW_TRADES
from ledgerwake.sources import landing
from ledgerwake.sources.raw import load_raw
from ledgerwake.sources.scratch import staged

HOLDING, GROUP = ["account_id", "symbol"], ["account_id", "symbol", "trade_date"]

Marks = dict[str, dict[str, int]]


def marks(spark: SparkSession, root: str) -> Marks:
    """How far the logs under ``root`` have come; to be taken before a build reads them."""
    return {name: landing.mark(spark, f"{root}/{name}") for name in RAW_TABLES}


def changes(spark: SparkSession, root: str, since: Marks) -> dict[str, DataFrame]:
    """All versions, old and new, of every key that a row behind the marks belongs to."""
    return {name: landing.changed(spark, f"{root}/{name}", table, since.get(name, {}))
            for name, table in RAW_TABLES.items()}


def _same(left: str, right: str, keys: Sequence[str]) -> Column:
    match = F.lit(True)
    for key in keys:
        match = match & F.col(f"{left}.{key}").eqNullSafe(F.col(f"{right}.{key}"))
    return match


def among(df: DataFrame, keys: Sequence[str], groups: DataFrame) -> DataFrame:
    """Rows of ``df`` whose keys are among ``groups``, NULL being equal to NULL."""
    return df.alias("l").join(groups.alias("r"), _same("l", "r", keys), "left_semi")


def outside(df: DataFrame, keys: Sequence[str], groups: DataFrame) -> DataFrame:
    return df.alias("l").join(groups.alias("r"), _same("l", "r", keys), "left_anti")


def _within(rows: DataFrame, instant: str, day: str, groups: DataFrame) -> DataFrame:
    """Rows between the first and the last day of ``groups``: a range a scan can skip files by."""
    ends = groups.agg(F.min(day).alias("low"), F.max(day).alias("high")).first()
    if ends.low is None:
        return rows.limit(0)
    return rows.filter(F.col(instant).between(
        F.lit(ends.low).cast("timestamp_ntz"),
        F.lit(ends.high).cast("timestamp_ntz") + F.expr("INTERVAL '1' DAY")))


def firsts(touched: DataFrame, entity: Sequence[str], day: str) -> DataFrame:
    return touched.groupBy(*entity).agg(F.min(day).alias("from_day"))


def suffix(
    days: DataFrame, before: DataFrame, starts: DataFrame, entity: Sequence[str], day: str,
    change: str, total: str,
) -> tuple[DataFrame, DataFrame]:
    """Running totals of touched entities from their first touched day on, and the rows of
    ``before`` that stay.

    ``days`` holds the new changes of each day, ``before`` the earlier totals. The last total
    before the first touched day takes part as a row of its own, so that sums are added up in the
    order in which a full build adds them.
    """
    def started(df: DataFrame, how: str) -> DataFrame:
        return df.alias("l").join(starts.alias("r"), _same("l", "r", entity), how).select(
            "l.*", "r.from_day")

    later = started(days, "inner").filter(F.col(day) >= F.col("from_day"))
    old = started(before, "left")
    stays = F.col("from_day").isNull() | (F.col(day) < F.col("from_day"))
    carried = old.filter(stays & F.col("from_day").isNotNull()).groupBy(*entity).agg(
        F.max(day).alias(day), F.max_by(total, day).alias(change)).withColumn("_new", F.lit(False))
    line = timeline(entity, day)
    rows = later.select(*entity, day, change, F.lit(True).alias("_new")).unionByName(carried)
    summed = rows.withColumn(total, running(F.sum, F.col(change), line)).filter("_new")
    return summed.drop("_new"), old.filter(stays).drop("from_day")


def update(
    before: Mapping[str, DataFrame], raw: Mapping[str, DataFrame],
    changed: Mapping[str, DataFrame],
) -> dict[str, DataFrame]:
    """All tables of the build ``before`` (written ones), as a full build of ``raw`` would make
    them; ``changed`` as from :func:`changes`."""
    spark = raw["raw_trades"].sparkSession
    trades = staging.stg_trades(changed["raw_trades"])
    ticks = staging.stg_prices(changed["raw_prices"])
    cash = staging.stg_cash_events(changed["raw_cash_events"])
    # From here on only the groups are read: the changed rows are brought together once.
    groups = staged(trades.select(*GROUP).distinct(), "touched-groups")
    closes_touched = staged(ticks.select("symbol", "price_date").distinct(), "touched-closes")
    cash_touched = staged(cash.select("account_id", "cash_date").distinct(), "touched-cash")
    new: dict[str, DataFrame] = {}

    def keep(name: str, df: DataFrame) -> DataFrame:
        new[name] = staged(df.select(*before[name].columns), name)
        return new[name]

    # Totals by group and day.
    own = among(
        staging.stg_trades(_within(raw["raw_trades"], "timestamp", "trade_date", groups)),
        GROUP, groups)
    days = keep("int_trade_days", outside(before["int_trade_days"], GROUP, groups).unionByName(
        intermediate.int_trade_days(own)))
    # All versions of a changed trade lie in touched groups: it is found by these, which are few.
    keep("fact_trades", outside(before["fact_trades"], GROUP, groups).unionByName(
        facts.fact_trades(own)))
    tick = ["symbol", "price_date"]
    stg = staging.stg_prices(
        _within(raw["raw_prices"], "timestamp", "price_date", closes_touched))
    closes = keep("int_daily_prices", outside(
        before["int_daily_prices"], tick, closes_touched).unionByName(
        intermediate.int_daily_prices(among(stg, tick, closes_touched))))

    # Running totals from the first touched day on.
    later, rest = suffix(
        days.withColumnRenamed("trade_date", "position_date"),
        before["fact_positions_daily"],
        firsts(groups, HOLDING, "trade_date"), HOLDING, "position_date", "daily_change",
        "cumulative_position")
    later = staged(later, "later-positions")
    positions = keep("fact_positions_daily", rest.unionByName(
        facts.stamp(later, "calculated_at")))
    account_day = ["account_id", "cash_date"]
    stg = staging.stg_cash_events(
        _within(raw["raw_cash_events"], "timestamp", "cash_date", cash_touched))
    paid = daily_change(among(stg, account_day, cash_touched), account_day,
                        intermediate.signed_amount())
    earlier = before["int_cash_balances"].withColumnRenamed("balance_date", "cash_date")
    paid = outside(earlier, account_day, cash_touched).select(
        *account_day, "daily_change").unionByName(paid)
    later_cash, rest = suffix(
        paid, earlier, firsts(cash_touched, ["account_id"], "cash_date"), ["account_id"],
        "cash_date", "daily_change", "cash_balance")
    later_cash = staged(later_cash, "later-cash")
    balances = keep("int_cash_balances", rest.unionByName(later_cash).withColumnRenamed(
        "cash_date", "balance_date"))

    # Value and PnL of the accounts and days that any of it reaches.
    moved = later.select("account_id", F.col("position_date").alias("value_date"))
    marked = among(positions.withColumnRenamed("position_date", "price_date"), tick,
                   closes_touched).select("account_id", F.col("price_date").alias("value_date"))
    traded = staged(moved.unionByName(marked).unionByName(groups.select(
        "account_id", F.col("trade_date").alias("value_date"))).distinct(), "touched-days")
    valued = staged(traded.unionByName(later_cash.select(
        "account_id", F.col("cash_date").alias("value_date"))).unionByName(cash_touched.select(
            "account_id", F.col("cash_date").alias("value_date"))).distinct(), "touched-values")
    pair = ["account_id", "value_date"]
    held = positions.drop("calculated_at").withColumn("value_date", F.col("position_date"))
    keep("fact_portfolio_value_daily", outside(
        before["fact_portfolio_value_daily"], pair, valued).unionByName(
        facts.fact_portfolio_value_daily(
            among(held, pair, valued).drop("value_date"), closes,
            among(balances.withColumn("value_date", F.col("balance_date")), pair, valued).drop(
                "value_date"))))
    totals = days.withColumnRenamed("trade_date", "position_date").drop("daily_change")
    matched = _same("l", "r", [*HOLDING, "position_date"])
    held = among(held, pair, traded).alias("l").join(totals.alias("r"), matched).select(
        "l.*", *[F.col(f"r.{c}") for c in totals.columns if c not in (*HOLDING, "position_date")])
    keep("fact_pnl_daily", outside(
        before["fact_pnl_daily"].withColumn("value_date", F.col("pnl_date")), pair, traded).drop(
        "value_date").unionByName(facts.pnl_of(held.drop("value_date"), closes)))

    # The dimensions with whatever is new.
    for name, column, sources in (("dim_account", "account_id", (groups, cash_touched)),
                                  ("dim_symbol", "symbol", (groups, closes_touched))):
        known = before[name].select(column)
        seen = union_all([df.select(column) for df in sources]).distinct()
        fresh = seen.filter(F.col(column).isNotNull()).join(known, column, "left_anti")
        keep(name, before[name].unionByName(dimensions.stamp(fresh, "created_at")))
    new["dim_date"] = before["dim_date"]
    return new


def rebuild(spark: SparkSession, root: str, before: Mapping[str, DataFrame],
            since: Marks) -> dict[str, DataFrame]:
    """Update a build of the landing tables under ``root`` to what they hold now."""
    return update(before, loaded(spark, root), changes(spark, root, since))


def loaded(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The landing tables under ``root``; trades, which several models read, resolved once."""
    raw = load_raw(spark, root)
    if landing.is_base(spark, f"{root}/raw_trades", RAW_TRADES):
        return raw
    return raw | {"raw_trades": staged(raw["raw_trades"], "raw-trades")}


def tables(models: pipeline.Models) -> dict[str, DataFrame]:
    """The tables of a build that :func:`update` takes."""
    return {name: models[name] for how, members in pipeline.LAYERS.values()
            if how == pipeline.TABLE for name in members}
