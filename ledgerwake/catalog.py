"""Every operator, model and report as a query over a folder of input tables.

Audit columns hold the current time and are left out. Money is rounded to 4 places and
ratios to 6 (percentages to 4), because the order of a floating sum is not fixed.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterable
from functools import partial, wraps

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerwake.functions.scalar import from_millis, to_millis
from ledgerwake.operators import aggregates as agg
from ledgerwake.operators import joins, quality, sets, windows, writes
from ledgerwake.operators.generators import spine_between
from ledgerwake.params import Params
from ledgerwake.plans import (
    delta,
    dimensions,
    facts,
    intermediate,
    metrics,
    pipeline,
    reports,
    staging,
)
from ledgerwake.plans.checks import CHECKS
from ledgerwake.schemas import LONG, RAW_PRICES, RAW_TRADES, SIDES, record
from ledgerwake.session import TIDY, settings
from ledgerwake.sources import files, landing, market
from ledgerwake.sources.raw import as_raw, create_raw_tables, load_raw
from ledgerwake.sources.scratch import scratch_dir, staged, unstage
from ledgerwake.streaming import feeds, sinks

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
PARAMS = Params()
AUDIT = ("calculated_at", "created_at", "ingestion_time")
MONEY = 4
RATIO = 6
DAY_SPAN = ["first_day", "last_day"]


def rounded(df: DataFrame, places: int, columns: Iterable[str]) -> DataFrame:
    """Round, and turn -0.0 into 0.0."""
    return df.withColumns({c: F.round(c, places) + F.lit(0.0) for c in columns})


def query(money: Iterable[str] = (), ratio: Iterable[str] = ()):
    """Register a query under its function name, comparable columns only."""

    def register(fn: Query) -> Query:
        @wraps(fn)
        def comparable(spark: SparkSession, sf_dir: str) -> DataFrame:
            with settings(spark, TIDY):
                df = fn(spark, sf_dir)
            # A frame of its own: its shuffle files stay for whoever runs it more than once.
            return rounded(rounded(df.drop(*AUDIT).select("*"), MONEY, money), RATIO, ratio)

        QUERIES[fn.__name__] = comparable
        return fn

    return register


# --- inputs shared by the queries --------------------------------------------------------

def _trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_trades(market.raw_trades(spark, sf_dir))


def _cash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_cash_events(market.raw_cash_events(spark, sf_dir))


def _closes(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = staging.stg_prices(market.raw_price_log(spark, sf_dir), "seq")
    return intermediate.int_daily_prices(log, "seq")


def _trade_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intermediate.int_trade_days(_trades(spark, sf_dir))


def _positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.fact_positions_daily(_trade_days(spark, sf_dir)).drop("calculated_at")


def _balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intermediate.int_cash_balances(_cash(spark, sf_dir))


def _marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.mark_to_market(_positions(spark, sf_dir), _closes(spark, sf_dir))


def _values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.fact_portfolio_value_daily(
        _positions(spark, sf_dir), _closes(spark, sf_dir), _balances(spark, sf_dir))


def _returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.daily_returns(_values(spark, sf_dir))


# --- models ------------------------------------------------------------------------------

@query()
def stg_trades(spark, sf_dir):
    return _trades(spark, sf_dir)


@query()
def stg_prices(spark, sf_dir):
    return staging.stg_prices(market.raw_prices(spark, sf_dir))


@query()
def stg_cash_events(spark, sf_dir):
    return _cash(spark, sf_dir)


@query()
def int_daily_prices(spark, sf_dir):
    return _closes(spark, sf_dir)


@query(money=["daily_change", "cash_balance"])
def int_cash_balances(spark, sf_dir):
    return _balances(spark, sf_dir)


@query()
def dim_account(spark, sf_dir):
    return dimensions.dim_account(_trades(spark, sf_dir), _cash(spark, sf_dir))


@query()
def dim_symbol(spark, sf_dir):
    return dimensions.dim_symbol(
        _trades(spark, sf_dir), staging.stg_prices(market.raw_price_log(spark, sf_dir)))


@query()
def dim_date(spark, sf_dir):
    """Calendar over the days the trades and cash movements span."""
    days = _trades(spark, sf_dir).select(F.col("trade_date").alias("day")).unionByName(
        _cash(spark, sf_dir).select(F.col("cash_date").alias("day")))
    span = days.agg(
        F.min("day").alias("first_day"), F.date_add(F.max("day"), 1).alias("last_day"))
    return spine_between(span, *DAY_SPAN)


@query()
def fact_trades(spark, sf_dir):
    return facts.fact_trades(_trades(spark, sf_dir))


@query()
def fact_positions_daily(spark, sf_dir):
    return _positions(spark, sf_dir)


@query(money=["positions_value", "cash_balance", "total_value"])
def fact_portfolio_value_daily(spark, sf_dir):
    return _values(spark, sf_dir)


@query(money=["realized_pnl", "total_pnl"])
def fact_pnl_daily(spark, sf_dir):
    return facts.fact_pnl_daily(_trade_days(spark, sf_dir), _closes(spark, sf_dir))


@query(ratio=["daily_return"], money=["daily_return_pct"])
def daily_returns(spark, sf_dir):
    return _returns(spark, sf_dir)


@query(ratio=["cumulative_return"], money=["cumulative_return_pct"])
def cumulative_returns(spark, sf_dir):
    return metrics.cumulative_returns(_returns(spark, sf_dir))


@query(ratio=["drawdown", "max_drawdown"], money=["drawdown_pct", "max_drawdown_pct"])
def drawdown(spark, sf_dir):
    return metrics.drawdown(_values(spark, sf_dir))


@query(ratio=["volatility_30d", "annualized_volatility"],
       money=["volatility_30d_pct", "annualized_volatility_pct"])
def rolling_volatility(spark, sf_dir):
    return metrics.rolling_volatility(_returns(spark, sf_dir), PARAMS)


# --- reports -----------------------------------------------------------------------------

@query(money=["total_value", "cash_balance", "positions_value"])
def value_history(spark, sf_dir):
    return reports.value_history(_values(spark, sf_dir), "ACC001", PARAMS.report_rows)


@query()
def holdings(spark, sf_dir):
    """Exact sums leave nothing to round: cost and gain are the same to the last bit."""
    return reports.holdings(_trade_days(spark, sf_dir), _closes(spark, sf_dir))


@query()
def open_positions(spark, sf_dir):
    return reports.open_positions(_positions(spark, sf_dir))


@query(money=["daily_return_pct", "cumulative_return_pct"])
def returns_report(spark, sf_dir):
    return reports.returns_report_from_values(_values(spark, sf_dir), PARAMS)


@query(money=["daily_return_pct", "cumulative_return_pct"])
def returns_report_joined(spark, sf_dir):
    returns = metrics.daily_returns(staged(_values(spark, sf_dir), "values"))
    return reports.returns_report(
        returns, metrics.cumulative_returns(returns), PARAMS.report_rows)


@query(money=["total_return_pct", "max_drawdown_pct", "avg_volatility_pct"])
def risk_summary(spark, sf_dir):
    return reports.risk_summary_from_values(_values(spark, sf_dir), PARAMS)


@query(money=["total_return_pct", "max_drawdown_pct", "avg_volatility_pct"])
def risk_summary_joined(spark, sf_dir):
    values = staged(_values(spark, sf_dir), "values")
    returns = metrics.daily_returns(values)
    return reports.risk_summary(
        metrics.cumulative_returns(returns), metrics.drawdown(values),
        metrics.rolling_volatility(returns, PARAMS))


@query(money=["total_value", "cash_balance", "positions_value"])
def account_values(spark, sf_dir):
    return reports.account_values(_values(spark, sf_dir))


@query(money=["daily_return_pct"])
def return_listing(spark, sf_dir):
    return reports.return_listing(_returns(spark, sf_dir))


# --- single operators --------------------------------------------------------------------

@query()
def signed_quantity(spark, sf_dir):
    return _trades(spark, sf_dir).select(
        "trade_id", "trade_timestamp", agg.signed_quantity().alias("signed_quantity"))


@query()
def signed_cash(spark, sf_dir):
    return _cash(spark, sf_dir).select(
        "event_id", intermediate.signed_amount().alias("signed_amount"))


@query()
def trade_value(spark, sf_dir):
    return facts.fact_trades(_trades(spark, sf_dir)).select(
        "trade_id", "trade_timestamp", "trade_value")


@query()
def daily_net_quantity(spark, sf_dir):
    return agg.daily_change(
        _trades(spark, sf_dir), ["account_id", "symbol", "trade_date"], agg.signed_quantity())


@query(money=["daily_change"])
def daily_net_cash(spark, sf_dir):
    return agg.daily_change(
        _cash(spark, sf_dir), ["account_id", "cash_date"], intermediate.signed_amount())


@query(money=["total_position_value"])
def account_position_value(spark, sf_dir):
    return agg.account_value(_marked(spark, sf_dir))


@query(money=["buy_value", "sell_value"])
def buy_sell_totals(spark, sf_dir):
    return agg.buy_sell_totals(_trades(spark, sf_dir))


@query(money=["realized_pnl"])
def realized_pnl(spark, sf_dir):
    return agg.realized_pnl(agg.buy_sell_totals(_trades(spark, sf_dir)))


@query()
def position_mark(spark, sf_dir):
    return _marked(spark, sf_dir).select(
        "account_id", "symbol", "position_date", "cumulative_position", "close_price",
        "position_value")


@query(money=["total_position_value", "cash_balance"])
def position_cash_outer(spark, sf_dir):
    cash = _balances(spark, sf_dir).select(
        "account_id", F.col("balance_date").alias("value_date"), "cash_balance")
    return joins.outer_merge(
        agg.account_value(_marked(spark, sf_dir)), cash, ["account_id", "value_date"])


@query(money=["realized_pnl", "total_pnl"])
def pnl_outer_merge(spark, sf_dir):
    days = staged(_trade_days(spark, sf_dir), "trade-days")
    marked = joins.mark_to_market(facts.positions(days), _closes(spark, sf_dir))
    return joins.merge_pnl(agg.realized_pnl(days), marked)


@query()
def running_position(spark, sf_dir):
    return _positions(spark, sf_dir).select(
        "account_id", "symbol", "position_date", "cumulative_position")


@query(money=["cash_balance"])
def running_cash(spark, sf_dir):
    return _balances(spark, sf_dir).select("account_id", "balance_date", "cash_balance")


@query(money=["peak_value"])
def running_peak(spark, sf_dir):
    return metrics.with_drawdown(_values(spark, sf_dir)).select(*metrics.DAY, "peak_value")


@query(ratio=["max_drawdown"])
def running_min(spark, sf_dir):
    return metrics.with_drawdown(_values(spark, sf_dir)).select(*metrics.DAY, "max_drawdown")


@query(money=["previous_value"])
def lag_value(spark, sf_dir):
    previous = windows.previous(F.col("total_value"), metrics.account_line())
    return _values(spark, sf_dir).select(*metrics.DAY, previous.alias("previous_value"))


@query(ratio=["volatility_30d"])
def rolling_stddev(spark, sf_dir):
    return metrics.with_volatility(_returns(spark, sf_dir), PARAMS).select(
        *metrics.DAY, "volatility_30d")


@query(ratio=["cumulative_return"])
def compound_return(spark, sf_dir):
    return metrics.with_cumulative(_returns(spark, sf_dir)).select(
        *metrics.DAY, "cumulative_return")


@query()
def key_union_accounts(spark, sf_dir):
    return sets.key_union("account_id", _trades(spark, sf_dir), _cash(spark, sf_dir))


@query()
def key_union_symbols(spark, sf_dir):
    return sets.key_union(
        "symbol", _trades(spark, sf_dir),
        staging.stg_prices(market.raw_price_log(spark, sf_dir)))


@query()
def distinct_accounts(spark, sf_dir):
    return agg.distinct_keys(_trades(spark, sf_dir), "account_id")


# --- data quality ------------------------------------------------------------------------

@query()
def qc_not_null(spark, sf_dir):
    """Ticks without a source."""
    ticks = market.raw_price_log(spark, sf_dir)
    return quality.not_null(ticks, "source").select("seq", "symbol", "price", "timestamp")


@query()
def qc_unique(spark, sf_dir):
    """Symbol and instant pairs with more than one tick."""
    return quality.unique(market.raw_price_log(spark, sf_dir), RAW_PRICES.key)


@query()
def qc_accepted_values(spark, sf_dir):
    """Trades whose side is not spelled as the landing table wants it."""
    trades = market.raw_trades(spark, sf_dir)
    return quality.accepted(trades, "side", SIDES).select("trade_id", "timestamp", "side")


@query(money=["daily_change"])
def qc_expression(spark, sf_dir):
    """Days on which an account paid out more than it took in."""
    return quality.holds(_balances(spark, sf_dir), "daily_change > 0").select(
        "account_id", "balance_date", "daily_change")


@query()
def qc_constraints_split(spark, sf_dir):
    """Trades a constrained table refuses, with the reason."""
    _, refused = writes.enforce(market.raw_trades(spark, sf_dir), RAW_TRADES)
    return refused.select("trade_id", "timestamp", "violation")


@query()
def qc_summary(spark, sf_dir):
    """Build all models as tables, then run every declared test on them."""
    raw = {
        "raw_trades": staged(market.raw_trades(spark, sf_dir), "raw_trades"),
        "raw_prices": staged(market.raw_prices(spark, sf_dir), "raw_prices"),
        "raw_cash_events": staged(market.raw_cash_events(spark, sf_dir), "raw_cash_events"),
    }
    return pipeline.check(pipeline.run(
        spark, raw, scratch_dir(spark, "models"), layers_as={"metrics": pipeline.TABLE}))


# --- writes ------------------------------------------------------------------------------

@query()
def price_upsert(spark, sf_dir):
    """Ticks of open line items merged into a table that holds all the others."""
    log = market.raw_price_log(spark, sf_dir)
    earlier = log.filter(F.col("source").isNotNull())
    stored = writes.resolve_upserts(earlier, RAW_PRICES.key, ["seq"], ["price"])
    return writes.upsert_latest(
        stored.select(*RAW_PRICES.columns), log.filter(F.col("source").isNull()),
        RAW_PRICES.key, ["seq"], ["price"])


def _delivered_twice(feed: DataFrame) -> DataFrame:
    return feed.withColumn("delivery", F.explode(F.array(F.lit(1), F.lit(2))))


def _keyed_insert(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All trades, delivered twice, into a table that holds the upper-case ones."""
    feed = staged(market.trade_feed(spark, sf_dir).drop("seq", "l_tax"), "trade-feed")
    stored = quality.holds(as_raw(feed, RAW_TRADES), "side <> upper(side)")
    return writes.insert_new(
        stored, _delivered_twice(feed), RAW_TRADES.key,
        ["delivery", "arrived_at", *feeds.POSITION])


@query()
def keyed_insert_accepted(spark, sf_dir):
    accepted, _ = _keyed_insert(spark, sf_dir)
    return accepted.select("trade_id", "delivery", "side", "quantity", "price", "timestamp")


@query()
def keyed_insert_rejected(spark, sf_dir):
    _, rejected = _keyed_insert(spark, sf_dir)
    return rejected.select("trade_id", "delivery", "side", "quantity", "price", "timestamp")


@query()
def row_counts(spark, sf_dir):
    trades = market.raw_trades(spark, sf_dir)
    return agg.counts({
        "raw_trades": trades,
        "raw_prices": market.raw_prices(spark, sf_dir),
        "raw_cash_events": market.raw_cash_events(spark, sf_dir),
        "fact_trades": facts.fact_trades(staging.stg_trades(trades)),
    })


def _insert_trades(spark: SparkSession, root: str, rows: DataFrame) -> None:
    """Insert rows into the declared trade table under ``root``, ingestion time left to it."""
    database, view = f"raw_{uuid.uuid4().hex}", f"rows_{uuid.uuid4().hex}"
    create_raw_tables(spark, root, database)
    named = rows.drop("ingestion_time")
    named.createOrReplaceTempView(view)
    columns = ", ".join(f"`{c}`" for c in named.columns)
    spark.sql(f"INSERT INTO {database}.raw_trades ({columns}) SELECT {columns} FROM {view}")
    spark.catalog.dropTempView(view)
    # The catalog forgets the tables; their files stay, as they have a place of their own.
    spark.sql(f"DROP DATABASE {database} CASCADE")


@query()
def raw_landing(spark, sf_dir):
    """Trades appended to the declared landing table by a batch, and loaded from there."""
    root = scratch_dir(spark, "raw")
    _insert_trades(spark, root, market.raw_trades(spark, sf_dir))
    loaded = load_raw(spark, root)
    counts = agg.counts({name: df for name, df in loaded.items() if name != "raw_trades"})
    others = counts.agg(F.sum("row_count")).first()[0]
    return loaded["raw_trades"].withColumns({
        "stamped": F.col("ingestion_time").isNotNull(), "others": F.lit(others)})


@query()
def trade_calendar(spark, sf_dir):
    """Days of the date dimension, with fixed ends, on which trades were made."""
    days = dimensions.dim_date(spark, Params(dt.date(1994, 1, 1), dt.date(1997, 1, 1)))
    traded = _trades(spark, sf_dir).groupBy(F.col("trade_date").alias("date_day")).agg(
        F.count(F.lit(1)).alias("n_trades"))
    return days.join(traded, "date_day", "left").na.fill(0, ["n_trades"])


@query()
def default_calendar(spark, sf_dir):
    """The date dimension as it is without an end: up to a year from today. Trades are counted on
    its days, moved to fall into it."""
    days = dimensions.dim_date(spark, PARAMS)
    moved = F.add_months(F.col("trade_date"), 12 * 28)
    traded = _trades(spark, sf_dir).groupBy(moved.alias("date_day")).agg(
        F.count(F.lit(1)).alias("n_trades"))
    return days.join(traded, "date_day", "left").na.fill(0, ["n_trades"])


@query()
def qc_summary_planted(spark, sf_dir):
    """The checks of the trade view on rows with errors of all four kinds."""
    trades = _trades(spark, sf_dir)
    size = F.col("quantity")
    wrong = trades.withColumns({
        "account_id": F.when(size != 3, F.col("account_id")),
        "side": F.when(size == 5, F.lit("HOLD")).otherwise(F.col("side")),
        "price": F.when(size == 7, -F.col("price")).otherwise(F.col("price"))})
    planted = wrong.unionByName(wrong.filter("quantity = 11"))
    return quality.run_checks(
        {"stg_trades": planted}, [c for c in CHECKS if c.model == "stg_trades"])


# --- streams -----------------------------------------------------------------------------

@query()
def decode_json_batch(spark, sf_dir):
    """The JSON properties of the event log, sent through the message decoder."""
    events = market.table(spark, sf_dir, "events").select(
        F.encode("props", "UTF-8").alias("value"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.current_timestamp().alias("timestamp"))
    decoded = feeds.decode_json(events, record(k=LONG))
    return decoded.select(F.col("offset").alias("event_id"), "k", "payload")


@query()
def millis_to_timestamp(spark, sf_dir):
    millis = to_millis(F.col("ts"))
    return market.table(spark, sf_dir, "events").select(
        "event_id", millis.alias("millis"), from_millis(millis).alias("ts_millis"))


def _recorded(messages: DataFrame, name: str, by: str | None = None) -> str:
    """Write envelopes down for replay, in a folder of its own for each value of ``by``.

    The tasks that make the messages write them, into as many files as there are tasks: nothing
    is dealt out anew, and no task takes in more than its share of the feed.
    """
    spark = messages.sparkSession
    path = scratch_dir(spark, f"messages-{name}")
    writer = messages.write.option("compression", "zstd")
    # One open file for each value instead of a sort of whole messages by it.
    with settings(spark, landing.STORED | {"spark.sql.maxConcurrentOutputFileWriters": "16"}):
        (writer if by is None else writer.partitionBy(by)).parquet(path)
    return path


def _spread(feed: DataFrame) -> DataFrame:
    """Producers work in parallel, whatever the layout of the table behind them."""
    return feed.repartition(*feeds.POSITION)


def trade_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades as sent; the joins of their feed deal them out to the producers."""
    return _sent_trades(market.trade_feed(spark, sf_dir))


def _sent_trades(feed: DataFrame) -> DataFrame:
    spelled = feed.withColumn("side", F.upper("side"))
    return market.messages(spelled, feeds.FEEDS["trades"].message, "account_id")


def _replay(spark: SparkSession, name: str, source: dict, out: str) -> None:
    """Run a feed over recorded messages until they are used up, under a new checkpoint."""
    sinks.start_feed(
        spark, feeds.FEEDS[name], {"fmt": "parquet", **source}, out,
        scratch_dir(spark, f"checkpoint-{name}"), sinks.ONCE).awaitTermination()


def _landed(spark: SparkSession, name: str, root: str | None = None) -> str:
    return f"{root or scratch_dir(spark, f'landed-{name}')}/{feeds.FEEDS[name].table.name}"


def _replayed(
    spark: SparkSession, name: str, messages: DataFrame, batches: int | None = None,
    sent: Callable[[DataFrame], DataFrame] | None = None,
) -> str:
    """Run a feed over recorded messages until they are used up; return its folder.

    ``sent`` makes of the recorded messages what is delivered. With ``batches`` a message and its
    copies go to one of so many groups of files, as their key and offset have it, and as many files
    are replayed at a time as there are to each group.
    """
    out = _landed(spark, name)
    if batches is None:
        source = {"path": _recorded(messages, name), "sent": sent}
        _replay(spark, name, source, out)
        _forget(spark, source)
        return out
    batch = F.pmod(F.hash("key", "offset"), F.lit(batches))
    path = _recorded(messages.withColumn("batch", batch), name, "batch")
    found = len(files.matching(spark, f"{path}/batch=*/*.parquet"))
    _replay(spark, name, {"path": f"{path}/batch=*", "sent": sent,
                          "maxFilesPerTrigger": str(max(1, -(-found // batches)))}, out)
    return out


def _forget(spark: SparkSession, source: dict) -> None:
    """Delete recorded messages that have landed and are not sent again."""
    for folder in files.matching(spark, source["path"]):
        files.delete(spark, folder)


def _loads(messages: DataFrame, name: str, n: int) -> list[dict]:
    """Record messages of ``n`` loads in one pass, by their column ``load``; the sources of each.

    A message without a load is in none. A pattern, as a load may have no messages.
    """
    path = _recorded(messages, name, "load")
    return [{"path": f"{path}/load=[{load}]"} for load in range(n)]


def _replayed_loads(
    spark: SparkSession, name: str, messages: DataFrame, n: int, compacted: int = 0,
    sent: Callable[[DataFrame, int], DataFrame] | None = None,
) -> str:
    """Replay ``n`` loads one after the other, see :func:`_loads`.

    Each load has a checkpoint of its own and lands in the same place. After the first
    ``compacted`` loads the log is compacted. With ``sent``, messages are recorded once for all
    loads, and it makes of them what a load delivers.
    """
    out = _landed(spark, name)
    if sent is None:
        sources = _loads(messages, name, n)
    else:
        path = _recorded(messages, name)
        sources = [{"path": path, "sent": partial(sent, load=load)} for load in range(n)]
    for position, source in enumerate(sources):
        _replay(spark, name, source, out)
        if source["path"] not in [later["path"] for later in sources[position + 1:]]:
            _forget(spark, source)
        if position < compacted:
            landing.compact(spark, out, feeds.FEEDS[name].table)
    return out


def _price_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return market.messages(
        market.price_feed(spark, sf_dir), feeds.FEEDS["prices"].message, "symbol")


def _later(seconds: int) -> Column:
    return F.col("timestamp") + F.expr(f"INTERVAL {seconds} SECOND")


def _twice(messages: DataFrame) -> DataFrame:
    return messages.withColumn("timestamp", F.explode(F.array("timestamp", _later(1))))


def _halves(messages: DataFrame) -> DataFrame:
    """Two backfills: odd and even source offsets."""
    rest = F.col("offset") % 2
    return messages.withColumn("load", F.when(rest == 1, 0).when(rest == 0, 1))


@query()
def stream_replay_trades(spark, sf_dir):
    out = _replayed(spark, "trades", trade_messages(spark, sf_dir))
    return landing.landed(spark, out, feeds.FEEDS["trades"].table)


@query()
def stream_replay_prices(spark, sf_dir):
    """Ticks streamed into the upserted table."""
    out = _replayed(spark, "prices", _price_messages(spark, sf_dir))
    return landing.resolved(spark, out, feeds.FEEDS["prices"].table)


@query()
def stream_replay_prices_batches(spark, sf_dir):
    """The same in five batches, cut across the order of the broker times."""
    out = _replayed(spark, "prices", _price_messages(spark, sf_dir), batches=5)
    return landing.resolved(spark, out, feeds.FEEDS["prices"].table)


@query()
def stream_two_backfills_prices(spark, sf_dir):
    """Two checkpoints, one table."""
    out = _replayed_loads(spark, "prices", _halves(_price_messages(spark, sf_dir)), 2)
    return landing.resolved(spark, out, feeds.FEEDS["prices"].table)


@query()
def stream_replay_cash(spark, sf_dir):
    feed = _spread(market.cash_feed(spark, sf_dir)).withColumn("type", F.upper("type"))
    messages = market.messages(feed, feeds.FEEDS["cash"].message, "account_id")
    return landing.landed(spark, _replayed(spark, "cash", messages), feeds.FEEDS["cash"].table)


@query()
def stream_two_backfills_trades(spark, sf_dir):
    out = _replayed_loads(spark, "trades", _halves(trade_messages(spark, sf_dir)), 2)
    return landing.landed(spark, out, feeds.FEEDS["trades"].table)


@query()
def stream_dedup(spark, sf_dir):
    """Every trade message delivered twice, in several batches, read once."""
    out = _replayed(spark, "trades", trade_messages(spark, sf_dir), batches=3, sent=_twice)
    return landing.resolved(spark, out, feeds.FEEDS["trades"].table)


def _thirds(messages: DataFrame) -> DataFrame:
    return messages.withColumn("load", F.pmod("offset", F.lit(3)))


@query()
def stream_compacted_trades(spark, sf_dir):
    """Every trade message delivered twice; landed, compacted, landed, compacted, landed, read.

    The last load repeats keys of the base with earlier broker times, too.
    """
    def copy(load: Column, seconds: int) -> Column:
        return F.struct(_later(seconds).alias("timestamp"), load.cast("int").alias("load"))

    def sent(messages: DataFrame, load: int) -> DataFrame:
        early = F.when(F.col("partition") % 2 == 0, F.lit(2))
        copies = F.array(copy(F.col("load"), 0), copy(F.col("load"), 1), copy(early, -1))
        each = _thirds(messages).withColumn("copy", F.explode(copies))
        return each.filter(F.col("copy.load") == load).withColumn(
            "timestamp", F.col("copy.timestamp")).drop("copy", "load")

    out = _replayed_loads(
        spark, "trades", trade_messages(spark, sf_dir), 3, compacted=2, sent=sent)
    return landing.resolved(spark, out, feeds.FEEDS["trades"].table)


@query()
def stream_compacted_prices(spark, sf_dir):
    """Ticks upserted over two bases."""
    out = _replayed_loads(
        spark, "prices", _thirds(_price_messages(spark, sf_dir)), 3, compacted=2)
    return landing.resolved(spark, out, feeds.FEEDS["prices"].table)


@query()
def raw_landing_mixed(spark, sf_dir):
    """A table that batches insert into and two streams land in, with keys of each in the others.

    Rows of the batch count as older: they have the version that the streams do not set.
    """
    root = scratch_dir(spark, "mixed")
    feed = staged(market.trade_feed(spark, sf_dir).drop("seq", "l_tax"), "trade-feed")
    path = _recorded(_halves(_sent_trades(feed)), "trades", "load")
    out = _landed(spark, "trades", root)
    _replay(spark, "trades", {"path": f"{path}/load=[0]"}, out)
    landing.compact(spark, out, RAW_TRADES)
    _replay(spark, "trades", {"path": f"{path}/load=[1]"}, out)
    trades = as_raw(feed, RAW_TRADES)
    early = trades.filter("quantity < 20").withColumns(
        {"side": F.upper("side"), "event_version": F.lit("batch")})
    _insert_trades(spark, root, early.filter("quantity < 10"))
    again = {"path": f"{path}/load=*", "sent": _twice}
    _replay(spark, "trades", again, out)
    _forget(spark, again)
    _insert_trades(spark, root, early.filter("quantity >= 10"))
    unstage(feed)
    return load_raw(spark, root)["raw_trades"]


def _updated(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Models built of early messages, and updated when the late ones are there.

    A fifth of all trades and cash movements is late. Of some late trades a wrong version has come
    before, with another day and quantity, and the right one is older by its broker time. There is
    one tick for each symbol and instant; those of one broker partition had a wrong price first.
    """
    root = scratch_dir(spark, "late")
    late = F.pmod("offset", F.lit(5)) == 0
    # Keys of their own for the rare line items that share all that makes up a trade's key.
    trades = market.trade_feed(spark, sf_dir).withColumns({
        "side": F.upper("side"),
        "trade_id": F.concat_ws("_", "trade_id", F.col("timestamp").cast("string"))})
    # 0 comes first, 1 comes late, 2 is the wrong version that comes first of a late one.
    coming = F.when(~late, F.array(F.lit(0))).when(
        F.col("partition") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    trades = trades.withColumn("turn", F.explode(F.when(late.isNotNull(), coming)))
    wrong = F.col("turn") == 2
    trades = trades.withColumns({
        "quantity": F.when(wrong, F.col("quantity") * 2).otherwise(F.col("quantity")),
        "timestamp": F.when(wrong, F.expr("timestamp + INTERVAL '3' DAY")).otherwise(
            F.col("timestamp")),
        "arrived_at": F.when(wrong, F.expr("arrived_at + INTERVAL '1' SECOND")).otherwise(
            F.col("arrived_at")),
        "load": F.col("turn") % 2})
    newest = Window.partitionBy(*RAW_PRICES.key).orderBy(F.desc("seq"))
    ticks = market.price_feed(spark, sf_dir).withColumn(
        "nth", F.row_number().over(newest)).filter("nth = 1")
    again = F.col("partition") == 2
    twice = F.when(again, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    ticks = ticks.withColumn("load", F.explode(twice))
    wrong = again & (F.col("load") == 0)
    ticks = ticks.withColumns({
        "price": F.when(wrong, F.col("price") * 2).otherwise(F.col("price")),
        "offset": F.when(wrong, F.col("offset") - 1).otherwise(F.col("offset"))})
    cash = _spread(market.cash_feed(spark, sf_dir)).withColumns(
        {"type": F.upper("type"), "load": late.cast("int")})
    loads = {
        name: _loads(market.messages(feed, feeds.FEEDS[name].message, key, "load"), name, 2)
        for name, feed, key in (("trades", trades, "account_id"), ("prices", ticks, "symbol"),
                                ("cash", cash, "account_id"))}

    def land(turn: int) -> None:
        for name, turns in loads.items():
            _replay(spark, name, turns[turn], _landed(spark, name, root))
            _forget(spark, turns[turn])

    land(0)
    since = delta.marks(spark, root)
    early = delta.loaded(spark, root)
    built = pipeline.run(spark, early, scratch_dir(spark, "models"))
    unstage(early["raw_trades"])
    land(1)
    landing.compact(spark, f"{root}/raw_trades", RAW_TRADES)
    return delta.rebuild(spark, root, delta.tables(built), since)


@query()
def delta_positions(spark, sf_dir):
    return _updated(spark, sf_dir)["fact_positions_daily"]


@query(money=["positions_value", "cash_balance", "total_value"])
def delta_portfolio_value(spark, sf_dir):
    return _updated(spark, sf_dir)["fact_portfolio_value_daily"]


@query(money=["realized_pnl", "total_pnl"])
def delta_pnl(spark, sf_dir):
    return _updated(spark, sf_dir)["fact_pnl_daily"]


def _verdicts(spark: SparkSession, out: str) -> DataFrame:
    rows = landing.tagged(spark, out, feeds.FEEDS["trades"].table)
    return rows.select(
        "trade_id", "timestamp",
        F.when(F.col("is_new"), landing.OK).otherwise(landing.BAD).alias("verdict"))


@query()
def stream_keyed_insert(spark, sf_dir):
    """Every trade message delivered twice; the second copies are set aside, not lost."""
    return _verdicts(
        spark, _replayed(spark, "trades", trade_messages(spark, sf_dir), sent=_twice))


@query()
def stream_two_backfills_keyed(spark, sf_dir):
    """The second copies come first, under a checkpoint of their own."""
    def sent(messages: DataFrame, load: int) -> DataFrame:
        return messages if load else messages.withColumn("timestamp", _later(1))

    return _verdicts(
        spark, _replayed_loads(spark, "trades", trade_messages(spark, sf_dir), 2, sent=sent))


@query()
def stream_quarantine(spark, sf_dir):
    """Messages refused by the trade feed: cut off in transit, or with a misspelt side."""
    feed = market.trade_feed(spark, sf_dir)
    sent = market.messages(feed.withColumn("key_", F.when(F.col("l_tax") == 0, "cut")
                                           .otherwise("whole")),
                           feeds.FEEDS["trades"].message, "key_")
    half = F.expr("substring(value, 1, cast(length(value) / 2 as int))")
    cut = F.decode("key", "UTF-8") == "cut"
    messages = sent.withColumn("value", F.when(cut, half).otherwise(F.col("value")))
    refused = landing.quarantined(spark, _replayed(spark, "trades", messages))
    return refused.select(
        F.regexp_extract("payload", '"trade_id":"([^"]+)"', 1).alias("trade_id"), "violation")
