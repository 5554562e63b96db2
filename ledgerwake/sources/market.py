"""Trade, price and cash feeds derived from order and line-item tables.

Every order belongs to an account, every line item is one trade and one price tick of the
part's type, and every order total is one cash movement.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerwake.functions.scalar import to_millis
from ledgerwake.operators.writes import resolve_upserts
from ledgerwake.schemas import (
    DOUBLE,
    INSTANT,
    INTEGER,
    LONG,
    RAW_CASH_EVENTS,
    RAW_PRICES,
    RAW_TRADES,
    STRING,
    record,
)
from ledgerwake.sources.raw import as_raw, with_defaults

VERSION = "1.0"
BROKER_EPOCH_MILLIS = 1_704_067_200_000  # 2024-01-01


# Declared, so that opening a table does not start a job to read a file footer.
TABLES = {
    "lineitem": record(
        l_orderkey=LONG, l_partkey=LONG, l_suppkey=LONG, l_linenumber=INTEGER,
        l_quantity=DOUBLE, l_discount=DOUBLE, l_tax=DOUBLE, l_returnflag=STRING,
        l_linestatus=STRING, l_shipdate=INSTANT),
    "orders": record(
        o_orderkey=LONG, o_custkey=LONG, o_totalprice=DOUBLE, o_orderdate=INSTANT,
        o_orderpriority=STRING),
    "part": record(p_partkey=LONG, p_type=STRING, p_retailprice=DOUBLE),
    "events": record(event_id=LONG, ts=INSTANT, props=STRING),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _account(share: Column) -> Column:
    return F.concat(F.lit("ACC00"), share)


def _share() -> Column:
    """Which of the accounts a customer's orders go to."""
    return F.col("o_custkey") % 5


def _line_id() -> Column:
    return F.concat_ws("_", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def _position() -> list[Column]:
    """Broker position of a line item: a millisecond per order, a partition per line.

    The shipping day goes into the microseconds and tells apart items that share all keys.
    """
    day = F.pmod(F.unix_date(F.col("l_shipdate").cast("date")), F.lit(1000))
    arrived = F.timestamp_millis(BROKER_EPOCH_MILLIS + F.col("l_orderkey"))
    return [
        (arrived + day * F.expr("INTERVAL '0.000001' SECOND")).alias("arrived_at"),
        F.col("l_linenumber").alias("partition"),
        (F.col("l_partkey") * 2**31 + F.col("l_suppkey")).alias("offset"),
    ]


def _traded_at() -> Column:
    offset = F.col("l_linenumber") * 3600 + F.col("l_suppkey") % 3600
    return F.timestamp_add("SECOND", offset.cast("int"), F.col("l_shipdate"))


def _unit_price() -> Column:
    return F.col("p_retailprice") * (F.lit(0.95) + F.col("l_discount"))


def trade_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades as they arrive: raw columns plus the ``seq`` that orders arrival.

    Both joins look up by a key of the smaller table. They are hashed, so that line items, the
    widest and longest input, are dealt out but never sorted. What a column of one table stands
    for is taken before the joins, where it is shorter than the column.
    """
    side = F.when(F.col("l_returnflag") == "R", "sell").otherwise("buy")
    side = F.when(F.col("l_linestatus") == "O", side).otherwise(F.upper(side))
    lines = table(spark, sf_dir, "lineitem").withColumn("side", side)
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", _share().alias("share")).hint("shuffle_hash")
    parts = table(spark, sf_dir, "part").hint("shuffle_hash")
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.concat(F.lit("TRD_"), _line_id()).alias("trade_id"),
            _account(F.col("share")).alias("account_id"),
            F.col("p_type").alias("symbol"),
            "side",
            F.col("l_quantity").alias("quantity"),
            _unit_price().alias("price"),
            _traded_at().alias("timestamp"),
            F.lit(VERSION).alias("event_version"),
            _line_id().alias("seq"),
            *_position(),
            "l_tax",
        )
    )


def price_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks before the upsert, with ``seq`` as their arrival order."""
    lines = table(spark, sf_dir, "lineitem")
    parts = table(spark, sf_dir, "part").hint("shuffle_hash")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("p_type").alias("symbol"),
        _unit_price().alias("price"),
        _traded_at().alias("timestamp"),
        F.when(F.col("l_linestatus") != "O", "sim").alias("source"),
        F.lit(VERSION).alias("event_version"),
        _line_id().alias("seq"),
        *_position(),
    )


def cash_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cash movements, one per order."""
    kind = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "withdrawal")
        .when(F.col("o_orderpriority") == "5-LOW", "DIVIDEND")
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "INTEREST")
        .otherwise("DEPOSIT")
    )
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("CASH_"), F.col("o_orderkey")).alias("event_id"),
        _account(_share()).alias("account_id"),
        F.col("o_totalprice").alias("amount"),
        kind.alias("type"),
        F.col("o_orderdate").alias("timestamp"),
        F.col("o_orderpriority").alias("description"),
        F.lit(VERSION).alias("event_version"),
        F.timestamp_millis(BROKER_EPOCH_MILLIS + F.col("o_orderkey")).alias("arrived_at"),
        F.lit(0).alias("partition"),
        F.col("o_orderkey").alias("offset"),
    )


def raw_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_raw(trade_feed(spark, sf_dir), RAW_TRADES)


def raw_cash_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_raw(cash_feed(spark, sf_dir), RAW_CASH_EVENTS)


def raw_price_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ticks, superseded ones too, in the raw layout plus ``seq``."""
    return with_defaults(price_feed(spark, sf_dir)).select(*RAW_PRICES.columns, "seq")


def raw_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks after the upsert: newest price, first source, one row per symbol and instant."""
    log = raw_price_log(spark, sf_dir)
    resolved = resolve_upserts(log, RAW_PRICES.key, ["seq"], ["price"])
    return resolved.select(*RAW_PRICES.columns)


def messages(feed: DataFrame, message: T.StructType, key: str, *carried: str) -> DataFrame:
    """A feed as the broker envelopes its producer would have sent, and ``carried`` columns."""
    body = F.struct(*[
        F.col(field.name) if field.name != "timestamp"
        else to_millis(F.col("timestamp")).alias("timestamp") for field in message])
    return feed.select(
        F.encode(key, "UTF-8").alias("key"),
        F.encode(F.to_json(body), "UTF-8").alias("value"),
        F.lit(None).cast("string").alias("topic"),
        "partition", "offset",
        F.col("arrived_at").alias("timestamp"),
        *carried,
    )
