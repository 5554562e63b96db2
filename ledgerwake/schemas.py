"""Wire messages, raw tables and the constraints that guard them."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

STRING, DOUBLE, LONG, INTEGER = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType()
INSTANT, ZONED = T.TimestampNTZType(), T.TimestampType()


def record(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# --- fixed values: field names, types and enum members of the data model -----------------

SIDES = ("BUY", "SELL")
CASH_INFLOWS = ("DEPOSIT", "DIVIDEND", "INTEREST")
CASH_OUTFLOWS = ("WITHDRAWAL",)
CASH_TYPES = ("DEPOSIT", "WITHDRAWAL", "DIVIDEND", "INTEREST")

TRADE_MESSAGE = record(
    trade_id=STRING, account_id=STRING, symbol=STRING, side=STRING, quantity=DOUBLE,
    price=DOUBLE, timestamp=LONG, event_version=STRING,
)
PRICE_MESSAGE = record(
    symbol=STRING, price=DOUBLE, timestamp=LONG, source=STRING, event_version=STRING,
)
CASH_MESSAGE = record(
    event_id=STRING, account_id=STRING, amount=DOUBLE, type=STRING, timestamp=LONG,
    description=STRING, event_version=STRING,
)

RAW_TRADES_SCHEMA = record(
    trade_id=STRING, account_id=STRING, symbol=STRING, side=STRING, quantity=DOUBLE,
    price=DOUBLE, timestamp=INSTANT, event_version=STRING, ingestion_time=ZONED,
)
RAW_PRICES_SCHEMA = record(
    symbol=STRING, price=DOUBLE, timestamp=INSTANT, source=STRING, event_version=STRING,
    ingestion_time=ZONED,
)
RAW_CASH_SCHEMA = record(
    event_id=STRING, account_id=STRING, amount=DOUBLE, type=STRING, timestamp=INSTANT,
    description=STRING, event_version=STRING, ingestion_time=ZONED,
)

# --- end of fixed values -----------------------------------------------------------------

# What the broker hands over for one message. Partition and offset give every message a
# unique position, which is what orders an upsert and what identifies a broken message.
ENVELOPE = record(
    key=T.BinaryType(), value=T.BinaryType(), topic=STRING, partition=INTEGER,
    offset=LONG, timestamp=ZONED,
)


def one_of(column: str, values: tuple[str, ...]) -> str:
    listed = ", ".join(f"'{value}'" for value in values)
    return f"{column} IN ({listed})"


@dataclass(frozen=True)
class RawTable:
    """A landing table: declared schema, primary key, NOT NULL columns and CHECKs.

    A second row of a key is refused, or, if there are ``overwritten`` columns, replaces them.
    """

    name: str
    schema: T.StructType
    key: tuple[str, ...]
    required: tuple[str, ...]
    checks: dict[str, str] = field(default_factory=dict)
    overwritten: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


RAW_TRADES = RawTable(
    name="raw_trades",
    schema=RAW_TRADES_SCHEMA,
    key=("trade_id",),
    required=("trade_id", "account_id", "symbol", "side", "quantity", "price", "timestamp"),
    checks={
        "side": one_of("side", SIDES),
        "quantity": "quantity > 0",
        "price": "price > 0",
    },
)
RAW_PRICES = RawTable(
    name="raw_prices",
    schema=RAW_PRICES_SCHEMA,
    key=("symbol", "timestamp"),
    required=("symbol", "price", "timestamp"),
    checks={"price": "price > 0"},
    overwritten=("price",),
)
RAW_CASH_EVENTS = RawTable(
    name="raw_cash_events",
    schema=RAW_CASH_SCHEMA,
    key=("event_id",),
    required=("event_id", "account_id", "amount", "type", "timestamp"),
    checks={"type": one_of("type", CASH_TYPES)},
)
RAW_TABLES = {table.name: table for table in (RAW_TRADES, RAW_PRICES, RAW_CASH_EVENTS)}
