"""The three feeds and the steps from broker message to raw row."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerwake import schemas as S
from ledgerwake.functions.scalar import from_millis
from ledgerwake.operators.writes import violation
from ledgerwake.sources.landing import POSITION

# Columns that travel with a decoded message but belong to no raw table.
TRANSPORT = [*POSITION, "kafka_timestamp", "payload"]


@dataclass(frozen=True)
class Feed:
    """Topic, message schema and landing table of one feed."""

    topic: str
    message: T.StructType
    table: S.RawTable
    conform: Callable[[DataFrame], DataFrame]


def read_events(
    spark: SparkSession, topic: str, fmt: str = "kafka", path: str | None = None,
    sent: Callable[[DataFrame], DataFrame] | None = None, **options: str,
) -> DataFrame:
    """Stream of broker envelopes.

    ``kafka`` subscribes to the topic from its beginning and tolerates aged-out offsets
    unless ``failOnDataLoss`` says otherwise; ``maxOffsetsPerTrigger`` bounds a batch. Any
    file format replays recorded envelopes from ``path`` with the same columns, in batches of
    ``maxFilesPerTrigger`` files; ``sent`` makes of them what the broker delivers, say, each twice.
    """
    if fmt == "kafka":
        settings = {"subscribe": topic, "startingOffsets": "earliest", "failOnDataLoss": "false"}
        return spark.readStream.format("kafka").options(**{**settings, **options}).load()
    recorded = spark.readStream.format(fmt).schema(S.ENVELOPE).options(**options).load(path)
    return recorded if sent is None else sent(recorded)


def decode_json(df: DataFrame, message: T.StructType) -> DataFrame:
    """Unpack JSON values. A broken message becomes a row of NULL fields with its payload."""
    text = F.col("value").cast("string")
    return (
        df.select(
            F.from_json(text, message).alias("data"),
            "partition", "offset",
            F.col("timestamp").alias("kafka_timestamp"),
            text.alias("payload"),
        )
        .select("data.*", *TRANSPORT)
        .withColumn("ingestion_time", F.current_timestamp())
    )


def _conform(table: S.RawTable) -> Callable[[DataFrame], DataFrame]:
    """Epoch to timestamp, raw columns in raw order, transport columns behind them."""

    def conform(df: DataFrame) -> DataFrame:
        carried = [c for c in TRANSPORT if c in df.columns]
        return df.withColumn("timestamp", from_millis(F.col("timestamp"))).select(
            *table.columns, *carried)

    return conform


conform_trades = _conform(S.RAW_TRADES)
conform_prices = _conform(S.RAW_PRICES)
conform_cash = _conform(S.RAW_CASH_EVENTS)

FEEDS = {
    "trades": Feed("trade_events", S.TRADE_MESSAGE, S.RAW_TRADES, conform_trades),
    "prices": Feed("price_events", S.PRICE_MESSAGE, S.RAW_PRICES, conform_prices),
    "cash": Feed("cash_events", S.CASH_MESSAGE, S.RAW_CASH_EVENTS, conform_cash),
}


def split_bad(df: DataFrame, table: S.RawTable) -> tuple[DataFrame, DataFrame]:
    """Rows the raw table accepts, and the others with their payload and the reason."""
    tagged = df.withColumn("violation", violation(table))
    good = tagged.filter(F.col("violation").isNull()).select(*table.columns)
    bad = tagged.filter(F.col("violation").isNotNull()).select(
        *POSITION, "kafka_timestamp", "payload", "violation")
    return good, bad
