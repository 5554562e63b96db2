"""The streaming sink: good and bad messages go to one append-only landing log.

Each micro-batch is written to a folder of its own and counts once that is complete, so a batch
that is delivered again after a failure lands once. What the rows of a key add up to (first
arrival, newest price) is decided by the readers in :mod:`ledgerwake.sources.landing`, over all
runs and batches. No rows reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerwake.operators.writes import tag_violations
from ledgerwake.sources.landing import BAD, OK, run_folder, write_batch
from ledgerwake.streaming.feeds import Feed, decode_json, read_events

EVERY_10_SECONDS = {"processingTime": "10 seconds"}
ONCE = {"availableNow": True}


def land(
    df: DataFrame, folder: str, checkpoint: str, trigger: dict = EVERY_10_SECONDS, name: str = "",
) -> StreamingQuery:
    """Write each micro-batch of ``df``, which has a ``verdict``, below ``folder``."""
    writer = df.writeStream.foreachBatch(
        lambda batch, number: write_batch(batch, folder, number)).option(
        "checkpointLocation", checkpoint).trigger(**trigger)
    return (writer.queryName(name) if name else writer).start()


def start_feed(
    spark: SparkSession,
    feed: Feed,
    source: dict,
    path: str,
    checkpoint: str,
    trigger: dict = EVERY_10_SECONDS,
    name: str = "",
) -> StreamingQuery:
    """Run one feed: source, decode, conform, verdict, append.

    Good and bad messages leave through one sink, split by the ``verdict`` folder, so the
    source is read once and no message is lost: copies and late rows land, too. The payload
    is kept for bad ones only. Any number of checkpoints may write to one ``path``.
    """
    rows = feed.conform(decode_json(read_events(spark, feed.topic, **source), feed.message))
    judged = (
        tag_violations(rows, feed.table)
        .withColumn("payload", F.when(F.col("violation").isNotNull(), F.col("payload")))
        .withColumn("verdict", F.when(F.col("violation").isNull(), OK).otherwise(BAD))
    )
    return land(judged, run_folder(spark, path, checkpoint), checkpoint, trigger, name)
