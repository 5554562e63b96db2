"""Run the feeds as long-lived jobs: ``python -m ledgerwake.streaming.run --help``."""

from __future__ import annotations

import argparse
import logging
import sys
import threading
import uuid
from collections.abc import Iterable

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ledgerwake.session import build_session
from ledgerwake.sources import landing
from ledgerwake.sources.landing import rows_landed
from ledgerwake.streaming.feeds import FEEDS
from ledgerwake.streaming.sinks import start_feed

log = logging.getLogger("ledgerwake.feeds")

# Keeps the first batch of a long topic from being the whole topic.
MAX_OFFSETS = 5_000_000
# Batches a log may have before they are folded into its base: an hour at the usual trigger.
COMPACT_AFTER = 360


def places(root: str, name: str) -> tuple[str, str]:
    """Landing folder and checkpoint of a feed."""
    table = FEEDS[name].table.name
    return f"{root}/{table}", f"{root}/checkpoints/{table}"


def start(
    spark: SparkSession, names: list[str], source: dict, root: str, every: str,
) -> dict[str, StreamingQuery]:
    """Start the named feeds, each with its own checkpoint.

    All messages are appended. Duplicates cannot get through: ``load_raw`` keeps one row for
    each key.
    """
    return {
        name: start_feed(spark, FEEDS[name], source, *places(root, name),
                         trigger={"processingTime": every}, name=f"{name}-{uuid.uuid4().hex[:8]}")
        for name in names
    }


class Watch(StreamingQueryListener):
    """Counts what each query takes in and reports its end the moment Spark tells of it."""

    def __init__(self) -> None:
        self.rows: dict[str, int] = {}
        self.ended: dict[str, str | None] = {}  # query id -> what it failed with
        self.changed = threading.Event()

    def onQueryStarted(self, event) -> None:
        self.rows.setdefault(str(event.id), 0)

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        key = str(progress.id)
        self.rows[key] = self.rows.get(key, 0) + progress.numInputRows

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended[str(event.id)] = event.exception
        self.changed.set()


def compact_tail(spark: SparkSession, names: Iterable[str], root: str, batches: int) -> list[str]:
    """Compact every log that has ``batches`` batches or more to fold; returns their feeds."""
    done = []
    for name in names:
        path, _ = places(root, name)
        if landing.unfolded(spark, path) >= batches:
            landing.compact(spark, path, FEEDS[name].table)
            log.info("%s compacted", name)
            done.append(name)
    return done


class Supervisor:
    """Looks after running feeds: reports each end at once, and compacts logs that grow long.

    A feed that fails does not stop the others. ``failed`` holds the names of those that did,
    also after an interrupt.
    """

    def __init__(self, spark: SparkSession, root: str, every: float = 5.0,
                 compact_after: int = 0) -> None:
        self.spark, self.root = spark, root
        self.every, self.compact_after = every, compact_after
        self.failed: list[str] = []
        self.open: dict[str, StreamingQuery] = {}
        self.watch = Watch()
        spark.streams.addListener(self.watch)

    def start(self, names: list[str], source: dict, every: str) -> dict[str, StreamingQuery]:
        """Start feeds and look after them from their first batch on."""
        started = start(self.spark, names, source, self.root, every)
        self.open |= started
        return started

    def taken(self, query: StreamingQuery) -> int:
        """Messages a query has taken in since it was started."""
        return self.watch.rows.get(str(query.id), 0)

    def look(self) -> list[str]:
        """Report the feeds that have ended since the last look."""
        ended = [name for name, query in self.open.items() if not query.isActive]
        for name in ended:
            error = self.open.pop(name).exception()
            if error is not None:
                self.failed.append(name)
                log.error("%s failed: %s", name, error)
            log.info("%s ended with %d messages landed", name,
                     rows_landed(self.spark, *places(self.root, name)))
        return ended

    def run(self) -> list[str]:
        """Return the feeds that failed, once all have ended."""
        try:
            while self.open:
                # Set by the listener when any query ends; the time limit is for compaction.
                self.watch.changed.wait(self.every)
                self.watch.changed.clear()
                self.look()
                if self.compact_after:
                    compact_tail(self.spark, self.open, self.root, self.compact_after)
        finally:
            self.close()
        return self.failed

    def stop(self) -> None:
        for query in self.open.values():
            query.stop()
        self.look()

    def close(self) -> None:
        self.spark.streams.removeListener(self.watch)


def wait(spark: SparkSession, queries: dict[str, StreamingQuery], root: str) -> list[str]:
    """Wait for every feed; one that fails does not stop the others. Returns the failed."""
    feeds = Supervisor(spark, root)
    feeds.open |= queries
    return feeds.run()


def source_options(args: argparse.Namespace) -> dict[str, str]:
    """Source settings of the command line."""
    source = {"fmt": "kafka", "kafka.bootstrap.servers": args.brokers,
              "failOnDataLoss": str(args.fail_on_data_loss).lower()}
    if args.max_offsets:
        source["maxOffsetsPerTrigger"] = str(args.max_offsets)
    return source


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--feeds", nargs="+", choices=list(FEEDS), default=list(FEEDS))
    parser.add_argument("--brokers", required=True, help="Kafka bootstrap servers")
    parser.add_argument("--root", required=True, help="shared folder of the landing tables")
    parser.add_argument("--every", default="10 seconds", help="trigger interval")
    parser.add_argument("--max-offsets", type=int, default=MAX_OFFSETS,
                        help="most messages in a batch of a feed; 0 for no limit")
    parser.add_argument("--compact-after", type=int, default=COMPACT_AFTER,
                        help="batches after which a log is compacted; 0 for never")
    parser.add_argument("--fail-on-data-loss", action="store_true",
                        help="stop when messages aged out before they were read")
    return parser


def main() -> None:
    args = arguments().parse_args()
    logging.basicConfig(level=logging.INFO)
    spark = build_session("ledgerwake-feeds")
    feeds = Supervisor(spark, args.root, compact_after=args.compact_after)
    try:
        feeds.start(args.feeds, source_options(args), args.every)
        feeds.run()
    except KeyboardInterrupt:
        feeds.stop()
    spark.stop()
    sys.exit(1 if feeds.failed else 0)


if __name__ == "__main__":
    main()
