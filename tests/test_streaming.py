"""Streams replayed from recorded broker envelopes."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from ledgerwake.schemas import ENVELOPE, RAW_TRADES
from ledgerwake.sources import landing
from ledgerwake.sources.raw import load_raw
from ledgerwake.streaming import feeds, sinks
from tests.helpers import rows

TRADES, PRICES = feeds.FEEDS["trades"], feeds.FEEDS["prices"]
MORNING = dt.datetime(2024, 1, 1, 9, tzinfo=dt.timezone.utc)


def trade(n, **changes):
    body = {"trade_id": f"t{n}", "account_id": "A", "symbol": "X", "side": "BUY",
            "quantity": 1.0, "price": 2.0, "timestamp": 1704103200123 + n}
    return json.dumps({**body, **changes})


def tick(symbol, price, source, day=1):
    return json.dumps({"symbol": symbol, "price": price, "source": source,
                       "timestamp": 1704067200000 + (day - 1) * 86_400_000})


class Topic:
    """A folder of envelopes; each :meth:`send` adds one file."""

    def __init__(self, spark, path):
        self.spark, self.path, self.offset = spark, str(path), 0
        self.source = {"fmt": "parquet", "path": self.path}

    def send(self, *values, minutes=0):
        when = MORNING + dt.timedelta(minutes=minutes)
        data = []
        for value in values:
            body = None if value is None else bytearray(value, "utf-8")
            data.append((bytearray(b"k"), body, "topic", 0, self.offset, when))
            self.offset += 1
        self.spark.createDataFrame(data, ENVELOPE).coalesce(1).write.mode("append").parquet(
            self.path)
        return self


@pytest.fixture
def topic(spark, tmp_path):
    return Topic(spark, tmp_path / "topic")


def land(spark, tmp_path, topic, feed=TRADES, checkpoint="checkpoint", **options):
    """Run a feed to its end; return its folder, below which ``load_raw`` finds it."""
    out = str(tmp_path / "root" / feed.table.name)
    query = sinks.start_feed(spark, feed, {**topic.source, **options}, out,
                             str(tmp_path / checkpoint), sinks.ONCE)
    query.awaitTermination()
    return out, query


def loaded(spark, tmp_path, name):
    return load_raw(spark, str(tmp_path / "root"))[name]


def test_feed_lands_decoded_rows_with_milliseconds(spark, tmp_path, topic):
    topic.send(trade(1), trade(2, event_version="2.0"))
    out, query = land(spark, tmp_path, topic)
    landed = landing.landed(spark, out, RAW_TRADES)
    assert landed.columns == RAW_TRADES.columns
    assert landed.schema["timestamp"].dataType.typeName() == "timestamp_ntz"
    assert rows(landed, "trade_id", "timestamp", "event_version") == [
        ("t1", dt.datetime(2024, 1, 1, 10, 0, 0, 124000), None),
        ("t2", dt.datetime(2024, 1, 1, 10, 0, 0, 125000), "2.0")]
    assert landed.filter("ingestion_time is null").count() == 0
    assert landing.rows_landed(spark, out, str(tmp_path / "checkpoint")) == 2


def test_restart_on_the_same_checkpoint_adds_only_what_is_new(spark, tmp_path, topic):
    topic.send(trade(1))
    land(spark, tmp_path, topic)
    land(spark, tmp_path, topic)
    topic.send(trade(2))
    out, _ = land(spark, tmp_path, topic)
    assert rows(landing.landed(spark, out, RAW_TRADES), "trade_id") == [("t1",), ("t2",)]


def test_bad_messages_are_set_aside_whole(spark, tmp_path, topic):
    cut = trade(2)[:50]
    topic.send(trade(1), cut, None, "[]", trade(3, quantity=-1), trade(4, side="buy"),
               trade(5, timestamp=2**62), trade(6, price="dear"), trade(7, symbol=None))
    out, _ = land(spark, tmp_path, topic)
    assert rows(landing.landed(spark, out, RAW_TRADES), "trade_id") == [("t1",)]
    bad = {r.offset: (r.violation, r.payload) for r in landing.quarantined(spark, out).collect()}
    assert {k: v[0] for k, v in bad.items()} == {
        1: "not_null:trade_id", 2: "not_null:trade_id", 3: "not_null:trade_id",
        4: "check:quantity", 5: "check:side", 6: "not_null:timestamp", 7: "not_null:price",
        8: "not_null:symbol"}
    assert bad[1][1] == cut and bad[2][1] is None


def test_split_bad_keeps_every_row_of_a_batch(spark, topic):
    topic.send(trade(1), "oops")
    decoded = feeds.decode_json(spark.read.parquet(topic.path), TRADES.message)
    good, bad = feeds.split_bad(TRADES.conform(decoded), TRADES.table)
    assert rows(good, "trade_id") == [("t1",)]
    assert rows(bad, "payload", "violation") == [("oops", "not_null:trade_id")]


def test_copies_land_and_are_read_once_however_late(spark, tmp_path, topic):
    topic.send(trade(1), trade(1, price=9.0), "bad", "bad")
    land(spark, tmp_path, topic)
    topic.send(trade(1), trade(2), "bad", minutes=100_000)
    # A key never seen before, with a broker time long before all the others.
    topic.send(trade(3), minutes=-100_000)
    out, _ = land(spark, tmp_path, topic)
    assert landing.landed(spark, out, RAW_TRADES).count() == 5
    assert rows(landing.resolved(spark, out, RAW_TRADES), "trade_id", "price") == [
        ("t1", 2.0), ("t2", 2.0), ("t3", 2.0)]
    assert rows(landing.tagged(spark, out, RAW_TRADES), "trade_id", "price", "is_new") == [
        ("t1", 2.0, False), ("t1", 2.0, True), ("t1", 9.0, False), ("t2", 2.0, True),
        ("t3", 2.0, True)]
    assert rows(loaded(spark, tmp_path, "raw_trades"), "trade_id") == [("t1",), ("t2",), ("t3",)]
    assert landing.quarantined(spark, out).count() == 3


@pytest.mark.parametrize("feed", [TRADES, PRICES])
def test_a_new_checkpoint_adds_to_what_has_landed(spark, tmp_path, topic, feed):
    make = trade if feed is TRADES else lambda n: tick(f"S{n}", 1.0 + n, None)
    topic.send(*map(make, range(5)), "bad")
    land(spark, tmp_path, topic, feed)
    second = Topic(spark, tmp_path / "second")
    second.offset = topic.offset
    second.send(*map(make, range(5, 8)), "worse")
    out, _ = land(spark, tmp_path, second, feed, checkpoint="other")
    assert loaded(spark, tmp_path, feed.table.name).count() == 8
    assert rows(landing.quarantined(spark, out), "payload") == [("bad",), ("worse",)]
    assert len(landing.runs(spark, out)) == 2
    assert [landing.rows_landed(spark, out, str(tmp_path / c)) for c in (
        "checkpoint", "other", "none")] == [6, 4, 0]


def test_an_emptied_checkpoint_replays_without_losing_or_doubling(spark, tmp_path, topic):
    topic.send(trade(1), trade(2))
    land(spark, tmp_path, topic)
    topic.send(trade(3))
    out, _ = land(spark, tmp_path, topic, checkpoint="fresh")
    assert landing.landed(spark, out, RAW_TRADES).count() == 5
    assert rows(loaded(spark, tmp_path, "raw_trades"), "trade_id") == [("t1",), ("t2",), ("t3",)]


def test_upserts_keep_first_source_and_newest_price(spark, tmp_path, topic):
    def run():
        land(spark, tmp_path, topic, PRICES)
        return loaded(spark, tmp_path, "raw_prices")

    topic.send(tick("X", 1.0, "a"), tick("X", 2.0, "b"), tick("Y", 5.0, None, day=2))
    assert rows(run(), "symbol", "price", "source") == [("X", 2.0, "a"), ("Y", 5.0, None)]
    topic.send(tick("X", 3.0, "c"), tick("X", 9.0, "d", day=3), tick("X", -1.0, "e"), minutes=1)
    expected = [("X", 3.0, "a"), ("X", 9.0, "d"), ("Y", 5.0, None)]
    assert rows(run(), "symbol", "price", "source") == expected
    assert rows(run(), "symbol", "price", "source") == expected
    refused = landing.quarantined(spark, str(tmp_path / "root" / "raw_prices"))
    assert rows(refused, "violation") == [("check:price",)]


def test_the_result_does_not_depend_on_where_batches_are_cut(spark, tmp_path, topic):
    # Broker times run against the offsets.
    for n, minutes in enumerate((30, 10, 20, 5, 25)):
        topic.send(tick("X", 1.0 + n, f"s{n}"), tick("Y", 10.0 - n, None), minutes=minutes)
    out, whole = land(spark, tmp_path, topic, PRICES)
    cut = str(tmp_path / "cut")
    query = sinks.start_feed(spark, PRICES, {**topic.source, "maxFilesPerTrigger": "1"}, cut,
                             str(tmp_path / "cut-checkpoint"), sinks.ONCE)
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p["numInputRows"]]) >= 4
    assert len([p for p in whole.recentProgress if p["numInputRows"]]) == 1
    read = [rows(landing.resolved(spark, path, PRICES.table), "symbol", "price", "source")
            for path in (out, cut)]
    assert read[0] == read[1] == [("X", 1.0, "s3"), ("Y", 10.0, None)]


def test_a_batch_reads_and_writes_its_own_rows_only(spark, tmp_path, topic):
    def files():
        return {str(p) for p in (tmp_path / "root").rglob("*.parquet") if "run=" in str(p)}

    for n in range(4):
        before = files()
        topic.send(tick("X", 1.0 + n, None))
        _, query = land(spark, tmp_path, topic, PRICES)
        assert sum(p["numInputRows"] for p in query.recentProgress) == 1
        assert len(files() - before) == 1 and before <= files()


def test_an_empty_batch_leaves_no_trace(spark, tmp_path, topic):
    topic.send(trade(1))
    out, _ = land(spark, tmp_path, topic)
    before = sorted(p for p in (tmp_path / "root").rglob("*") if p.is_file())
    land(spark, tmp_path, topic)
    assert sorted(p for p in (tmp_path / "root").rglob("*") if p.is_file()) == before


def test_a_landing_folder_without_rows_is_an_empty_table(spark, tmp_path):
    out, checkpoint = str(tmp_path / "root" / "raw_trades"), str(tmp_path / "checkpoint")
    first = landing.run_folder(spark, out, checkpoint)
    assert landing.run_folder(spark, out, checkpoint) == first
    assert loaded(spark, tmp_path, "raw_trades").count() == 0
    assert loaded(spark, tmp_path, "raw_trades").schema == RAW_TRADES.schema
    with pytest.raises(ValueError, match="nothing has landed"):
        landing.quarantined(spark, out)


def test_three_feeds_run_side_by_side_and_stop(spark, tmp_path):
    queries = []
    for name, feed in feeds.FEEDS.items():
        topic = Topic(spark, tmp_path / name)
        topic.send("{}")
        queries.append(sinks.start_feed(
            spark, feed, topic.source, str(tmp_path / f"{name}-out"),
            str(tmp_path / f"{name}-cp"), {"processingTime": "1 second"}))
    for query in queries:
        query.processAllAvailable()
        assert query.isActive
        query.stop()
        assert not query.isActive
    assert {f.topic for f in feeds.FEEDS.values()} == {
        "trade_events", "price_events", "cash_events"}
    for name in feeds.FEEDS:
        assert rows(landing.log(spark, str(tmp_path / f"{name}-out")), "verdict") == [("bad",)]


def test_late_events_are_right_after_the_next_build(spark, tmp_path, topic):
    from ledgerwake.plans import intermediate, staging

    topic.send(trade(1, timestamp=1704499200000))
    land(spark, tmp_path, topic)
    topic.send(trade(2, timestamp=1704067200000), minutes=5)
    out, _ = land(spark, tmp_path, topic)
    days = intermediate.int_trade_days(staging.stg_trades(landing.landed(spark, out, RAW_TRADES)))
    assert rows(days, F.col("trade_date").cast("string")) == [("2024-01-01",), ("2024-01-06",)]


def test_a_failing_feed_leaves_the_others_running(spark, tmp_path):
    from ledgerwake.streaming import run

    good, broken = Topic(spark, tmp_path / "good"), Topic(spark, tmp_path / "broken")
    good.send(trade(1))
    broken.send(trade(1))
    # A file that is not Parquet makes only this feed's scan fail.
    (tmp_path / "broken" / "junk.parquet").write_text("not parquet")
    queries = {
        "trades": run.start(spark, ["trades"], good.source, str(tmp_path / "a"), "1 second"),
        "cash": run.start(spark, ["cash"], broken.source, str(tmp_path / "b"), "1 second"),
    }
    assert run.wait(spark, queries["cash"], str(tmp_path / "b")) == ["cash"]
    alive = queries["trades"]["trades"]
    assert alive.isActive
    alive.processAllAvailable()
    alive.stop()
    assert load_raw(spark, str(tmp_path / "a"))["raw_trades"].count() == 1


def test_runner_flags_reach_the_source():
    from ledgerwake.streaming import run

    args = run.arguments().parse_args(["--brokers", "h:1", "--root", "/r"])
    assert run.source_options(args) == {
        "fmt": "kafka", "kafka.bootstrap.servers": "h:1", "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": str(run.MAX_OFFSETS)}
    args = run.arguments().parse_args(
        ["--brokers", "h:1", "--root", "/r", "--max-offsets", "0", "--fail-on-data-loss"])
    assert run.source_options(args) == {
        "fmt": "kafka", "kafka.bootstrap.servers": "h:1", "failOnDataLoss": "true"}
