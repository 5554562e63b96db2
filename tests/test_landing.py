"""Compaction of landing logs, tables with several writers, and supervision of feeds."""

from __future__ import annotations

import random
import re
import time

from ledgerwake.operators.writes import key_states, merge_states, resolve_upserts
from ledgerwake.schemas import RAW_PRICES, RAW_TRADES
from ledgerwake.sources import files, landing
from ledgerwake.sources.raw import create_raw_tables, load_raw
from ledgerwake.streaming import run
from tests.helpers import rows
from tests.test_streaming import PRICES, TRADES, Topic, land, loaded, tick, topic, trade  # noqa: F401


def read(spark, out, table=RAW_TRADES):
    return rows(landing.resolved(spark, out, table), *[
        c for c in table.columns if c != "ingestion_time"])


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_compaction_changes_nothing_a_reader_sees(spark, tmp_path, topic):  # noqa: F811
    draw = random.Random(2)
    for step in range(6):
        sent = [trade(draw.randrange(30), price=float(draw.randrange(1, 9))) for _ in range(12)]
        topic.send(*sent, "bad", minutes=draw.randrange(-500, 500))
        out, _ = land(spark, tmp_path, topic)
        before = read(spark, out)
        if step % 2:
            landing.compact(spark, out, RAW_TRADES, bucket_rows=10)
            assert landing.unfolded(spark, out) == 0
        assert read(spark, out) == before
        assert rows(loaded(spark, tmp_path, "raw_trades"), "trade_id") == [(r[0],) for r in before]
    assert landing.quarantined(spark, out).count() == 6
    assert landing.rows_landed(spark, out, str(tmp_path / "checkpoint")) == 6 * 13
    known = landing.manifest(spark, out)
    assert known.version == 3 and known.rows == len(before) and known.buckets > 1
    assert len(landing.runs(spark, out)) == 1


def test_upserts_are_the_same_over_a_base(spark, tmp_path, topic):  # noqa: F811
    draw = random.Random(3)
    for step in range(6):
        sent = [tick(f"S{draw.randrange(9)}", float(draw.randrange(1, 99)), f"s{step}",
                     draw.randrange(1, 4)) for _ in range(15)]
        topic.send(*sent, minutes=draw.randrange(-500, 500))
        out, _ = land(spark, tmp_path, topic, PRICES)
        before = read(spark, out, RAW_PRICES)
        if step in (1, 2, 4):
            landing.compact(spark, out, RAW_PRICES)
        assert read(spark, out, RAW_PRICES) == before


def test_states_of_parts_merge_to_the_state_of_the_whole(spark):
    draw = random.Random(4)
    log = spark.createDataFrame(
        [(draw.randrange(8), f"a{n}", draw.random(), draw.randrange(50), n) for n in range(200)],
        "k int, a string, price double, t int, n int")
    for overwritten in ((), ("price",)):
        states = [key_states(log.filter(part), ["k"], ["t", "n"], overwritten)
                  for part in ("n < 90", "n >= 90")]
        merged = merge_states(*states, ["k"], ["t", "n"], overwritten)
        whole = key_states(log, ["k"], ["t", "n"], overwritten)
        assert merged.columns == whole.columns and rows(merged, *whole.columns) == rows(
            whole, *whole.columns)
        assert rows(merged, "k", "a", "price") == rows(
            resolve_upserts(log, ["k"], ["t", "n"], overwritten), "k", "a", "price")


def test_the_base_is_read_without_a_shuffle(spark, tmp_path, topic):  # noqa: F811
    topic.send(*[trade(n) for n in range(50)])
    out, _ = land(spark, tmp_path, topic)
    landing.compact(spark, out, RAW_TRADES, bucket_rows=10)
    topic.send(*[trade(n) for n in range(40, 60)])
    land(spark, tmp_path, topic)
    df = landing.resolved(spark, out, RAW_TRADES)
    assert df.count() == 60
    lines = plan(df).split("\n")
    assert "FullOuter" in plan(df)
    (at,) = [i for i, x in enumerate(lines) if "ledgerwake_bases" in x]
    assert f"SelectedBucketsCount: {landing.manifest(spark, out).buckets} out of" in lines[at]
    depth = re.search("[A-Z]", lines[at]).start()
    for line in reversed(lines[:at]):
        here = re.search("[A-Z]", line).start()
        if here < depth:
            depth = here
            assert "Exchange" not in line


def test_files_of_a_read_stay_bounded(spark, tmp_path, topic):  # noqa: F811
    topic.send(trade(0))
    out, _ = land(spark, tmp_path, topic)
    most = 0
    for n in range(1, 50):
        batch = spark.createDataFrame(
            [(f"t{n % 20}", "A", "X", "BUY", 1.0, 2.0, None, "1", None, 0, n, None, None, None,
              "ok")],
            "trade_id string, account_id string, symbol string, side string, quantity double, "
            "price double, timestamp timestamp_ntz, event_version string, "
            "ingestion_time timestamp, partition int, offset bigint, kafka_timestamp timestamp, "
            "payload string, violation string, verdict string")
        landing.write_batch(batch, landing.run_folder(spark, out, str(tmp_path / "other")), n)
        if landing.unfolded(spark, out) >= 10:
            landing.compact(spark, out, RAW_TRADES)
        found = landing.resolved(spark, out, RAW_TRADES)
        most = max(most, len(found.inputFiles()))
    # The base has one bucket; beside it lie ten batches at most.
    assert most <= 12 and found.count() == 20
    on_disk = [p for p in (tmp_path / "root").rglob("*.parquet")]
    assert len(on_disk) < 40


def test_a_reader_finds_all_rows_between_the_steps(spark, tmp_path, topic, monkeypatch):  # noqa: F811
    topic.send(*map(trade, range(5)))
    out, _ = land(spark, tmp_path, topic)
    landing.compact(spark, out, RAW_TRADES)
    topic.send(*map(trade, range(3, 9)))
    land(spark, tmp_path, topic)
    early = landing.resolved(spark, out, RAW_TRADES)
    want, seen = [(f"t{n}",) for n in range(9)], []

    def look(name, after=True):
        step = getattr(files if hasattr(files, name) else landing, name)

        def stepped(*args, **more):
            seen.append((name, rows(landing.resolved(spark, out, RAW_TRADES), "trade_id")))
            result = step(*args, **more)
            seen.append((name, rows(landing.resolved(spark, out, RAW_TRADES), "trade_id")))
            return result

        monkeypatch.setattr(files if hasattr(files, name) else landing, name, stepped)

    for name in ("create_text", "delete", "_write_base", "_fold_bad", "_retire"):
        look(name)
    landing.compact(spark, out, RAW_TRADES)
    assert {name for name, _ in seen} >= {"create_text", "delete", "_write_base", "_retire"}
    assert all(found == want for _, found in seen)
    # It was planned before the swap, and its files are still there.
    assert rows(early, "trade_id") == want


def test_the_second_of_two_compactions_gives_way(spark, tmp_path, topic, monkeypatch):  # noqa: F811
    topic.send(*map(trade, range(4)), "bad")
    out, _ = land(spark, tmp_path, topic)
    create = files.create_text

    def beaten(session, path, text):
        monkeypatch.setattr(files, "create_text", create)
        landing.compact(spark, out, RAW_TRADES)
        return create(session, path, text)

    monkeypatch.setattr(files, "create_text", beaten)
    assert landing.compact(spark, out, RAW_TRADES) == landing.manifest(spark, out)
    assert landing.manifest(spark, out).version == 1
    assert len(list((tmp_path / "root" / "raw_trades_log").glob("base-*"))) == 1
    assert len(read(spark, out)) == 4 and landing.quarantined(spark, out).count() == 1


def test_a_batch_delivered_again_lands_once(spark, tmp_path, topic):  # noqa: F811
    topic.send(trade(1), trade(2))
    out, _ = land(spark, tmp_path, topic)
    folder = landing.run_folder(spark, out, str(tmp_path / "checkpoint"))
    batch = landing.log(spark, out).drop("run", "batch")
    # What a crash leaves of a batch is replaced, and a complete one is left as it is.
    (tmp_path / "root" / "raw_trades_log" / folder.rsplit("/", 1)[1] / "batch=000000000007"
     / "verdict=ok").mkdir(parents=True)
    assert len(landing.batches(spark, out)) == 1
    for _ in range(2):
        landing.write_batch(batch, folder, 7)
    assert landing.landed(spark, out, RAW_TRADES).count() == 4
    assert landing.rows_landed(spark, out, str(tmp_path / "checkpoint")) == 4


def test_batch_rows_and_streams_share_a_table(spark, tmp_path, topic):  # noqa: F811
    root, database = str(tmp_path / "root"), "mixed_landing"
    create_raw_tables(spark, root, database)

    def insert(*ids):
        for n in ids:
            spark.sql(
                f"INSERT INTO {database}.raw_trades (trade_id, account_id, symbol, side, quantity,"
                f" price, timestamp, event_version) VALUES ('t{n}', 'A', 'X', 'BUY', 1, 7,"
                " TIMESTAMP_NTZ'2024-01-01 00:00:00', 'b')")

    insert(1, 2, 2)
    assert loaded(spark, tmp_path, "raw_trades").count() == 3
    topic.send(trade(2), trade(3))
    out, _ = land(spark, tmp_path, topic)
    assert read_prices(spark, tmp_path) == [("t1", 7.0), ("t2", 7.0), ("t3", 2.0)]
    landing.compact(spark, out, RAW_TRADES)
    insert(3, 4)
    topic.send(trade(4), trade(5))
    land(spark, tmp_path, topic)
    assert read_prices(spark, tmp_path) == [
        ("t1", 7.0), ("t2", 7.0), ("t3", 7.0), ("t4", 7.0), ("t5", 2.0)]
    assert loaded(spark, tmp_path, "raw_trades").filter("ingestion_time is null").count() == 0
    spark.sql(f"DROP DATABASE {database} CASCADE")


def read_prices(spark, tmp_path):
    return rows(loaded(spark, tmp_path, "raw_trades"), "trade_id", "price")


def test_a_feed_that_dies_is_reported_while_another_lives(spark, tmp_path, caplog):
    good, broken = Topic(spark, tmp_path / "good"), Topic(spark, tmp_path / "broken")
    good.send(trade(1), trade(2), "bad")
    broken.send(trade(1))
    root = str(tmp_path / "root")
    feeds_ = run.Supervisor(spark, root, compact_after=1)
    queries = feeds_.start(["trades"], good.source, "1 second")
    queries |= feeds_.start(["cash"], broken.source, "1 second")
    for query in queries.values():
        query.processAllAvailable()
    (tmp_path / "broken" / "junk.parquet").write_text("not parquet")
    died = time.time()
    while not feeds_.failed and time.time() < died + 60:
        feeds_.watch.changed.wait(0.2)
        feeds_.look()
    assert feeds_.failed == ["cash"] and "cash failed" in caplog.text
    assert queries["trades"].isActive and list(feeds_.open) == ["trades"]
    assert run.compact_tail(spark, feeds_.open, root, 1) == ["trades"]
    good.send(trade(3))
    queries["trades"].processAllAvailable()
    feeds_.stop()
    feeds_.close()
    path, checkpoint = run.places(root, "trades")
    landed = landing.rows_landed(spark, path, checkpoint)
    deadline = time.time() + 10
    while feeds_.taken(queries["trades"]) < landed and time.time() < deadline:
        time.sleep(0.1)
    assert feeds_.taken(queries["trades"]) == landed == 4
    assert feeds_.failed == ["cash"]
    assert load_raw(spark, root)["raw_trades"].count() == 3
