"""What replays and updates leave on disk, and how often they deal rows out."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from ledgerwake import catalog
from ledgerwake.plans import delta
from ledgerwake.schemas import RAW_TRADES
from ledgerwake.session import TIDY, settings
from ledgerwake.sources import files, landing, scratch
from tests.helpers import rows
from tests.test_landing import plan, read
from tests.test_streaming import Topic, land, topic, trade  # noqa: F401

SF = "/root/testdata/sf0.001"


def shuffles(spark):
    """Number of shuffles so far, and one more for asking."""
    return spark.sparkContext._jsc.sc().newShuffleId()


def shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager()
    found = manager.diskBlockManager().getAllFiles()
    names = [found.apply(i).getName() for i in range(found.size())]
    return {name for name in names if name.startswith("shuffle_") and name.endswith(".data")}


@pytest.fixture
def recorded(monkeypatch):
    """Path and number of the messages of each recording."""
    kept, keep = [], catalog._recorded

    def counted(messages, *args):
        path = keep(messages, *args)
        kept.append((path, messages.sparkSession.read.parquet(path).count()))
        return path

    monkeypatch.setattr(catalog, "_recorded", counted)
    return kept


@pytest.fixture
def given(spark, monkeypatch):
    """The scratch folders that a query was given and that still hold something."""
    monkeypatch.setattr(scratch, "_given", {})
    return lambda: {
        p.rsplit("/", 1)[1].rsplit("-", 1)[0] for p in scratch._given[spark.sparkContext.applicationId]
        if files.exists(spark, p) and files.size(spark, p)}


@pytest.mark.parametrize("query, delivered", [
    ("stream_two_backfills_keyed", 2), ("stream_keyed_insert", 2), ("stream_compacted_trades", None),
    ("raw_landing_mixed", None)])
def test_messages_are_recorded_once_and_forgotten(spark, recorded, given, query, delivered):
    """Copies had been recorded one by one, and stayed when they had landed (F4, F5, F6)."""
    df = catalog.QUERIES[query](spark, SF)
    n = catalog.trade_messages(spark, SF).count()
    assert [many for _, many in recorded] == [n]
    assert not {"messages-trades", "trade-feed"} & given()
    found = df.count()
    assert found == n * delivered if delivered else 0 < found <= n


def test_jobs_of_a_query_leave_no_shuffle_files(spark):
    before = shuffle_files(spark)
    df = catalog.QUERIES["stream_compacted_trades"](spark, SF)
    until = time.time() + 20
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert shuffle_files(spark) <= before
    # Those of the result stay for as long as there is a result.
    assert len(df.collect()) == len(df.collect()) > 0
    assert spark.conf.get(*TIDY, None) != "true"


def test_settings_are_put_back(spark):
    for value in (None, "7"):
        with settings(spark, {"spark.sql.shuffle.partitions": value} if value else {}):
            before = spark.conf.get("spark.sql.shuffle.partitions")
            with pytest.raises(KeyError), settings(
                    spark, {"spark.sql.shuffle.partitions": "3", "ledgerwake.own": "x"}):
                assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
                raise KeyError
            assert spark.conf.get("spark.sql.shuffle.partitions") == before
            assert spark.conf.get("ledgerwake.own", None) is None


def test_a_compaction_deals_rows_out_once(spark, tmp_path, topic):  # noqa: F811
    topic.send(*map(trade, range(25)), *map(trade, range(5)))
    out, _ = land(spark, tmp_path, topic)
    first = shuffles(spark)
    landing.compact(spark, out, RAW_TRADES, bucket_rows=10)
    # Counts of the runs, two; states by key; rows of the base.
    assert shuffles(spark) - first - 1 == 4
    assert landing.manifest(spark, out).buckets == 4
    topic.send(*map(trade, range(20, 32)))
    land(spark, tmp_path, topic)
    before = read(spark, out)
    second = shuffles(spark)
    landing.compact(spark, out, RAW_TRADES, bucket_rows=10)
    assert shuffles(spark) - second - 1 == 4
    assert landing.manifest(spark, out).buckets == 4 and landing.manifest(spark, out).rows == 32
    assert read(spark, out) == before and len(before) == 32


def test_a_base_that_grows_keeps_its_rows(spark, tmp_path, topic):  # noqa: F811
    for step, n in enumerate((5, 40, 90)):
        topic.send(*[trade(k, price=1.0 + step) for k in range(n)], minutes=step)
        out, _ = land(spark, tmp_path, topic)
        landing.compact(spark, out, RAW_TRADES, bucket_rows=10)
    known = landing.manifest(spark, out)
    assert known.buckets == 16 and known.rows == 90
    price = {r.trade_id: r.price for r in landing.resolved(spark, out, RAW_TRADES).collect()}
    assert [price[f"t{k}"] for k in (0, 4, 5, 39, 40, 89)] == [1.0, 1.0, 2.0, 2.0, 3.0, 3.0]


def test_a_tail_longer_than_its_base_is_dealt_out_once(spark, tmp_path, topic):  # noqa: F811
    topic.send(trade(0, price=5.0), trade(1, price=5.0))
    out, _ = land(spark, tmp_path, topic)
    landing.compact(spark, out, RAW_TRADES)
    tail = Topic(spark, tmp_path / "tail")
    # At the place of the first row of the base, one at a later place, and one before them.
    tail.send(trade(0, price=1.0), trade(1, price=6.0), *map(trade, range(2, 400)))
    tail.send(trade(1, price=7.0), minutes=-5)
    land(spark, tmp_path, tail, checkpoint="other")
    known = landing.manifest(spark, out)
    assert landing._outweighs(spark, out, known, landing._tail(spark, out, known))
    with settings(spark, {"spark.sql.adaptive.enabled": "false"}):
        text = plan(landing.resolved(spark, out, RAW_TRADES))
    assert text.count("Exchange hashpartitioning") == 1 and "Join" not in text
    found = read(spark, out)
    assert len(found) == 400
    assert [r[RAW_TRADES.columns.index("price")] for r in found if r[0] in ("t0", "t1")] == [5.0, 7.0]
    joined = landing._states(
        spark, out, RAW_TRADES, known,
        landing._rows(spark, out, RAW_TRADES, landing._tail(spark, out, known)))
    assert rows(joined, *[c for c in RAW_TRADES.columns if c != "ingestion_time"]) == found


def test_a_folded_log_is_read_from_its_base(spark, tmp_path, topic):  # noqa: F811
    """It had been merged with nothing and written once more (F1, F2, F3)."""
    topic.send(trade(1), trade(1), trade(2), "bad")
    out, _ = land(spark, tmp_path, topic)
    root = str(tmp_path / "root")
    assert "raw-trades-" in delta.loaded(spark, root)["raw_trades"].inputFiles()[0]
    landing.compact(spark, out, RAW_TRADES)
    found = delta.loaded(spark, root)["raw_trades"]
    assert all("/base-" in name for name in found.inputFiles())
    assert rows(found, "trade_id") == [("t1",), ("t2",)]
    topic.send("bad")
    land(spark, tmp_path, topic)
    assert landing.is_base(spark, out, RAW_TRADES)
    topic.send(trade(3))
    land(spark, tmp_path, topic)
    assert not landing.is_base(spark, out, RAW_TRADES)
    assert rows(delta.loaded(spark, root)["raw_trades"], "trade_id") == [("t1",), ("t2",), ("t3",)]


def test_an_update_keeps_what_it_needs_only(spark, given):
    df = catalog.QUERIES["delta_portfolio_value"](spark, SF)
    assert not {"messages-trades", "messages-prices", "messages-cash", "raw-trades"} & given()
    assert df.count() > 0


def test_changed_trades_are_brought_together_once(spark, tmp_path, topic):  # noqa: F811
    """Groups, keys and dimensions each had joined all versions to the changed keys anew."""
    topic.send(*[trade(n, account_id=f"A{n % 3}") for n in range(9)])
    out, _ = land(spark, tmp_path, topic)
    root = str(tmp_path / "root")
    since = delta.marks(spark, root)
    built = catalog.pipeline.run(spark, delta.loaded(spark, root), str(tmp_path / "models"))
    topic.send(trade(2, price=9.0, account_id="A2"), trade(20, account_id="B"))
    land(spark, tmp_path, topic)
    landing.compact(spark, out, RAW_TRADES)
    before = shuffles(spark)
    found = delta.rebuild(spark, root, delta.tables(built), since)
    assert shuffles(spark) - before - 1 <= 19  # before: 25
    assert found["fact_trades"].filter(F.col("trade_id") == "t20").count() == 1
    assert rows(found["dim_account"], "account_id") == [("A0",), ("A1",), ("A2",), ("B",)]
