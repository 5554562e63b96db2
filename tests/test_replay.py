"""How recorded messages are cut into batches and loads, and what the feeds cost to make."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerwake import catalog
from ledgerwake.llm import substring_dedup
from ledgerwake.operators import writes
from ledgerwake.plans import delta
from ledgerwake.schemas import ENVELOPE, RAW_TRADES
from ledgerwake.sources import files, landing, market, scratch

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_aqe(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def envelopes(spark, n, parts):
    body = F.to_json(F.struct(
        F.concat(F.lit("T"), "id").alias("trade_id"), F.lit("A").alias("account_id"),
        F.lit("X").alias("symbol"), F.lit("BUY").alias("side"), F.lit(1.0).alias("quantity"),
        F.lit(1.0).alias("price"), F.lit(0).alias("timestamp")))
    rows = spark.range(0, n, 1, parts).select(
        F.encode(F.lit("A"), "UTF-8").alias("key"), F.encode(body, "UTF-8").alias("value"),
        F.lit(None).cast("string").alias("topic"), F.lit(0).alias("partition"),
        F.col("id").alias("offset"), F.timestamp_seconds("id").alias("timestamp"))
    return rows.select(*ENVELOPE.fieldNames())


def test_batches_have_as_many_files_as_tasks_made_them(spark, monkeypatch):
    """One file a batch had been one task a batch, whatever its size (F1, F9)."""
    recorded = []
    keep = catalog._recorded
    monkeypatch.setattr(
        catalog, "_recorded", lambda *a: recorded.append(keep(*a)) or recorded[-1])
    sent = catalog._twice(envelopes(spark, 600, 4))
    out = catalog._replayed(spark, "trades", sent, batches=3)
    assert len(files.matching(spark, f"{recorded[0]}/batch=*/*.parquet")) == 12
    assert len(landing.batches(spark, out)) == 3
    assert landing.landed(spark, out, RAW_TRADES).count() == 1200
    assert landing.resolved(spark, out, RAW_TRADES).count() == 600


def test_loads_are_recorded_in_one_pass_and_may_be_empty(spark):
    messages = envelopes(spark, 90, 2).withColumn(
        "load", F.when(F.col("offset") % 3 == 0, 0).when(F.col("offset") % 3 == 1, 2))
    out = catalog._replayed_loads(spark, "trades", messages, 3, compacted=2)
    assert landing.resolved(spark, out, RAW_TRADES).count() == 60
    assert len(landing.runs(spark, out)) == 2


def test_messages_are_made_without_a_shuffle_of_their_own(no_aqe):
    """Line items are dealt out for the two joins of the feed, and not sorted for them."""
    text = plan(catalog._twice(catalog.trade_messages(no_aqe, SF)))
    assert text.count("ShuffledHashJoin") == 2
    assert text.count("Exchange hashpartitioning") == 4
    assert "Sort [" not in text and "Union" not in text


def test_a_keyed_insert_deals_its_batch_out_once(no_aqe):
    batch = no_aqe.range(10).select(F.col("id").alias("k"), F.col("id").alias("at"))
    written = scratch.staged(batch, "batch")
    tagged = writes.tag_new(written.limit(0), written, ["k"], ["at"])
    assert plan(tagged).count("Exchange hashpartitioning") == 1


def test_rows_without_key_or_position_are_not_let_in(spark):
    batch = spark.createDataFrame(
        [("a", 2), ("a", 1), ("a", 1), (None, 1), ("b", None), ("b", 3), ("c", 1)],
        "k string, at int")
    stored = spark.createDataFrame([("c",), ("c",), (None,)], "k string")
    tagged = writes.tag_new(stored, batch, ["k"], ["at"])
    assert sorted(map(str, tagged.filter("is_new").collect())) == [
        "Row(k='a', at=1, is_new=True)"] * 2
    assert tagged.count() == 7


def test_trades_of_a_build_are_resolved_once(spark, tmp_path):
    path = str(tmp_path / "raw_trades")
    spark.createDataFrame(
        [("t", "A", "X", "BUY", 1.0, 1.0, dt.datetime(2024, 1, 1), "1", None)],
        RAW_TRADES.schema).write.parquet(path)
    raw = delta.loaded(spark, str(tmp_path))
    assert raw["raw_trades"].count() == 1
    assert all("raw-trades-" in name for name in raw["raw_trades"].inputFiles())


def test_what_segments_are_dealt_by_does_not_travel(no_aqe):
    docs = no_aqe.createDataFrame([(0, "a b")], "row bigint, text string")
    text = plan(substring_dedup.repeated(substring_dedup.instances(docs, 35)))
    assert "xxhash64(row" in text and "salt" not in text
