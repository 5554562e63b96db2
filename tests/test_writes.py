"""Upsert, keyed insert and constraints on small tables, checked against brute force."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerwake.operators import writes
from ledgerwake.operators.aggregates import counts
from ledgerwake.schemas import RAW_CASH_EVENTS, RAW_PRICES, RAW_TABLES, RAW_TRADES
from ledgerwake.sources.raw import as_raw, create_raw_tables, load_raw
from tests.helpers import at, cash, prices, rows, trades


def test_upsert_replaces_the_price_and_nothing_else(spark):
    stored = prices(spark, ("X", 1.0, at(1), "old"), ("Y", 5.0, at(1), None))
    batch = prices(spark, ("X", 2.0, at(1), "b1"), ("X", 3.0, at(1), "b2"),
                   ("Y", 6.0, at(1), "late"), ("Z", 7.0, at(1), "z1"), ("Z", 8.0, at(1), "z2"))
    batch = batch.withColumn("seq", F.when(F.col("price") == 8.0, 1).otherwise(F.col("price")))
    merged = writes.upsert_latest(stored, batch, RAW_PRICES.key, ["seq"], ["price"])
    assert merged.columns == RAW_PRICES.columns
    # The batch's seq decides, not its order: Z's tick with seq 1 is the older one.
    assert rows(merged, "symbol", "price", "source") == [
        ("X", 3.0, "old"), ("Y", 6.0, None), ("Z", 7.0, "z2")]


def test_upsert_of_the_same_batch_twice_changes_nothing(spark):
    stored = prices(spark, ("X", 1.0, at(1), "old"))
    batch = prices(spark, ("X", 2.0, at(1), "b"), ("Y", 3.0, at(1), "b")).withColumn(
        "seq", F.col("price"))
    once = writes.upsert_latest(stored, batch, RAW_PRICES.key, ["seq"], ["price"])
    twice = writes.upsert_latest(once, batch, RAW_PRICES.key, ["seq"], ["price"])
    columns = ["symbol", "price", "source"]
    assert rows(once, *columns) == rows(twice, *columns)


def test_keyed_insert_splits_without_losing_rows(spark):
    stored = trades(spark, ("t0", "A", "X", "BUY", 1.0, 1.0, at(1)))
    # t1 is a hot key: a third of the batch.
    ids = ["t0", "t0"] + ["t1"] * 40 + [f"n{i}" for i in range(80)]
    batch = trades(spark, *[(k, "A", "X", "BUY", float(i + 1), 1.0, at(2))
                            for i, k in enumerate(ids)]).withColumn("seq", -F.col("quantity"))
    accepted, rejected = writes.insert_new(stored, batch, RAW_TRADES.key, ["seq"])
    newest = {k: float(i + 1) for i, k in enumerate(ids) if k != "t0"}
    assert dict(rows(accepted, "trade_id", "quantity")) == newest
    assert accepted.count() == len(newest)
    assert accepted.unionByName(rejected).exceptAll(batch).count() == 0
    assert accepted.count() + rejected.count() == len(ids)


def test_constraints_name_the_first_thing_a_row_breaks(spark):
    df = trades(
        spark,
        ("ok", "A", "X", "BUY", 1.0, 1.0, at(1)), ("side", "A", "X", "buy", 1.0, 1.0, at(1)),
        ("qty", "A", "X", "BUY", 0.0, 1.0, at(1)), ("px", "A", "X", "SELL", 1.0, -1.0, at(1)),
        ("sym", "A", None, "buy", 1.0, 1.0, at(1)), ("time", "A", "X", "BUY", 1.0, 1.0, None))
    good, bad = writes.enforce(df, RAW_TRADES)
    assert rows(good, "trade_id") == [("ok",)]
    assert rows(bad, "trade_id", "violation") == [
        ("px", "check:price"), ("qty", "check:quantity"), ("side", "check:side"),
        ("sym", "not_null:symbol"), ("time", "not_null:timestamp")]


def test_cash_amount_has_no_check(spark):
    df = cash(spark, ("c1", "A", -5.0, "DEPOSIT", at(1)), ("c2", "A", 5.0, "FEE", at(1)))
    good, bad = writes.enforce(df, RAW_CASH_EVENTS)
    assert rows(good, "event_id") == [("c1",)]
    assert rows(bad, "violation") == [("check:type",)]


def test_raw_tables_round_trip(spark, tmp_path):
    root = str(tmp_path)
    create_raw_tables(spark, root, "landing")
    create_raw_tables(spark, root, "landing")
    as_raw(trades(spark, ("t1", "A", "X", "BUY", 1.0, 1.0, at(1))), RAW_TRADES).write.mode(
        "append").parquet(f"{root}/raw_trades")
    as_raw(prices(spark, ("X", 1.0, at(1))).drop("ingestion_time"), RAW_PRICES).write.mode(
        "append").parquet(f"{root}/raw_prices")
    loaded = load_raw(spark, root)
    assert {name: df.columns for name, df in loaded.items()} == {
        name: table.columns for name, table in RAW_TABLES.items()}
    assert loaded["raw_prices"].filter("ingestion_time is null").count() == 0
    assert rows(counts(loaded), "table_name", "row_count") == [
        ("raw_cash_events", 0), ("raw_prices", 1), ("raw_trades", 1)]
    spark.catalog.refreshTable("landing.raw_trades")
    assert spark.table("landing.raw_trades").count() == 1
