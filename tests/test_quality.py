"""Data tests on planted defects, and the full declared suite."""

from __future__ import annotations

from collections import Counter

from ledgerwake.operators import quality
from ledgerwake.operators.quality import Check, run_checks
from ledgerwake.params import Params
from ledgerwake.plans import pipeline
from ledgerwake.plans.checks import CHECKS
from tests.helpers import at, cash, day, prices, rows, trades


def test_there_are_59_declared_checks():
    assert len(CHECKS) == len(set(CHECKS)) == 59
    assert Counter(c.kind for c in CHECKS) == {
        "not_null": 45, "unique": 8, "accepted_values": 2, "expression_is_true": 4}


def test_each_check_returns_the_failing_rows(spark):
    df = spark.createDataFrame(
        [(1, "a"), (1, "b"), (2, None), (None, "z"), (None, "z")], "id int, tag string")
    assert quality.not_null(df, "tag").count() == 1
    assert rows(quality.unique(df, ["id"]), "id", "n_rows") == [(1, 2)]
    assert rows(quality.accepted(df, "tag", ["a", "b"]), "tag") == [("z",), ("z",)]
    assert rows(quality.holds(df, "id > 1"), "id") == [(1,), (1,)]


def test_summary_counts_every_kind_and_reports_passes(spark):
    df = spark.createDataFrame(
        [(1, "a'"), (1, "b\\"), (2, None), (-3, "z")], "id int, tag string")
    checks = [
        Check("m", "id", "not_null"), Check("m", "tag", "not_null"), Check("m", "id", "unique"),
        Check("m", "tag", "accepted_values", values=("a'", "b\\")),
        Check("m", "id", "expression_is_true", rule="> 0"),
    ]
    got = run_checks({"m": df}, checks)
    assert rows(got, "column_name", "kind", "failures") == sorted([
        ("id", "not_null", 0), ("tag", "not_null", 1), ("id", "unique", 1),
        ("tag", "accepted_values", 1), ("id", "expression_is_true", 1)])


def test_summary_of_an_empty_model_passes(spark):
    empty = spark.createDataFrame([], "id int")
    got = run_checks({"m": empty}, [Check("m", "id", "not_null"), Check("m", "id", "unique")])
    assert rows(got, "kind", "failures") == [("not_null", 0), ("unique", 0)]


def test_pipeline_writes_tables_and_passes_all_checks(spark, tmp_path):
    raw = {
        "raw_trades": trades(spark, ("t1", "A", "X", "buy", 10.0, 2.0, at(1)),
                             ("t2", "A", "X", "SELL", 4.0, 3.0, at(2)),
                             ("t3", "B", "Y", "BUY", 4.0, 3.0, at(2))),
        "raw_prices": prices(spark, ("X", 2.0, at(1)), ("X", 3.0, at(2)), ("Y", 1.0, at(2))),
        "raw_cash_events": cash(spark, ("c1", "A", 50.0, "deposit", at(1))),
    }
    params = Params(date_start=day(1), date_end=day(9))
    models = pipeline.run(
        spark, raw, str(tmp_path), params, database_prefix="desk_",
        partition_by={"fact_trades": ["trade_date"]})
    summary = pipeline.check(models)
    assert summary.count() == 59
    assert summary.filter("failures > 0").count() == 0
    assert spark.table("desk_facts.fact_trades").count() == 3
    assert spark.table("drawdown").count() == models["drawdown"].count() == 3
    # The lazy form computes the same rows.
    lazy = pipeline.build(spark, raw, params)
    for name in pipeline.MODEL_NAMES:
        kept = [c for c in lazy[name].columns
                if c not in ("calculated_at", "created_at", "ingestion_time")]
        assert sorted(models[name].columns) == sorted(lazy[name].columns)
        assert models[name].select(kept).exceptAll(lazy[name].select(kept)).count() == 0, name

    # A second build swaps the table over to new files.
    raw["raw_trades"] = raw["raw_trades"].filter("trade_id <> 't3'")
    pipeline.run(spark, raw, str(tmp_path), params, database_prefix="desk_",
                 partition_by={"fact_trades": ["trade_date"]})
    assert spark.table("desk_facts.fact_trades").count() == 2


def test_checks_are_counted_while_tables_are_written(spark, tmp_path):
    raw = faulty_raw(spark)
    models = pipeline.run(
        spark, raw, str(tmp_path), Params(day(1), day(3)), layers_as={"metrics": pipeline.TABLE})
    counted = {c for c in CHECKS if c.kind != "unique"}
    assert models.counted.keys() == counted
    once = rows(pipeline.check(models), "model", "column_name", "kind", "failures")
    models.counted = {}
    assert rows(pipeline.check(models), "model", "column_name", "kind", "failures") == once
    found = {r[:3]: r[3] for r in once}
    assert found["raw_trades", "trade_id", "not_null"] == 1
    assert found["stg_trades", "side", "accepted_values"] == 2
    assert found["stg_trades", "quantity", "expression_is_true"] == 1
    assert found["raw_trades", "trade_id", "unique"] == 1
    assert found["fact_trades", "trade_id", "unique"] == 1
    assert found["stg_prices", "price", "expression_is_true"] == 0
    assert found["raw_prices", "symbol", "not_null"] == 1


def test_models_that_share_a_key_share_its_grouping(spark):
    raw = faulty_raw(spark)
    built = pipeline.build(spark, raw, Params(day(1), day(3)))
    own = [c for c in CHECKS if c.kind == "unique" and c.column == "trade_id"]
    assert len(own) == 3
    found = run_checks({**raw, **built}, own)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(key") == 1
    assert rows(found, "failures") == [(1,)] * 3


def faulty_raw(spark):
    return {
        "raw_trades": trades(
            spark, ("t1", "A", "X", "BUY", 1.0, 2.0, at(1)), ("t1", "A", "X", "HOLD", 1.0, 2.0, at(1)),
            (None, "A", "X", "BUY", 1.0, 2.0, at(1)), ("t2", "B", "X", "NONE", -1.0, 2.0, at(2))),
        "raw_prices": prices(spark, ("X", 2.0, at(1)), (None, 1.0, at(1)), ("Y", -1.0, at(2))),
        "raw_cash_events": cash(spark, ("c1", "A", 5.0, "DEPOSIT", at(1))),
    }
