"""Rebuilding tables under readers, and keeping old builds."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerwake.plans import pipeline
from tests.helpers import rows


def build(spark, root, n, **options):
    df = spark.range(n).withColumn("day", F.lit("2024-01-01").cast("date"))
    return pipeline.materialize(df, "numbers", pipeline.TABLE, root, "builds", **options)


def test_readers_find_the_old_build_or_the_new_one(spark, tmp_path, monkeypatch):
    """The table is read before and after every statement of a rebuild."""
    root, seen = str(tmp_path / "m"), []
    build(spark, root, 3)
    plain = spark.sql

    def watched(text, *args, **kwargs):
        seen.append(spark.table("builds.numbers").count())
        result = plain(text, *args, **kwargs)
        seen.append(spark.table("builds.numbers").count())
        return result

    monkeypatch.setattr(spark, "sql", watched)
    build(spark, root, 5)
    monkeypatch.undo()
    assert seen == [3, 3, 3, 5]


def test_a_reader_of_the_last_build_can_finish(spark, tmp_path):
    root = str(tmp_path / "m")
    build(spark, root, 3)
    reader = spark.table("builds.numbers")
    build(spark, root, 5)
    assert (reader.count(), spark.table("builds.numbers").count()) == (3, 5)


def test_old_builds_go(spark, tmp_path):
    root = str(tmp_path / "m")
    for n in range(1, 6):
        kept = build(spark, root, n, keep_builds=2)
    builds = [p for p in (tmp_path / "m" / "numbers").iterdir() if p.name.startswith("build-")]
    assert len(builds) == 2
    assert kept.count() == spark.table("builds.numbers").count() == 5


def test_an_unfinished_build_is_left_alone(spark, tmp_path):
    half = tmp_path / "m" / "numbers" / "build-half"
    half.mkdir(parents=True)
    for n in range(1, 4):
        build(spark, str(tmp_path / "m"), n, keep_builds=1)
    assert half.exists()


def test_partitioned_builds_prune(spark, tmp_path):
    root = str(tmp_path / "m")
    build(spark, root, 4, partition_by=["day"])
    found = spark.table("builds.numbers").filter("day = DATE'2024-01-01'")
    assert rows(found, "id") == [(0,), (1,), (2,), (3,)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
