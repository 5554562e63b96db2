"""Write semantics of the landing tables: upsert, keyed insert, constraint split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerwake.schemas import RawTable


def first_arrivals(log: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each key that comes first by ``order``; one aggregate with map-side combine."""
    rest = [c for c in log.columns if c not in key and c not in order]
    first = log.groupBy(*key).agg(F.min(F.struct(*order, *rest)).alias("_first"))
    return first.select(*key, "_first.*").select(*log.columns)


def resolve_upserts(
    log: DataFrame, key: Sequence[str], order: Sequence[str], overwritten: Sequence[str]
) -> DataFrame:
    """Collapse a change log to one row per key.

    Columns in ``overwritten`` take the value of the newest row, all others keep the value
    of the oldest one. That is the smallest and the largest of one struct each, combined
    map-side, so many versions of one key never meet in a single task.
    """
    rest = [c for c in log.columns if c not in key and c not in order]
    kept = [c for c in rest if c not in overwritten]
    newest = [c for c in rest if c in overwritten]
    ends = [F.min(F.struct(*order, *kept)).alias("_first")] if kept else []
    ends += [F.max(F.struct(*order, *newest)).alias("_last")] if newest else []
    return log.groupBy(*key).agg(*ends).select(
        *key, *[F.col(f"_{'last' if c in newest else 'first'}.{c}").alias(c) for c in rest])


def key_states(
    log: DataFrame, key: Sequence[str], order: Sequence[str], overwritten: Sequence[str] = ()
) -> DataFrame:
    """What has to be kept of a log so that it can be resolved together with later rows.

    One row for each key in the log's columns: the resolved row and the place of the oldest row.
    If columns are overwritten, ``last_*`` holds the place of the newest row as well.
    """
    kept = [c for c in log.columns if c not in key and c not in order and c not in overwritten]
    ends = [F.min(F.struct(*order, *kept)).alias("_first")]
    ends += [F.max(F.struct(*order, *overwritten)).alias("_last")] if overwritten else []
    states = log.groupBy(*key).agg(*ends)
    source = {c: F.col(c) for c in key} | {c: F.col(f"_first.{c}") for c in (*order, *kept)}
    source |= {c: F.col(f"_last.{c}") for c in overwritten}
    places = [F.col(f"_last.{c}").alias(f"last_{c}") for c in order] if overwritten else []
    return states.select(*[source[c].alias(c) for c in log.columns], *places)


def merge_states(
    base: DataFrame, fresh: DataFrame, key: Sequence[str], order: Sequence[str],
    overwritten: Sequence[str] = (),
) -> DataFrame:
    """The states of a log that has states ``base`` and has since taken in rows of ``fresh``.

    A join by key: if ``base`` is bucketed by it, only ``fresh`` is shuffled.
    """
    b, f = base.alias("b"), fresh.alias("f")
    joined = b.join(f, [F.col(f"b.{c}") == F.col(f"f.{c}") for c in key], "full")

    def place(side: str, prefix: str = "") -> Column:
        return F.struct(*[F.col(f"{side}.{prefix}{c}").alias(c) for c in order])

    alone, found = F.col(f"b.{key[0]}").isNull(), F.col(f"f.{key[0]}").isNotNull()
    first = alone | (found & (place("f") < place("b")))
    last = alone | (found & (place("f", "last_") > place("b", "last_"))) if overwritten else first
    newest = {*overwritten, *[f"last_{c}" for c in order]}
    return joined.select(*[
        F.coalesce(f"b.{c}", f"f.{c}").alias(c) if c in key
        else F.when(last if c in newest else first, F.col(f"f.{c}")).otherwise(
            F.col(f"b.{c}")).alias(c) for c in base.columns])


def upsert_latest(
    existing: DataFrame,
    batch: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    overwritten: Sequence[str],
) -> DataFrame:
    """Merge ``batch`` into ``existing`` (already unique on ``key``).

    Stored rows count as older than the batch; inside the batch ``order`` decides. ``order``
    columns exist in the batch only.
    """
    stored = existing.withColumn("_arrival", F.lit(0))
    arrived = batch.withColumn("_arrival", F.lit(1))
    log = stored.unionByName(arrived, allowMissingColumns=True)
    merged = resolve_upserts(log, key, ["_arrival", *order], overwritten)
    return merged.select(*existing.columns)


def tag_new(
    existing: DataFrame, batch: DataFrame, key: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Mark each batch row that an insert with a primary key would let in.

    ``is_new`` is true for the first row (by ``order``) of a key that ``existing`` does not
    hold. ``order`` has to be unique within a key, as a source position is; a row without a key
    or position is not let in. Stored keys stand before the batch in one line for each key, so
    the batch is dealt out once. The line of a key is sorted and ranked as it passes; it spills
    to disk if it is long. Rows without a key are dealt out by their position.
    """
    known = existing.select(*key).withColumn("_arrival", F.lit(0))
    log = batch.withColumn("_arrival", F.lit(1)).unionByName(known, allowMissingColumns=True)
    whole = F.lit(True)
    for column in (*key, *order):
        whole = whole & F.col(column).isNotNull()
    unkeyed = F.when(F.concat(*[F.col(c).isNull().cast("string") for c in key]).contains("true"),
                     F.xxhash64(*order))
    line = Window.partitionBy(*key, unkeyed).orderBy("_arrival", *order)
    ranked = log.withColumn("is_new", (F.rank().over(line) == 1) & whole)
    return ranked.filter("_arrival = 1").select(*batch.columns, "is_new")


def insert_new(
    existing: DataFrame, batch: DataFrame, key: Sequence[str], order: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """Split a batch into the rows to insert and the duplicates to reject."""
    tagged = tag_new(existing, batch, key, order)
    return (
        tagged.filter("is_new").drop("is_new"),
        tagged.filter(~F.col("is_new")).drop("is_new"),
    )


def violation(table: RawTable) -> Column:
    """Name of the first constraint a row breaks, NULL for a good row.

    As in SQL, a CHECK that evaluates to NULL passes; NOT NULL is what catches the row.
    """
    missing = [
        F.when(F.col(c).isNull(), F.lit(f"not_null:{c}")) for c in table.required
    ]
    broken = [
        F.when(~F.expr(check), F.lit(f"check:{name}")) for name, check in table.checks.items()
    ]
    return F.coalesce(*missing, *broken)


def tag_violations(df: DataFrame, table: RawTable) -> DataFrame:
    return df.withColumn("violation", violation(table))


def enforce(df: DataFrame, table: RawTable) -> tuple[DataFrame, DataFrame]:
    """Split rows into those a constrained table accepts and those it refuses."""
    tagged = tag_violations(df, table)
    return (
        tagged.filter(F.col("violation").isNull()).drop("violation"),
        tagged.filter(F.col("violation").isNotNull()),
    )
