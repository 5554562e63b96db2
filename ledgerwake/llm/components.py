"""Connected components of an edge table, without collecting any of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwake.llm.common import staged

ROUNDS = 100


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array(
        F.struct(F.col("a").alias("u"), F.col("b").alias("v")),
        F.struct(F.col("b").alias("u"), F.col("a").alias("v")))).alias("e")).select("e.*")


def _hook_larger(edges: DataFrame) -> DataFrame:
    """Every node hands the smallest node around it to its larger neighbours."""
    around = _both_ways(edges)
    least = around.groupBy("u").agg(F.min("v").alias("least"))
    return around.join(least, "u").filter("v > u").select(
        F.col("v").alias("a"), F.least("u", "least").alias("b")).filter("a <> b").distinct()


def _hook_smaller(edges: DataFrame) -> DataFrame:
    """Every node hands the smallest node around it to its smaller neighbours and itself."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("least"))
    moved = down.join(least, "u").select(F.col("v").alias("a"), F.col("least").alias("b"))
    own = least.select(F.col("u").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(own).filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges(a, b)``; a component is its least node.

    Alternates the two star operations until every edge points at a root. Each round is
    written down, so the lineage stays short; only a count and a checksum reach the driver.
    """
    now = staged(edges.filter("a <> b").select("a", "b").distinct(), "edges")
    seen = None
    for _ in range(ROUNDS):
        now = staged(_hook_smaller(_hook_larger(now)), "stars")
        mark = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if tuple(mark) == seen:
            break
        seen = tuple(mark)
    else:
        raise RuntimeError(f"components still change after {ROUNDS} rounds")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
