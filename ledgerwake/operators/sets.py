"""Set operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """Concatenate by column name. Pairing up keeps the analyzed plans small."""
    level = list(frames)
    while len(level) > 1:
        paired = [a.unionByName(b) for a, b in zip(level[::2], level[1::2])]
        level = paired + level[len(paired) * 2:]
    return level[0]


def key_union(column: str, *frames: DataFrame) -> DataFrame:
    """Distinct keys over several inputs.

    The inner distincts are left out: the outer one reduces each branch on the map side
    already, so a single exchange carries the keys of all inputs.
    """
    return union_all(df.select(column) for df in frames).distinct()
