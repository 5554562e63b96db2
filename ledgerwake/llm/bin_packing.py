"""Best-fit packing of documents into sequences, with conflicts.

A bin holds at most ``capacity`` tokens, no two documents of one source and no two of one
cluster of duplicates. Pieces are placed in descending length. Bins are ordered by the room they
have left, and each carries a bitmap of the sources and clusters in it: a successor search finds
the smallest sufficient room, goes on to the next larger one while all bins of that room conflict,
and opens a new bin when none is left. So the tightest compatible bin always wins.

Documents are dealt by a hash to groups of ``group_rows`` on average, and packed group by group:
a hot source or cluster spreads over all groups, and only bins at the end of a group stay open.
A document longer than a bin fills bins of its own and leaves a remainder to pack.

Lengths are ids of a ``vocabulary``, as ``token_files`` writes them, and ``text_start`` is a place
among the ids of the document. Without a vocabulary, an explicit option of callers, the unit of
lengths, capacity and places is the word.

NULL and empty texts hold the end mark alone, one token. A NULL source is a source like others;
pass ``by_source=False`` to let sources meet. Repeated rows are packed one by one, and conflict
as a cluster. Equal lengths are placed in the order of a hash of the row. A very long text fills as many
bins as it needs, an empty table gives no bins, and other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwake.llm.common import WORD, staged, text_of, with_row
from ledgerwake.llm.token_files import n_ids

CAPACITY = 4096
GROUP_ROWS = 4096
SCHEMA = ("bin_id bigint, slot int, doc_id string, source string, cluster bigint, piece int, "
          "text_start bigint, n_tokens bigint, bin_tokens bigint")


class Bins:
    """Open bins by room left, and within a room by bitmap; equal bitmaps are alike."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.rooms = 0  # bit r is set if a bin with room r is open
        self.open: dict[int, dict[int, list[int]]] = {}
        self.used: list[int] = []

    def place(self, size: int, marks: int) -> int:
        """Put a piece into the tightest bin none of its marks is in; return that bin."""
        above = self.rooms >> size
        room = size - 1
        while above:
            step = (above & -above).bit_length()
            room += step
            above >>= step
            held = self.open[room]
            fit = next((m for m in held if not m & marks), None)
            if fit is not None:
                found = held[fit].pop()
                if not held[fit]:
                    del held[fit]
                if not held:
                    del self.open[room]
                    self.rooms &= ~(1 << room)
                return self._keep(found, size, room, fit | marks)
        self.used.append(0)
        return self._keep(len(self.used) - 1, size, self.capacity, marks)

    def _keep(self, found: int, size: int, room: int, marks: int) -> int:
        self.used[found] += size
        left = room - size
        if left:
            self.open.setdefault(left, {}).setdefault(marks, []).append(found)
            self.rooms |= 1 << left
        return found


def pack_group(rows: pd.DataFrame, capacity: int, by_source: bool) -> pd.DataFrame:
    """Pack the pieces of one group. Bins are numbered from 0."""
    rows = rows.sort_values(["tie"], kind="stable")
    sources = pd.factorize(rows["source"].fillna("\0"))[0]
    shared = rows["cluster"].duplicated(keep=False).to_numpy()
    clusters = np.full(len(rows), -1)  # where nothing can conflict
    clusters[shared] = pd.factorize(rows["cluster"].to_numpy()[shared])[0]
    width = int(sources.max()) + 1 if by_source and len(rows) else 0
    pieces = []
    for i, size in enumerate(rows["n_tokens"].tolist()):
        marks = 1 << int(sources[i]) if by_source else 0
        if clusters[i] >= 0:
            marks |= 1 << (width + int(clusters[i]))
        pieces += [(min(capacity, size - at), i, at // capacity, at, marks)
                   for at in range(0, size, capacity)]
    pieces.sort(key=lambda p: -p[0])
    bins = Bins(capacity)
    placed, slots = [], []
    filled: dict[int, int] = {}
    for size, *_, marks in pieces:
        found = bins.place(size, marks)
        placed.append(found)
        slots.append(filled.setdefault(found, 0))
        filled[found] += 1
    which = [p[1] for p in pieces]
    return pd.DataFrame({
        "bin_id": placed, "slot": slots,
        "doc_id": rows["doc_id"].to_numpy()[which], "source": rows["source"].to_numpy()[which],
        "cluster": rows["cluster"].to_numpy()[which], "piece": [p[2] for p in pieces],
        "text_start": [p[3] for p in pieces], "n_tokens": [p[0] for p in pieces],
        "bin_tokens": [bins.used[b] for b in placed]})


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS,
         by_source: bool = True) -> DataFrame:
    """Bins for ``row, doc_id, source, cluster, n_tokens``; lengths are at least 1."""
    rows = staged(pieces, "pieces")
    groups = max(1, rows.count() // group_rows)

    def work(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        out = pack_group(group, capacity, by_source)
        out["bin_id"] += int(key[0]) << 32
        return out

    dealt = rows.select(
        F.col("doc_id").cast("string").alias("doc_id"), "source", "cluster", "n_tokens",
        F.xxhash64(F.lit("tie"), "row").alias("tie"),
        F.pmod(F.xxhash64("row"), F.lit(groups)).alias("part"))
    packed = dealt.groupBy("part").applyInPandas(work, SCHEMA)
    return packed.withColumn("doc_id", F.col("doc_id").cast(rows.schema["doc_id"].dataType))


def pieces_of(docs: DataFrame, vocabulary: tuple[str, str] | None = None) -> DataFrame:
    """Lengths and clusters of documents: ids and an end mark; equal texts are a cluster.

    ``vocabulary`` is a path of ranks and a pattern; without one, words are counted.
    """
    length = (n_ids(text_of(), *vocabulary) if vocabulary
              else F.regexp_count(text_of(), F.lit(WORD)))
    return with_row(
        docs, "doc_id", F.col("source").cast("string").alias("source"),
        F.xxhash64(F.sha2(text_of(), 256)).alias("cluster"),
        (length + 1).cast("bigint").alias("n_tokens"))


def table(docs: DataFrame, vocabulary: tuple[str, str] | None = None, **options) -> DataFrame:
    """Every piece of every document with its bin."""
    return pack(pieces_of(docs, vocabulary), **options)
