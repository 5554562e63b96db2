"""Exact deduplication of a new batch against immutable snapshots.

A snapshot is a set of texts that never changes: one row for each digest, in hash shards, with
a static 3-wise binary-fuse filter for each shard. The digests of a new batch are first grouped
among themselves (map-side, so a text with a million copies shuffles a row per task), then each
distinct digest asks the filter of its shard. A miss is new for certain. A hit joins the exact
rows of the snapshot by digest and the normalised texts are compared byte by byte, so neither a
false positive of the filter nor a digest collision makes two texts equal.

Texts are equal when identical after deleting white space (``[\\x20\\x09-\\x0D]``); NULL counts as
empty. Of equal texts the row with the most code points stays, then the smallest ``doc_id``
(NULL last), then the first in input order, so of rows repeated in full exactly one stays.
Other columns are carried through untouched and may have any name but those added. Very long texts are
compared whole; an empty batch gives an empty result, and an empty snapshot finds nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerwake.llm.common import SPACES, mixed, staged, text_of, whole_rows, with_row

# Distinct texts for each filter shard, on average. Bounds the memory of building a filter.
SHARD_KEYS = 1 << 15


# --- the filter ----------------------------------------------------------------------------

@dataclass
class FuseFilter:
    """Binary-fuse filter with 8-bit fingerprints over 64-bit keys; about 1 in 256 errs."""

    seed: int
    segment: int
    starts: int
    table: np.ndarray

    @staticmethod
    def build(keys: np.ndarray) -> FuseFilter:
        """All keys are found again. Peeling rounds are whole-array steps."""
        keys = np.unique(keys.astype(np.uint64))
        n = max(1, len(keys))
        segment = 1 << max(2, min(18, int(np.log(n) / np.log(3.33) + 2.25)))
        factor = max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 2)))
        starts = max(1, int(np.ceil(n * factor / segment)) - 2)
        for seed in range(1, 100):
            made = FuseFilter(seed, segment, starts,
                              np.zeros((starts + 2) * segment, dtype=np.uint8))
            if made._fill(keys):
                return made
            if seed % 10 == 0:
                starts += max(1, starts // 8)
        raise RuntimeError("no seed peels these keys")

    def places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The three slots of each key and its fingerprint."""
        h = mixed(keys.astype(np.uint64) + np.uint64(self.seed) * np.uint64(0x9E3779B97F4A7C15))
        size, mask = np.uint64(self.segment), np.uint64(self.segment - 1)
        first = ((h >> np.uint64(32)) * np.uint64(self.starts * self.segment)) >> np.uint64(32)
        base = first - (first & mask)
        slots = np.stack([first, base + size + ((first ^ (h >> np.uint64(14))) & mask),
                          base + size + size + ((first ^ h) & mask)])
        return slots.astype(np.int64), (mixed(h) >> np.uint64(56)).astype(np.uint8)

    def _fill(self, keys: np.ndarray) -> bool:
        slots, prints = self.places(keys)
        count = np.zeros(len(self.table), dtype=np.int32)
        owner = np.zeros(len(self.table), dtype=np.int64)
        index = np.arange(len(keys))
        for row in slots:
            np.add.at(count, row, 1)
            np.bitwise_xor.at(owner, row, index)
        rounds, left = [], len(keys)
        while left:
            single = np.flatnonzero(count == 1)
            peeled, where = np.unique(owner[single], return_index=True)
            if not len(peeled):
                return False
            rounds.append((peeled, single[where]))
            for row in slots[:, peeled]:
                np.subtract.at(count, row, 1)
                np.bitwise_xor.at(owner, row, peeled)
            left -= len(peeled)
        for peeled, own in reversed(rounds):
            others = slots[:, peeled]
            value = prints[peeled].copy()
            for row in others:
                value ^= np.where(row == own, 0, self.table[row]).astype(np.uint8)
            self.table[own] = value
        return True

    def contains(self, keys: np.ndarray) -> np.ndarray:
        slots, prints = self.places(keys)
        return prints == self.table[slots[0]] ^ self.table[slots[1]] ^ self.table[slots[2]]

    def to_bytes(self) -> bytes:
        head = np.array([self.seed, self.segment, self.starts], dtype="<i8")
        return head.tobytes() + self.table.tobytes()

    @staticmethod
    def from_bytes(blob: bytes) -> FuseFilter:
        seed, segment, starts = np.frombuffer(blob[:24], dtype="<i8").tolist()
        return FuseFilter(seed, segment, starts, np.frombuffer(blob[24:], dtype=np.uint8))


# --- digests and groups --------------------------------------------------------------------

def normalised(text: str = "text") -> Column:
    return F.regexp_replace(text_of(text), SPACES + "+", "")


def digest(text: str = "text") -> Column:
    return F.sha2(normalised(text), 256)


def shard_of(shards: int) -> Column:
    return F.pmod(F.xxhash64("sha"), F.lit(shards)).cast("int").alias("shard")


def _rank() -> Column:
    """Smallest for the row that stays."""
    return F.struct(-F.col("n_chars"), F.col("doc_id").isNull(), F.col("doc_id"), F.col("row"))


def grouped(rows: DataFrame) -> DataFrame:
    """One row for each digest: who stays, and how many rows there are."""
    best = rows.groupBy("sha").agg(
        F.min(_rank()).alias("best"), F.count(F.lit(1)).alias("n_rows"))
    return best.select("sha", "n_rows", (-F.col("best.col1")).alias("n_chars"),
                       F.col("best.doc_id").alias("doc_id"), F.col("best.row").alias("row"))


def filters(snapshot: DataFrame, shards: int) -> DataFrame:
    """The filter of every shard, as a table of blobs."""

    def build(part: pd.DataFrame) -> pd.DataFrame:
        made = FuseFilter.build(part["key"].to_numpy().view(np.uint64))
        return pd.DataFrame({"shard": part["shard"].iloc[:1].astype("int32"),
                             "blob": [made.to_bytes()]})

    keys = snapshot.select(shard_of(shards), F.xxhash64(F.lit("key"), "sha").alias("key"))
    return keys.groupBy("shard").applyInPandas(build, "shard int, blob binary")


def screened(batch: DataFrame, blobs: DataFrame, shards: int) -> DataFrame:
    """A grouped batch with ``maybe``: false where the snapshot cannot hold the digest."""

    def ask(part: pd.DataFrame, blob: pd.DataFrame) -> pd.DataFrame:
        hit = np.zeros(len(part), dtype=bool)
        if len(blob) and len(part):
            known = FuseFilter.from_bytes(bytes(blob["blob"].iloc[0]))
            hit = known.contains(part["key"].to_numpy().view(np.uint64))
        return part.drop(columns=["shard", "key"]).assign(maybe=hit)

    # As text, since pandas turns a column of integers with a NULL into floats.
    named = batch.withColumn("doc_id", F.col("doc_id").cast("string"))
    keyed = named.select("*", shard_of(shards), F.xxhash64(F.lit("key"), "sha").alias("key"))
    schema = T.StructType([*named.schema.fields, T.StructField("maybe", T.BooleanType())])
    asked = keyed.groupBy("shard").cogroup(blobs.groupBy("shard")).applyInPandas(ask, schema)
    return asked.withColumn("doc_id", F.col("doc_id").cast(batch.schema["doc_id"].dataType))


def confirmed(docs: DataFrame, hits: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Hits whose text is, byte for byte, the one the snapshot holds under the same digest."""
    pairs = staged(
        hits.select("sha", "row").join(
            snapshot.select("sha", F.col("row").alias("other")), "sha"), "pairs")
    wanted = pairs.select("sha", F.explode(F.array("row", "other")).alias("row"))
    # The hits grow with the batch, so their texts are merged, at any size.
    texts = docs.select("row", normalised().alias("norm")).join(wanted.hint("merge"), "row")
    equal = texts.groupBy("sha").agg(F.min("norm").alias("low"), F.max("norm").alias("high"))
    clash = F.raise_error(F.lit("two texts share a SHA-256 digest"))
    proven = equal.filter(F.when(F.col("low") == F.col("high"), True).otherwise(clash))
    return hits.join(proven.select("sha"), "sha", "left_semi")


def decide(docs: DataFrame, shard_keys: int = SHARD_KEYS, snapshots: int = 1) -> DataFrame:
    """Decision on every row: ``row, doc_id, sha, keep_id, keep_row, group_size, kept``.

    ``docs`` has ``row`` (unique, stable), ``doc_id``, ``text``. It is loaded as ``snapshots``
    immutable snapshots and one new batch, dealt by a hash of ``row``, each screened against
    all snapshots before it.
    """
    rows = staged(docs.select(
        "row", "doc_id", F.char_length(text_of()).cast("bigint").alias("n_chars"),
        digest().alias("sha"),
        F.pmod(F.xxhash64("row"), F.lit(snapshots + 1)).cast("int").alias("load")), "digests")
    shards = max(1, rows.count() // shard_keys)
    known: list[list[DataFrame]] = []
    for load in range(snapshots + 1):
        fresh = staged(grouped(rows.filter(F.col("load") == load)), "batch")
        for held in known:
            asked = staged(screened(fresh, held[1], shards), "asked")
            hits = asked.filter("maybe").drop("maybe")
            same = staged(confirmed(docs, hits, held[0]), "confirmed")
            held.append(same)
            fresh = asked.filter(~F.col("maybe")).drop("maybe").unionByName(
                hits.join(same.select("sha"), "sha", "left_anti"))
        if load < snapshots:
            fresh = staged(fresh, "snapshot") if known else fresh
            known.append([fresh, staged(filters(fresh, shards), "filters")])
    groups = fresh.withColumnRenamed("n_rows", "group_size")
    for snapshot, _, *copies in known:
        held = snapshot
        for same in copies:
            held = held.unionByName(same)
        groups = groups.unionByName(
            held.groupBy("sha").agg(F.min(_rank()).alias("best"),
                                    F.sum("n_rows").alias("group_size"))
            .select("sha", "group_size", (-F.col("best.col1")).alias("n_chars"),
                    F.col("best.doc_id").alias("doc_id"), F.col("best.row").alias("row")))
    total = staged(groups.select("sha", "group_size", F.col("doc_id").alias("keep_id"),
                                 F.col("row").alias("keep_row")), "groups")
    return rows.join(total, "sha").select(
        "row", "doc_id", "sha", "keep_id", "keep_row", "group_size",
        (F.col("row") == F.col("keep_row")).alias("kept"))


def survivors(docs: DataFrame, written: bool = False, **options) -> DataFrame:
    """The rows that stay, with the columns they came with."""
    keyed = whole_rows(docs, "dedup-input", written)
    kept = decide(keyed, **options).filter("kept").select("row")
    return keyed.join(kept, "row", "left_semi").select("_d.*")


def table(docs: DataFrame, **options) -> DataFrame:
    """One row for each document, dropped ones too."""
    keyed = with_row(docs, "doc_id", "text")
    return decide(keyed, **options).select(
        "doc_id", "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256"))
