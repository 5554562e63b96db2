"""Substring dedup on sharded FM-indexes.

A window is ``window`` consecutive words of one document; a word goes if a window over it also
starts anywhere else. Equal windows are brought together by content: the smallest hash among a
window's ``GRAM``-word runs is the same wherever the window stands, and consecutive windows with
the same smallest run form a segment, which holds exactly those windows.

1. Segments whose smallest run occurs only once cannot repeat. A run that occurs twice in a
   batch of documents is known to repeat and leaves a single row to tell the other batches, so a
   passage in every document costs a row for each batch, not for each document.
2. Equal segments become one, with their number as weight, and only now are words fetched.
3. Segments are dealt to shards by their smallest run. Each shard builds a compressed FM-index,
   streams its segments through it by backward search, and reports the windows with a total
   weight of two or more.
   Runs with more than ``HOT`` different segments, such as those of a frequent line among
   different neighbours, go to no shard: each of their windows is keyed by the run and its own
   hash and counted, which spreads a run over all tasks.
4. The reports go back to all documents with such a segment, and the words under them go.

NULL and blank texts have no words. A text shorter than a window keeps everything. Windows are
judged on the input, so two copies of a passage both lose it. Rows repeated in full are rows of
their own and repeat each other. Very long texts are searched whole, and an empty table gives an
empty one. Other columns are ignored. Words are compared by 64-bit hashes
until step 2 and by 40 bits each within a shard, all words of a window at once; windows of a hot
run by one 64-bit hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwake.llm.common import (
    BASE,
    gram_hashes,
    mixed,
    partitions,
    staged,
    text_of,
    with_row,
    word_hashes,
)
from ledgerwake.llm.fm_index import FmIndex

WINDOW = 35
GRAM = 8
# Words for each shard, on average.
SHARD_WORDS = 1 << 18
SYMBOL_BYTES = 5
# Different segments of one smallest run that a shard takes.
HOT = 1 << 12


def segments(words: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """Start, number of windows, smallest run and content hash of every segment."""
    gram = max(min(GRAM, window), window - 62)  # a segment's windows fit in 63 bits
    if len(words) < window:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none.view(np.uint64), none.view(np.uint64)
    grams = gram_hashes(words, gram)
    least = sliding_window_view(grams, window - gram + 1).argmin(axis=1)
    least += np.arange(len(least))
    start = np.flatnonzero(np.diff(least, prepend=-1))
    count = np.diff(np.append(start, len(least)))
    powers = np.cumprod(np.full(len(words) + 1, BASE, dtype=np.uint64))
    total = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(words * powers[:-1], out=total[1:])
    # Scale each difference to the same power, so equal content has equal sums.
    content = (total[start + count + window - 1] - total[start]) * powers[len(words) - start]
    inverse = np.uint64(pow(int(powers[-1]), -1, 1 << 64))
    return start, count, grams[least[start]], mixed(content * inverse + count.astype(np.uint64))


def instances(docs: DataFrame, window: int) -> DataFrame:
    """Segments of all documents. ``weight`` 0: known to repeat; 2: so, and tells the others."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = [segments(word_hashes(text), window) for text in batch["text"]]
            run = np.concatenate([p[2] for p in parts])
            _, first, inverse, times = np.unique(
                run, return_index=True, return_inverse=True, return_counts=True)
            weight = np.where(times[inverse] > 1, 0, 1)
            weight[first[times > 1]] = 2
            yield pd.DataFrame({
                "run": run.view(np.int64),
                "content": np.concatenate([p[3] for p in parts]).view(np.int64),
                "row": np.repeat(batch["row"].to_numpy(), [len(p[0]) for p in parts]),
                "start": np.concatenate([p[0] for p in parts]), "weight": weight})

    return docs.select("row", "text").mapInPandas(
        cut, "run bigint, content bigint, row bigint, start int, weight int")


def repeated(found: DataFrame) -> DataFrame:
    """The segments whose smallest run occurs at least twice."""

    def runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        last = None
        for batch in batches:
            if not len(batch):
                continue
            # Rows in front of the last run are complete; that one may go on.
            key = batch["run"].to_numpy()
            cut = int(np.flatnonzero(key != key[-1])[-1]) + 1 if (key != key[-1]).any() else 0
            if cut or (last is not None and last != key[-1]):
                yield _complete(pd.concat([*held, batch.iloc[:cut]]))
                held = []
            held, last = [*held, batch.iloc[cut:]], key[-1]
            # Two rows prove a run; more need not be held back.
            if sum(map(len, held)) > 2 and last is not None:
                whole = pd.concat(held)
                proven = whole.iloc[:-1]
                yield proven[["run", "content", "row", "start"]]
                held = [whole.iloc[-1:].assign(weight=2)]
        if held:
            yield _complete(pd.concat(held))

    dealt = F.when(F.col("weight") == 0, F.xxhash64("row", "start")).otherwise(F.lit(0))
    # What rows are dealt by does not travel with them.
    ranged = found.repartition(
        partitions(found.sparkSession), "run", dealt).sortWithinPartitions("run")
    return ranged.select("run", "content", "row", "start", "weight").mapInPandas(
        runs, "run bigint, content bigint, row bigint, start int")


def _complete(rows: pd.DataFrame) -> pd.DataFrame:
    """Of complete runs, those that repeat; rows of weight 0 are known to."""
    weight = np.maximum(rows["weight"].to_numpy(), 0)
    _, inverse = np.unique(rows["run"].to_numpy(), return_inverse=True)
    total = np.bincount(inverse, weights=weight, minlength=1)
    keep = (weight == 0) | (total[inverse] >= 2) if len(rows) else np.zeros(0, dtype=bool)
    return rows.loc[keep, ["run", "content", "row", "start"]]


def compressed(docs: DataFrame, *columns: Column) -> DataFrame:
    """Texts packed for the way through a shuffle."""

    @F.pandas_udf("binary")
    def pack(text: pd.Series) -> pd.Series:
        press = zstandard.ZstdCompressor(level=3).compress
        return pd.Series([press(t.encode("utf-8", "surrogatepass")) for t in text])

    return docs.select("row", pack(text_of()).alias("z"), *columns)


def with_words(docs: DataFrame, distinct: DataFrame, window: int) -> DataFrame:
    """The words of distinct segments, as symbols, from the first document that has them."""
    wanted = distinct.groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("content", "weight"))).alias("found")).select(
        "row", F.col("found.content").alias("contents"), F.col("found.weight").alias("weights"))

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpress = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out = []
            for z, contents, weights in zip(
                    batch["z"], batch["contents"], batch["weights"], strict=True):
                words = word_hashes(unpress(z).decode("utf-8", "surrogatepass"))
                start, count, run, content = segments(words, window)
                symbols = words.view(np.uint8).reshape(-1, 8)[:, :SYMBOL_BYTES]
                # A document may hold a segment many times; one is enough.
                _, first = np.unique(content, return_index=True)
                for i in first[np.isin(content[first].view(np.int64), contents)].tolist():
                    end = start[i] + count[i] + window - 1
                    own = content[i].astype(np.int64)
                    out.append((run[i].astype(np.int64), own, symbols[start[i]:end].tobytes(),
                                weights[np.searchsorted(contents, own)]))
            yield pd.DataFrame(out, columns=["run", "content", "symbols", "weight"])

    joined = compressed(docs).join(wanted.hint("merge"), "row")
    return joined.mapInPandas(fetch, "run bigint, content bigint, symbols binary, weight bigint")


def symbols_of(blob: bytes) -> np.ndarray:
    wide = np.zeros((len(blob) // SYMBOL_BYTES, 8), dtype=np.uint8)
    wide[:, :SYMBOL_BYTES] = np.frombuffer(blob, dtype=np.uint8).reshape(-1, SYMBOL_BYTES)
    return wide.view(np.uint64).ravel()


def judged(shards: DataFrame, window: int) -> DataFrame:
    """For each distinct segment with a repeated window: a bit for each such window."""

    def search(group: pd.DataFrame) -> pd.DataFrame:
        sequences = [symbols_of(b) for b in group["symbols"]]
        index = FmIndex(sequences, group["weight"].to_numpy(), window)
        bits = [int(np.dot(times >= 2, 1 << np.arange(len(times), dtype=np.int64)))
                for times in index.occurrences(sequences)]
        out = group[["run", "content"]].assign(bits=bits)
        return out[out["bits"] != 0]

    return shards.groupBy("shard").applyInPandas(
        search, "run bigint, content bigint, bits bigint")


def trimmed(docs: DataFrame, reports: DataFrame, window: int) -> DataFrame:
    """Word counts and kept text of every document; ``reports`` has ``row, start, bits``."""
    # Bounded by the words of the document.
    lists = reports.groupBy("row").agg(
        F.collect_list("start").alias("starts"), F.collect_list("bits").alias("bits"))

    def trim(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpress = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out = []
            for z, starts, bits in zip(batch["z"], batch["starts"], batch["bits"], strict=True):
                words = bytes(unpress(z)).split()
                if starts is not None:
                    depth = np.zeros(len(words) + 1, dtype=np.int64)
                    for start, found in zip(starts, bits, strict=True):
                        at = start + np.flatnonzero(found >> np.arange(window) & 1)
                        np.add.at(depth, at, 1)
                        np.add.at(depth, at + window, -1)
                    kept = [words[i] for i in np.flatnonzero(np.cumsum(depth)[:-1] == 0).tolist()]
                else:
                    kept = words
                text = b" ".join(kept)
                out.append((len(words), len(words) - len(kept),
                            hashlib.sha256(text).hexdigest(), len(text)))
            yield batch[["doc_id"]].join(pd.DataFrame(
                out, columns=["n_words", "n_removed", "kept_sha256", "kept_bytes"],
                index=batch.index))

    named = compressed(docs, F.col("doc_id").cast("string").alias("doc_id"))
    found = named.join(lists.hint("merge"), "row", "left").mapInPandas(
        trim, "doc_id string, n_words bigint, n_removed bigint, kept_sha256 string, "
              "kept_bytes bigint")
    return found.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))


def hot_windows(docs: DataFrame, found: DataFrame, window: int) -> DataFrame:
    """``row, start, bits`` for segments of hot runs, window by window."""
    # Bounded by the words of the document.
    lists = found.groupBy("row").agg(F.collect_set("start").alias("starts"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpress = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for row, z, starts in zip(batch["row"], batch["z"], batch["starts"], strict=True):
                words = word_hashes(unpress(z).decode("utf-8", "surrogatepass"))
                start, count, run, _ = segments(words, window)
                hot = np.isin(start, starts)
                start, count, run = start[hot], count[hot], run[hot]
                place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                first = np.repeat(start, count)
                yield pd.DataFrame({
                    "run": np.repeat(run, count).view(np.int64),
                    "hash": gram_hashes(words, window)[first + place].view(np.int64),
                    "row": row, "start": first, "place": place})

    joined = compressed(docs).join(lists.hint("merge"), "row")
    windows = staged(joined.mapInPandas(
        cut, "run bigint, hash bigint, row bigint, start int, place int"), "hot-windows")
    many = windows.groupBy("run", "hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return windows.join(many, ["run", "hash"]).groupBy("row", "start").agg(
        F.bit_or(F.expr("shiftleft(1L, place)")).alias("bits"))


def repeated_windows(docs: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS,
                     hot: int = HOT) -> DataFrame:
    """``row, start, bits``: bit ``i`` tells that the window at word ``start + i`` repeats."""
    found = staged(repeated(instances(docs, window)), "segments")
    distinct = staged(found.groupBy("run", "content").agg(
        F.count(F.lit(1)).alias("weight"), F.min("row").alias("row")), "distinct")
    runs = staged(distinct.groupBy("run").agg(F.count(F.lit(1)).alias("n")).filter(
        F.col("n") > hot).select("run"), "hot-runs")
    crowded = not runs.isEmpty()
    if crowded:
        distinct = distinct.join(runs, "run", "left_anti")
    words = with_words(docs, distinct, window)
    shards = max(1, distinct.count() * (window + window // 2) // shard_words)
    dealt = words.withColumn("shard", F.pmod(F.xxhash64("run"), F.lit(shards)))
    reports = staged(judged(dealt, window), "reports")
    out = found.join(reports, ["run", "content"]).select("row", "start", "bits")
    if crowded:
        out = out.unionByName(hot_windows(docs, found.join(runs, "run", "left_semi"), window))
    return out


def table(docs: DataFrame, window: int = WINDOW, **options) -> DataFrame:
    """Words, removed words and checksum of what is kept, for every document."""
    keyed = with_row(docs, "doc_id", "text")
    return trimmed(keyed, repeated_windows(keyed, window, **options), window)
