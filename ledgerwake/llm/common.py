"""Reading inputs, staging intermediate tables, and word helpers the operators share."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwake.sources.scratch import scratch_dir

# Characters that separate words, as SQL regex and as a byte table.
SPACES = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

PARALLELISM = "spark.sql.leafNodeDefaultParallelism"

# Odd multipliers of the word and shingle hashes.
BASE = np.uint64(0x9E3779B97F4A7C15)
MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and go on from the written table."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def with_row(df: DataFrame, *columns: Column | str) -> DataFrame:
    """Selected columns behind a unique ``row``.

    Over a scan of written files the numbers stay the same from job to job: how files are cut
    must then not follow the executors alive, so the session's parallelism is fixed here at its
    present value. Anything else is to be staged before it is used twice.
    """
    spark = df.sparkSession
    if spark.conf.get(PARALLELISM, None) is None:
        spark.conf.set(PARALLELISM, str(spark.sparkContext.defaultParallelism))
    return df.select(F.monotonically_increasing_id().alias("row"), *columns)


def whole_rows(df: DataFrame, name: str, written: bool) -> DataFrame:
    """``row, _d, doc_id, text``, where ``_d`` holds all columns of ``df``.

    ``written`` promises that ``df`` is a scan of written files, which need no other copy.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_d")
    rows = with_row(df, whole, "doc_id", "text")
    return rows if written else staged(rows, name)


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def batches_of(batch: pa.RecordBatch, column: str) -> Iterator[str | None]:
    """Values of a column one by one; only one of them is a Python object at a time."""
    for value in batch.column(column):
        yield value.as_py()


def mixed(x: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash so that all its bits depend on all input bits."""
    x = (x ^ (x >> np.uint64(30))) * MIX[0]
    x = (x ^ (x >> np.uint64(27))) * MIX[1]
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of BASE and of its inverse modulo 2^64, as long as the longest text so far."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            steps = np.full(size, BASE, dtype=np.uint64)
            back = np.full(size, np.uint64(pow(int(BASE), -1, 1 << 64)), dtype=np.uint64)
            steps[0] = back[0] = 1
            self.up, self.down = np.cumprod(steps), np.cumprod(back)
        return self.up, self.down


_powers = Powers()


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word in UTF-8 bytes."""
    space = np.ones(len(data) + 2, dtype=np.int8)
    space[1:-1] = IS_SPACE[data]
    edges = np.flatnonzero(np.diff(space))
    return edges[0::2], edges[1::2]


def word_hashes(text: str | None, lower: bool = False) -> np.ndarray:
    """A 64-bit hash for every word of a text, in order; A-Z folded if ``lower``."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)
    if lower:
        data = LOWER[data]
    starts, ends = word_bounds(data)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    up, down = _powers.upto(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=total[1:])
    value = (total[ends] - total[starts]) * down[starts]
    return mixed(value ^ ((ends - starts).astype(np.uint64) * MIX[0]))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of every run of ``n`` words; of all words if there are fewer."""
    n = min(n, len(words))
    if not n:
        return words
    value = np.zeros(len(words) - n + 1, dtype=np.uint64)
    for j in range(n):
        value = (value + words[j:len(words) - n + 1 + j]) * BASE
        value ^= value >> np.uint64(29)
    return mixed(value + np.uint64(n))


def words_of(text: str | None) -> list[str]:
    return _word.findall(text or "")


_word = re.compile(WORD)
