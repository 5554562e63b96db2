"""Bottom-k sketches of shingle hashes, in DataFrame functions only.

The sketch of a text is the ``k`` smallest distinct 64-bit hashes of its shingles of ``width``
words, in ascending order. It depends on the set of shingles alone: repeated text does not
change it, the sketch of two parts is the sketch of their sketches (:func:`merged`), and equal
texts have equal sketches. From sketches follow the resemblance, the containment and the number
of distinct shingles, all exact as long as a set has no more than ``k`` members.

NULL counts as the empty text, which has no shingle and an empty sketch; a text of fewer than
``width`` words is one shingle. Two empty sketches resemble each other fully, an empty and a
non-empty one not at all. Very long texts are sketched whole. Repeated rows and ids follow each other
by a hash of their text; other columns are ignored, and an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerwake.llm.common import SPACES, partitions, staged, text_of

WIDTH = 5
K = 128
# Ranges of documents for each task of the next-document pass.
RANGES = 16


def words(text: Column) -> Column:
    """Words between runs of white space; none for a blank text."""
    trimmed = F.regexp_replace(text, f"^{SPACES}+|{SPACES}+$", "")
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, f"{SPACES}+"))


def sketch(word_list: Column, width: int = WIDTH, k: int = K) -> Column:
    """Bottom-k sketch of an array of words."""
    last = F.size(word_list) - width
    many = F.transform(
        F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
        lambda i: F.xxhash64(*[F.get(word_list, i + j) for j in range(width)]))
    few = F.array(F.xxhash64(F.array_join(word_list, " ")))
    hashes = F.when(last >= 0, many).when(F.size(word_list) > 0, few).otherwise(
        F.array().cast("array<bigint>"))
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def merged(left: Column, right: Column, k: int = K) -> Column:
    """Sketch of the union of the texts behind two sketches."""
    return F.slice(F.sort_array(F.array_union(left, right)), 1, k)


def resemblance(left: Column, right: Column, k: int = K) -> Column:
    """Estimated Jaccard likeness of the two shingle sets, 0 to 1."""
    union = merged(left, right, k)
    both = F.size(F.array_intersect(F.array_intersect(union, left), right))
    return F.when(F.size(union) == 0, 1.0).otherwise(both / F.size(union))


def distinct_shingles(found: Column, k: int = K) -> Column:
    """Estimated size of the shingle set; exact while it is below ``k``."""
    reach = (F.try_element_at(found, F.lit(-1)).cast("double") + F.lit(2.0 ** 63)) / F.lit(2.0 ** 64)
    return F.when(F.size(found) < k, F.size(found).cast("double")).otherwise((k - 1) / reach)


def containment(left: Column, right: Column, k: int = K) -> Column:
    """Estimated share of the left set that the right set holds."""
    both = resemblance(left, right, k) * distinct_shingles(merged(left, right, k), k)
    size = distinct_shingles(left, k)
    return F.when(size == 0, 1.0).otherwise(F.least(both / size, F.lit(1.0)))


def printed(found: Column) -> Column:
    """Sketch as text: 16 hexadecimal digits for each hash."""
    return F.array_join(F.transform(found, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def _bucketed(docs: DataFrame, ranges: int) -> DataFrame:
    """Deal documents into ranges of their order, each with the head of the range after it.

    The ranges are those of Spark's sampled sort, so they hold about as many rows each, whatever
    the ids are. Their heads, one for each range, are an array that every row is looked up in by
    halving. Rows that equal a head are copied to the range before it (those of the first behind
    the last), so each document meets its successor and the text is shuffled once.
    """
    key = F.struct("doc_id", "tie")
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("tie"))
    light = rows.select("doc_id", "tie").repartitionByRange(ranges, "doc_id", "tie").groupBy(
        F.spark_partition_id().alias("range")).agg(F.min(key).alias("head"))
    heads = staged(light.select("head"), "heads").agg(
        F.sort_array(F.collect_list("head")).alias("heads"))
    found = rows.withColumn("_heads", heads.scalar())

    def half(at: Column, step: Column) -> Column:
        # The last head that is not behind the row is at ``at`` or later.
        inside = at + step < F.size("_heads")
        return F.when(inside & (F.get("_heads", at + step) <= key), at + step).otherwise(at)

    steps = F.array(*[F.lit(1 << k) for k in reversed(range(max(1, ranges).bit_length() + 1))])
    found = found.withColumn("bucket", F.aggregate(steps, F.lit(0), half))
    first = F.get("_heads", F.col("bucket")) == key
    before = F.when(F.col("bucket") > 0, F.col("bucket")).otherwise(F.size("_heads")) - 1
    kept = ["doc_id", "text", "tie"]
    copies = found.filter(first).select(*kept, before.alias("bucket"), F.lit(True).alias("copy"))
    return found.select(*kept, "bucket", F.lit(False).alias("copy")).unionByName(
        copies.dropDuplicates(["bucket"]))


def with_next(docs: DataFrame, columns: Callable[[DataFrame], DataFrame], *carried: str,
              ranges: int | None = None) -> DataFrame:
    """Every document with ``next_text`` and the next value of each column in ``carried``.

    ``columns`` adds the carried ones. Next is by ascending ``doc_id`` (NULL first, ties by a
    hash of the text); the first follows the last. A document alone is its own successor.
    """
    order = Window.partitionBy("bucket").orderBy("copy", "doc_id", "tie")
    ranges = ranges or RANGES * partitions(docs.sparkSession)
    rows = _bucketed(docs.select("doc_id", text_of().alias("text")), ranges)
    following = {"next_" + c: F.lead(c).over(order) for c in ("text", *carried)}
    return columns(rows).withColumns(following).filter(~F.col("copy"))


def edited(text: Column, other: Column) -> Column:
    """The last half of a text, rounded down, replaced by as many characters of another."""
    n = F.char_length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(other, F.lit(1), half))


def table(docs: DataFrame, width: int = WIDTH, k: int = K) -> DataFrame:
    """Fingerprint of every document and of its edited text, and their likeness."""

    def sketched(df: DataFrame, text: str, name: str) -> DataFrame:
        # A column of its own: inside the lambda of a sketch the split would run once a word.
        split = df.withColumn("_words", words(F.col(text)))
        return split.withColumn(name, sketch(F.col("_words"), width, k)).drop("_words")

    rows = with_next(docs, lambda df: sketched(df, "text", "found"), "found")
    rows = rows.withColumn("edited_text", edited(F.col("text"), F.col("next_text")))
    rows = sketched(rows, "edited_text", "edited_found")
    return rows.select(
        "doc_id", F.char_length("text").cast("bigint").alias("n_chars"),
        F.sha2("edited_text", 256).alias("edited_sha256"),
        printed(F.col("found")).alias("fingerprint"),
        printed(F.col("edited_found")).alias("edited_fingerprint"),
        resemblance(F.col("found"), F.col("edited_found"), k).alias("near_edited"),
        resemblance(F.col("found"), F.col("next_found"), k).alias("near_next"),
        distinct_shingles(F.col("found"), k).alias("n_shingles"))
