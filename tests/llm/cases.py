"""Inputs for the operator tests: the smallest corpus plus every odd row that must not hurt."""

from __future__ import annotations

import random
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
# The last four clash with names the operators use inside.
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()), T.StructField("row", T.StringType()),
    T.StructField("sha", T.IntegerType()), T.StructField("component", T.StringType()),
    T.StructField("copies", T.StringType())])
EMPTY = "empty"


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def odd_rows() -> list[tuple]:
    """NULLs, blanks, a very long text, ties, repeats, near copies, foreign scripts."""
    draw = random.Random(5)
    base = [f"w{draw.randrange(4000)}" for _ in range(120)]
    long = " ".join(f"x{draw.randrange(900)}" for _ in range(30_000))
    texts = [
        (10_000, None), (10_001, ""), (10_002, " \t\n"), (10_003, "one"), (10_004, "One  two"),
        (10_005, "one two"), (10_006, long), (10_007, " ".join(base)),
        (10_008, "  ".join(base)), (10_009, " ".join(base[:60] + ["new"] + base[61:])),
        (10_010, " ".join(base)), (10_010, " ".join(base)), (10_010, "other text here"),
        (None, "a text without an id"), (None, None), (10_011, "same " * 80),
        (10_012, "日本語のテキスト 🎉 ½ ﬁn 123"), (10_013, "1234 5678 !!"),
        (10_014, " ".join(base[:9])), (10_015, " ".join(base[:8] + ["tail"])),
        (10_016, " ".join(base[:20])), (10_017, " ".join(base[:19] + ["y"])),
        (10_018, "A\u001cB\u0085C D"), (10_019, " ".join(base[40:]))]
    return [(i, t, None if k % 3 == 0 else "en", None if k % 4 == 0 else "s", None, "r", k, "c",
             None) for k, (i, t) in enumerate(texts)]


def corpus(spark: SparkSession, odd: bool = True) -> DataFrame:
    """The documents of the smallest scale, and the odd ones."""
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    plain = documents.select("*", *[F.lit(None).cast(f.dataType).alias(f.name)
                                    for f in SCHEMA.fields[5:]])
    strange = spark.createDataFrame(odd_rows() if odd else [], SCHEMA)
    return plain.unionByName(strange)


def none(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def pairs(df: DataFrame) -> list[tuple[int | None, str | None]]:
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def bag(rows) -> list:
    """Sorted, NULLs last, whatever the types."""
    return sorted((tuple(r) for r in rows), key=lambda r: [(v is None, str(v)) for v in r])
