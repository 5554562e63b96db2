"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training adds up n-gram counts for each language and hash bucket, one row for each of them and
task, so the shuffle does not grow with the texts. The log-probability matrix (languages x
``BUCKETS`` floats) is broadcast; its size is fixed by the number of languages, not of documents.
Scoring is a sparse product in numpy: the buckets and counts of a batch of documents times the
matrix, summed for each document.

NULL texts and texts without a letter are ``und`` with score 0, as is everything if there is
nothing to learn from. Among equal posteriors the language first in alphabetical order wins.
Repeated rows are scored alike; other columns are ignored. Very long texts are counted whole, and an
empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwake.llm.common import partitions

BUCKETS = 1 << 15
SIZES = (1, 2, 3)
# Documents of a sparse product; a long text has no more than ``BUCKETS`` counts.
BATCH = 32
SMOOTHING = 0.5
UNKNOWN = "und"


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def ngram_counts(text: str, buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket occurs among the character n-grams of a text."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    total = np.zeros(buckets, dtype=np.int64)
    value = np.zeros(len(points), dtype=np.uint32)
    for n in SIZES:
        if len(points) < n:
            break
        value = value[:len(points) - n + 1] * np.uint32(0x01000193) + points[n - 1:]
        slot = ((value ^ np.uint32(n)) * np.uint32(0x9E3779B1)) >> np.uint32(17)
        total += np.bincount(slot & np.uint32(buckets - 1), minlength=buckets)
    return total


def sparse(text: str, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets that occur in a text, and how often."""
    total = ngram_counts(text, buckets)
    slots = np.flatnonzero(total)
    return slots, total[slots].astype(np.float64)


def train(examples: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Counts for each language and bucket of ``examples(text, lang)``, with documents."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[str, np.ndarray] = {}
        docs: dict[str, int] = {}
        for batch in batches:
            for text, lang in zip(batch["text"], batch["lang"], strict=True):
                found = totals.setdefault(lang, np.zeros(buckets, dtype=np.int64))
                found += ngram_counts(text, buckets)
                docs[lang] = docs.get(lang, 0) + 1
        for lang, total in totals.items():
            slots = np.flatnonzero(total)
            yield pd.DataFrame({"lang": lang, "slot": slots.astype("int32"),
                                "n": total[slots]})
            yield pd.DataFrame({"lang": [lang], "slot": np.array([-1], dtype="int32"),
                                "n": [docs[lang]]})

    usable = examples.filter(F.col("text").isNotNull() & F.col("lang").isNotNull())
    parts = usable.select("text", "lang").mapInPandas(count, "lang string, slot int, n bigint")
    return parts.groupBy("lang", "slot").agg(F.sum("n").alias("n"))


class Model:
    """Languages in alphabetical order, their log priors and log probabilities."""

    def __init__(self, counts: pd.DataFrame, buckets: int = BUCKETS) -> None:
        self.langs = sorted(counts["lang"].unique())
        row = counts["lang"].map({x: i for i, x in enumerate(self.langs)}).to_numpy(dtype=int)
        table = np.zeros((len(self.langs), buckets + 1))
        table[row, counts["slot"].to_numpy()] = counts["n"].to_numpy()
        grams = table[:, :-1] + SMOOTHING
        self.matrix = np.log(grams / grams.sum(axis=1, keepdims=True)).T.astype(np.float32)
        self.prior = np.log(table[:, -1] / table[:, -1].sum()) if len(table) else table[:, -1]
        self.buckets = buckets

    def predict(self, texts: Sequence[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and posterior of a batch of texts: sparse counts times the matrix."""
        langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        usable = [i for i, t in enumerate(texts) if isinstance(t, str) and self.langs and has_letter(t)]
        for part in range(0, len(usable), BATCH):
            rows = usable[part:part + BATCH]
            slots, counts = zip(*(sparse(texts[i], self.buckets) for i in rows), strict=True)
            starts = np.cumsum([0, *map(len, slots[:-1])])
            weighed = self.matrix[np.concatenate(slots)] * np.concatenate(counts)[:, None]
            logs = np.add.reduceat(weighed, starts, axis=0, dtype=np.float64) + self.prior
            best = logs.argmax(axis=1)
            scores[rows] = 1.0 / np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1)
            for i, b in zip(rows, best, strict=True):
                langs[i] = self.langs[b]
        return langs, scores


def fit(examples: DataFrame) -> Model:
    """The matrix on the driver: at most languages x (buckets + 1) counts."""
    return Model(train(examples).toPandas())


def predict(docs: DataFrame, model: Model, *columns: str) -> DataFrame:
    """``columns`` of every document with ``lang_pred`` and ``score``; reads ``text`` only."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("struct<lang_pred:string,score:double>")
    def score(text: pd.Series) -> pd.DataFrame:
        langs, scores = shared.value.predict(text.tolist())
        return pd.DataFrame({"lang_pred": langs, "score": scores})

    # Only the text goes through Python; the other columns stay as they are.
    return docs.select(*columns, score("text").alias("_found")).select(
        *columns, "_found.lang_pred", "_found.score")


def held_out(key: str = "doc_id"):
    """Documents no model may learn from: the checksum of their id leaves remainder 2."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def table(docs: DataFrame) -> DataFrame:
    """Train on what is not held out, then predict every document."""
    model = fit(docs.filter(~held_out()).select("text", "lang"))
    return predict(docs.withColumn("held_out", held_out()), model, "doc_id", "held_out")
