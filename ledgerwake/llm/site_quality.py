"""Quality classifier with hierarchical empirical Bayes over hosts and paths.

1. A logistic regression over text statistics is fitted on labelled documents: at most
   ``FIT_ROWS`` of them, taken in the order of a hash of their id. Its log odds, less the log
   odds of the training share, are the evidence of a single document.
2. Grouped aggregation turns the posteriors of all documents into a mean for each path and
   host. Sparse sites shrink: a host towards the global mean, a path towards its host, with
   prior strengths estimated from the spread between the sites by the method of moments.
3. The score of a document is its evidence plus the log odds of its path, from which the
   document's own share has been taken out.

Documents scored under ``threshold`` are rejected. A document without words brings no evidence
and gets the odds of its path. NULL hosts and paths form a site of their own. Without labels of
both kinds there is no evidence at all: every score is 0.5 and nothing is rejected. Repeated
labels of a document are averaged; repeated documents are scored alike. Very long texts are
measured whole, and an empty table gives an empty one. Columns of the input
keep their names; ``host`` and ``path`` are given as expressions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwake.llm.common import staged, word_hashes

FIT_ROWS = 20_000
RIDGE = 1.0
ROUNDS = 30
WINDOW = 64
# Bytes by kind: 0 white space, 1 lower, 2 upper, 3 digit, 4 other ASCII, 5 beyond ASCII, 6 bar.
KIND = np.full(256, 4, dtype=np.uint8)
KIND[[0x20, *range(0x09, 0x0E)]] = 0
KIND[97:123], KIND[65:91], KIND[48:58], KIND[128:], KIND[124] = 1, 2, 3, 5, 6


def features(text: str | None) -> list[float]:
    """Shares of character kinds and of repetition; all 0 for a text without words."""
    words = word_hashes(text)
    n = len(words)
    if not n:
        return [0.0] * N_FEATURES
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    kinds = np.bincount(KIND[data], minlength=7).astype(float)
    seen = kinds[1:].sum()
    letters = max(1.0, kinds[1] + kinds[2] + kinds[5])
    marks = KIND[data] == 4
    doubled = np.count_nonzero(marks[1:] & marks[:-1])
    # Distinct words in windows of fixed length: their share does not fall with the text.
    whole = words[:n - n % WINDOW].reshape(-1, WINDOW)
    distinct = sum(_distinct(part) for part in (whole, words[n - n % WINDOW:].reshape(1, -1)))
    return [
        kinds[2] / letters, kinds[3] / seen, kinds[4] / seen, kinds[6] / seen, doubled / n,
        np.count_nonzero(words[1:] == words[:-1]) / n, distinct / n,
        len(np.unique(words)) / n, min(seen / n, 40.0), np.log1p(n), 1.0 if n < 20 else 0.0,
    ]


N_FEATURES = 11


def _distinct(blocks: np.ndarray) -> int:
    ordered = np.sort(blocks, axis=1)
    return len(ordered) * (ordered.shape[1] > 0) + np.count_nonzero(
        ordered[:, 1:] != ordered[:, :-1])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Classifier:
    """Logistic regression on standardised features; ``weights`` is None without training."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray | None
    prior: float

    @staticmethod
    def fit(x: np.ndarray, y: np.ndarray) -> Classifier:
        """``y`` lies between 0 and 1."""
        if not len(y) or y.min() == y.max():
            return Classifier(np.zeros(N_FEATURES), np.ones(N_FEATURES), None, 0.5)
        mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        z = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
        w = np.zeros(z.shape[1])
        ridge = RIDGE * np.eye(z.shape[1])
        ridge[-1, -1] = 0.0
        for _ in range(ROUNDS):
            p = _sigmoid(z @ w)
            step = np.linalg.solve((z * (p * (1 - p) + 1e-6)[:, None]).T @ z + ridge,
                                   z.T @ (y - p) - ridge @ w)
            w = w + step
            if np.abs(step).max() < 1e-8:
                break
        return Classifier(mean, scale, w, float(y.mean()))

    def evidence(self, text: str | None) -> float:
        """Log odds of the text alone, without the prior of the training rows."""
        found = features(text)
        if self.weights is None or not any(found):
            return 0.0
        z = np.append((np.array(found) - self.mean) / self.scale, 1.0)
        prior = np.log(self.prior / (1 - self.prior))
        return float(np.clip(z @ self.weights - prior, -30, 30))


def label_means(labels: DataFrame, label: str) -> DataFrame:
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    return usable.groupBy("doc_id").agg(F.avg(F.col(label).cast("double")).alias("_label"))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality") -> Classifier:
    """Classifier from at most ``FIT_ROWS`` labelled documents; only features reach the driver."""
    chosen = label_means(labels, label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_ROWS)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"x": [features(t) for t in batch["text"]], "y": batch["_label"]})

    # The limit above bounds what is broadcast.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select(
        "text", "_label").mapInPandas(measure, "x array<double>, y double").toPandas()
    x = np.array(rows["x"].tolist(), dtype=float).reshape(-1, N_FEATURES)
    return Classifier.fit(x, rows["y"].to_numpy(dtype=float))


def evidence_udf(docs: DataFrame, model: Classifier):
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def evidence(text: pd.Series) -> pd.Series:
        return pd.Series([shared.value.evidence(t) for t in text], dtype="float64")

    return evidence


def logit(p: Column) -> Column:
    inside = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(inside / (1 - inside))


def odds_to_share(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def _strength(sites: DataFrame, towards: Column) -> float:
    """Prior strength from the spread of site means around ``towards`` (method of moments)."""
    noise = towards * (1 - towards)
    found = sites.agg(
        F.sum((F.col("total") / F.col("n") - towards) ** 2 * F.col("n")).alias("spread"),
        F.sum(noise).alias("expected"), F.sum(noise * F.col("n")).alias("noise"),
        F.sum("n").alias("n")).first()
    if not found.n:
        return 1.0
    between = max((found.spread - found.expected) / found.n, 1e-6)
    return float(min(max(found.noise / found.n / between, 1.0), 1e4))


def site_table(scores: DataFrame) -> DataFrame:
    """One row for each path with the sums and priors a document's score needs.

    ``scores`` has ``_host, _path, _p`` for each document. NULL sites are kept as such. Only
    the global mean and the two prior strengths come to the driver.
    """
    paths = staged(scores.groupBy("_host", "_path").agg(
        F.sum("_p").alias("total"), F.count(F.lit(1)).alias("n")), "paths")
    hosts = staged(paths.groupBy("_host").agg(
        F.sum("total").alias("total"), F.sum("n").alias("n")), "hosts")
    world = hosts.agg(F.sum("total") / F.sum("n")).first()[0] or 0.5
    pull = _strength(hosts, F.lit(world))
    shrunk = hosts.select(
        F.col("_host").alias("_of"),
        ((F.col("total") + pull * world) / (F.col("n") + pull)).alias("host_posterior"))
    nested = staged(paths.join(shrunk, F.col("_host").eqNullSafe(F.col("_of"))), "nested")
    inner = _strength(nested, F.col("host_posterior"))
    return nested.select(
        F.col("_host").alias("_site_host"), F.col("_path").alias("_site_path"),
        F.col("total").alias("_total"), F.col("n").alias("_n"),
        F.col("host_posterior").alias("_host_posterior"), F.lit(inner).alias("_strength"))


def _with_score(rows: DataFrame, sites: DataFrame) -> DataFrame:
    """Add the score; ``rows`` has ``_host, _path, _evidence, _p``."""
    joined = rows.join(
        sites, F.col("_host").eqNullSafe(F.col("_site_host"))
        & F.col("_path").eqNullSafe(F.col("_site_path")))
    others = (F.col("_total") - F.col("_p")
              + F.col("_strength") * F.col("_host_posterior")) / (
        F.col("_n") - 1 + F.col("_strength"))
    return joined.withColumn("_path_posterior", others).withColumn(
        "_score", odds_to_share(F.col("_evidence") + logit(others)))


def judge(docs: DataFrame, labels: DataFrame, host: Column, path: Column,
          label: str = "quality") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Evidence of every document, as lazy full rows and staged light ones, and all sites."""
    model = fit(docs, labels, label)
    evidence = evidence_udf(docs, model)
    world = float(np.log(model.prior / (1 - model.prior)))

    def weighed(*columns: Column | str) -> DataFrame:
        found = docs.select(*columns, host.alias("_host"), path.alias("_path"),
                            evidence("text").alias("_evidence"))
        return found.withColumn("_p", odds_to_share(F.col("_evidence") + world))

    rows = staged(weighed("doc_id"), "evidence")
    whole = weighed(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_d"))
    return whole, rows, staged(site_table(rows), "sites")


def table(docs: DataFrame, labels: DataFrame, host: Column, path: Column,
          threshold: float = 0.5) -> DataFrame:
    """Evidence, site posteriors, score and decision for every document."""
    _, rows, sites = judge(docs, labels, host, path)
    return _with_score(rows, sites).select(
        "doc_id", F.col("_host").alias("host"), F.col("_path").alias("path"),
        F.col("_evidence").alias("evidence"), F.col("_host_posterior").alias("host_posterior"),
        F.col("_path_posterior").alias("path_posterior"), F.col("_score").alias("score"),
        (F.col("_score") >= threshold).alias("keep"))


def keep_good(docs: DataFrame, labels: DataFrame, host: Column, path: Column,
              threshold: float = 0.5) -> DataFrame:
    """The documents that are not rejected, with the columns they came with.

    The evidence is computed again next to the full rows, which are joined with one row for
    each site: cheaper than moving every text to its score.
    """
    whole, _, sites = judge(docs, labels, host, path)
    return _with_score(whole, sites).filter(F.col("_score") >= threshold).select("_d.*")
