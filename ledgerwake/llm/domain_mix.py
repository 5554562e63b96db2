"""Mixing to target weights with soft domain membership.

1. A naive Bayes classifier over hashed words learns the domains of a labelled table (at most
   ``FIT_ROWS`` labelled documents, taken in the order of a hash of their id).
2. Every document is read in runs of ``RUN`` words. The posterior of each run, weighted by its
   ids in a vocabulary (by its words where callers name no vocabulary), gives the tokens the
   document is expected to hold of each domain, so a text that changes its language halfway
   belongs to two domains.
3. Projected gradient descent finds a rate for each document, no smaller than ``least``, so
   that the expected token totals of the domains match their targets in the sense of weighted
   least squares, with a small pull towards rate 1. A task replays the few steps so far on its
   documents, hence a step moves one number for each domain, and the length of the last step, to
   the driver and nothing else. It ends when the targets are met, or when rates stand still
   because bounds keep them from meeting the targets; otherwise it raises an error.

The ids are those of ``token_files`` without the end id, which belongs to no domain. Blank texts
hold the domains' shares of the labelled words.

A rate says how often a document is to be seen: the integer part always, the rest by a hash of
its id. NULL and empty texts hold no tokens; their rate is 1. Targets for domains nobody was
labelled with cannot be met and stay as a residual; targets are normalised to sum to 1. Without
labelled documents all rates are 1. Repeated rows get equal rates. Very long texts are read whole,
and an empty table gives an empty one. Other columns are carried through by :func:`mixed_corpus`.

Callers say what a domain is: the queries of this package take the language of a document that
was labelled as good.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwake.llm.common import staged, whole_rows, with_row, word_bounds, word_hashes
from ledgerwake.llm.token_files import id_counter

FIT_ROWS = 20_000
BUCKETS = 1 << 16
RUN = 64
SMOOTHING = 0.1
PULL = 1e-4
TOLERANCE = 1e-3
# Tokens by which rates move in a step, as a share of all, when they stand still.
SETTLED = 1e-4
# Room above the least budget that covers all domains: without it the fullest domain would have to
# stand still exactly, which takes hundreds of steps where documents belong to several.
SLACK = 1.02
STEPS = 500


def slots_of(text: str | None) -> np.ndarray:
    return (word_hashes(text, lower=True) >> np.uint64(48)).astype(np.int64)


def run_ids(text: str, vocabulary: tuple) -> np.ndarray:
    """Ids of every run of ``RUN`` words; a blank text is one run.

    Runs are cut in front of the last space before a word. The vocabulary cuts there too, unless
    the word begins with a wider space; the runs are then scaled to the ids of the whole text.
    """
    ids = id_counter(*vocabulary)
    data = text.encode("utf-8", "surrogatepass")
    starts, _ = word_bounds(np.frombuffer(data, dtype=np.uint8))
    cuts = [0, *(starts[RUN::RUN] - 1).tolist(), len(data)]
    runs = [data[a:b].decode("utf-8", "surrogatepass")
            for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    counts = np.array([ids(run) for run in runs], dtype=float)
    if any(run[1].isspace() for run in runs[1:]):
        counts *= ids(text) / counts.sum()
    return counts


def learn(docs: DataFrame, labelled: DataFrame) -> DataFrame:
    """Word counts for each domain and bucket, from ``labelled(doc_id, domain)``."""
    usable = labelled.filter(F.col("doc_id").isNotNull() & F.col("domain").isNotNull())
    chosen = usable.groupBy("doc_id").agg(F.min("domain").alias("domain")).orderBy(
        F.xxhash64("doc_id"), "doc_id").limit(FIT_ROWS)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, domain in zip(batch["text"], batch["domain"], strict=True):
                found = totals.setdefault(domain, np.zeros(BUCKETS, dtype=np.int64))
                found += np.bincount(slots_of(text), minlength=BUCKETS)
        for domain, total in totals.items():
            slots = np.flatnonzero(total)
            yield pd.DataFrame({"domain": domain, "slot": slots, "n": total[slots]})

    # The limit above bounds what is broadcast.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return rows.select("text", "domain").mapInPandas(
        count, "domain string, slot bigint, n bigint").groupBy("domain", "slot").agg(
        F.sum("n").alias("n"))


class Domains:
    """Domain names and the classifier's log probabilities (buckets x domains)."""

    def __init__(self, counts: pd.DataFrame, names: list[str]) -> None:
        self.names = names
        place = {name: i for i, name in enumerate(names)}
        known = counts[counts["domain"].isin(place)]
        table = np.zeros((BUCKETS, len(names)))
        table[known["slot"].to_numpy(), known["domain"].map(place).to_numpy(dtype=int)] = known["n"]
        total = table.sum(axis=0)
        logs = np.log((table + SMOOTHING) / (total + SMOOTHING * BUCKETS))
        share = np.full(len(names), -np.inf)
        share[total > 0] = np.log(total[total > 0] / total.sum())
        self.logs, self.share, self.trained = logs.astype(np.float32), share, bool(total.sum())

    def tokens(self, text: str | None, vocabulary: tuple | None = None) -> np.ndarray:
        """Expected tokens of a text for each domain; they add up to its ids (or words)."""
        slots = slots_of(text)
        if not (text if vocabulary else len(slots)) or not self.trained:
            return np.zeros(len(self.names))
        starts = np.arange(0, len(slots), RUN)
        logs = self.share[None]
        if len(slots):
            logs = logs + np.add.reduceat(self.logs[slots].astype(np.float64), starts, axis=0)
        posterior = np.exp(logs - logs.max(axis=1, keepdims=True))
        posterior /= posterior.sum(axis=1, keepdims=True)
        lengths = (run_ids(text, vocabulary) if vocabulary
                   else np.diff(np.append(starts, len(slots))))
        return lengths @ posterior


def memberships(docs: DataFrame, domains: Domains,
                vocabulary: tuple | None = None) -> DataFrame:
    """``row, doc_id, n_tokens`` and expected ``tokens`` for each domain of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(domains)

    @F.arrow_udf("array<double>")
    def tokens(text: pa.Array) -> pa.Array:
        # One text at a time is a Python object: a batch may hold very long ones.
        found = [shared.value.tokens(t.as_py(), vocabulary) for t in text]
        return pa.array(found, pa.list_(pa.float64()))

    found = docs.select("row", "doc_id", tokens("text").alias("tokens"))
    return found.withColumn("n_tokens", F.aggregate("tokens", F.lit(0.0), lambda a, x: a + x))


class Plan:
    """The steps so far. Rates follow from them and a document's posterior alone.

    Steps are accelerated: a gradient is taken a little beyond the rates, in the direction of the
    last step, and after a step that led away from the targets at the rates themselves.
    """

    def __init__(self, shares: np.ndarray, goal: np.ndarray, least: float) -> None:
        self.scale = np.maximum(shares, 1e-9)
        self.goal, self.least = goal, least
        self.steps: list[tuple[np.ndarray, float]] = []
        self.residual = 0.0  # largest share by which a reachable domain is off its goal
        self.inertia, self.distance = 1.0, np.inf

    def rates(self, posterior: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rates after the steps so far, where the next gradient is taken, and how far the last
        step went."""
        rate = beyond = np.ones(len(posterior))
        moved = np.full(len(posterior), np.inf)
        size = 1.0 / (1.0 + PULL)
        for gradient, momentum in self.steps:
            before = rate
            rate = np.maximum(
                beyond - size * (posterior @ gradient + PULL * (beyond - 1.0)), self.least)
            beyond = rate + momentum * (rate - before)
            moved = np.abs(rate - before)
        return rate, beyond, moved

    def advance(self, now: np.ndarray, beyond: np.ndarray, reachable: np.ndarray) -> None:
        """Add a step, given the shares of all tokens at the rates and beyond them."""
        off = np.where(reachable, now - self.goal, 0.0)
        distance = float((off * off / self.scale).sum())
        if distance > self.distance:
            self.inertia = 1.0
        self.distance = distance
        inertia = (1.0 + np.sqrt(1.0 + 4.0 * self.inertia ** 2)) / 2.0
        momentum, self.inertia = (self.inertia - 1.0) / inertia, inertia
        gradient = np.where(reachable, beyond - self.goal, 0.0) / self.scale
        self.steps.append((gradient, momentum))


def _matrix(tokens: pd.Series, width: int) -> np.ndarray:
    return np.array(tokens.tolist(), dtype=float).reshape(-1, width)


def _posterior(tokens: np.ndarray) -> np.ndarray:
    return tokens / np.maximum(tokens.sum(axis=1, keepdims=True), 1e-300)


def totals(members: DataFrame, plan: Plan,
           width: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Expected tokens of each domain at the present rates and beyond them, and the tokens by
    which the last step moved."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = np.zeros(2 * width + 1)
        for batch in batches:
            tokens = _matrix(batch["tokens"], width)
            rate, beyond, moved = plan.rates(_posterior(tokens))
            held = tokens.sum(axis=1)
            found[:width] += rate @ tokens
            found[width:-1] += beyond @ tokens
            found[-1] += moved[held > 0] @ held[held > 0]
        yield pd.DataFrame({"domain": np.arange(len(found)), "total": found})

    rows = members.select("tokens").mapInPandas(partial, "domain int, total double").groupBy(
        "domain").agg(F.sum("total").alias("total")).collect()  # one row for each domain
    out = np.zeros(2 * width + 1)
    for row in rows:
        out[row.domain] = row.total
    return out[:width], out[width:-1], float(out[-1])


def solve(members: DataFrame, weights: np.ndarray, least: float = 0.0,
          cover: bool = False) -> Plan:
    """Rates as a plan. ``cover`` raises the budget until no domain has to shrink."""
    width = len(weights)
    plan = Plan(np.ones(width), weights, least)
    have, *_ = totals(members, plan, width)
    total = max(have.sum(), 1e-300)
    shares = have / total
    grow = 1.0
    if cover and (weights > 0).any():
        grow = max(1.0, SLACK * float(np.max(shares[weights > 0] / weights[weights > 0])))
    plan = Plan(shares, weights * grow, least)
    if not have.sum():
        return plan
    now = beyond = shares
    reachable, near, moved = shares > 0, TOLERANCE * grow * weights.max(), np.inf
    while True:
        plan.residual = np.abs(now - plan.goal)[reachable].max()
        if plan.residual <= near or moved <= SETTLED:
            return plan
        if len(plan.steps) == STEPS:
            raise RuntimeError(f"mixing has not settled after {STEPS} steps; a domain is off its "
                               f"target by {plan.residual:.4f} of all tokens")
        plan.advance(now, beyond, reachable)
        now, beyond, moved = (x / total for x in totals(members, plan, width))


def with_rates(members: DataFrame, plan: Plan, width: int) -> DataFrame:

    @F.pandas_udf("double")
    def rate(tokens: pd.Series) -> pd.Series:
        held = _matrix(tokens, width)
        return pd.Series(np.where(held.sum(axis=1) > 0, plan.rates(_posterior(held))[0], 1.0))

    rated = members.withColumn("rate", rate("tokens"))
    luck = F.pmod(F.xxhash64(F.lit("mix"), "doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    whole = F.floor("rate")
    return rated.withColumn(
        "copies", (whole + F.when(luck < F.col("rate") - whole, 1).otherwise(0)).cast("int"))


def rates(docs: DataFrame, labelled: DataFrame, targets: Mapping[str, float],
          least: float = 0.0, cover: bool = False,
          vocabulary: tuple | None = None) -> tuple[DataFrame, list[str]]:
    """Rates of all documents (``docs`` has ``row, doc_id, text``) and the domain names."""
    names = sorted(targets)
    weights = np.array([max(0.0, targets[name]) for name in names])
    weights = weights / max(weights.sum(), 1e-300)
    domains = Domains(learn(docs, labelled).toPandas(), names)
    members = staged(memberships(docs, domains, vocabulary), "memberships")
    plan = solve(members, weights, least, cover)
    return with_rates(members, plan, len(names)), names


def table(docs: DataFrame, labelled: DataFrame, targets: Mapping[str, float],
          **options) -> DataFrame:
    """Rate, copies and expected domain shares for every document."""
    rated, names = rates(with_row(docs, "doc_id", "text"), labelled, targets, **options)
    share = [(F.get("tokens", F.lit(i)) / F.greatest("n_tokens", F.lit(1.0))).alias(f"share_{n}")
             for i, n in enumerate(names)]
    return rated.select("doc_id", F.round("n_tokens").cast("bigint").alias("n_tokens"), *share,
                        "rate", "copies")


def mixed_corpus(docs: DataFrame, labelled: DataFrame, targets: Mapping[str, float],
                 written: bool = False, **options) -> DataFrame:
    """The documents themselves, each as often as its copies say."""
    keyed = whole_rows(docs, "mix-input", written)
    rated, _ = rates(keyed, labelled, targets, **options)
    copies = rated.filter("copies > 0").select("row", "copies")
    return keyed.join(copies, "row").select(
        "_d", F.explode(F.sequence(F.lit(1), "copies"))).select("_d.*")
