"""Substring dedup, Jaccard join, sketches, mixing, packing and quality, against brute force."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from ledgerwake.llm import (
    bin_packing,
    domain_mix,
    jaccard_join,
    queries,
    site_quality,
    sketches,
    substring_dedup,
)
from ledgerwake.llm.components import components
from ledgerwake.llm.fm_index import FmIndex
from tests.llm import cases

LABELS = f"{cases.SF_DIR}/labels.parquet"


# --- substring dedup -----------------------------------------------------------------------

@pytest.mark.parametrize("seed", range(4))
def test_fm_index_counts_windows(seed):
    draw = random.Random(seed)
    texts = [[draw.randrange(3 + seed * 40) for _ in range(draw.randrange(60))] for _ in range(30)]
    weights = np.array([draw.randrange(1, 4) for _ in texts])
    window = 5
    index = FmIndex([np.array(t, dtype=np.uint64) for t in texts], weights, window)
    want = Counter()
    for text, weight in zip(texts, weights, strict=True):
        for i in range(len(text) - window + 1):
            want[tuple(text[i:i + window])] += int(weight)
    queries = texts + [[draw.randrange(3 + seed * 40) for _ in range(40)] for _ in range(10)]
    got = index.occurrences([np.array(q, dtype=np.uint64) for q in queries])
    for q, found in zip(queries, got, strict=True):
        assert found.tolist() == [want[tuple(q[i:i + window])]
                                  for i in range(max(0, len(q) - window + 1))]


def test_fm_index_of_nothing():
    assert FmIndex([], np.zeros(0), 5).occurrences([np.zeros(9, np.uint64)])[0].tolist() == [0] * 5


def trimmed(rows, window):
    texts = [(i, cases.words_of(t)) for i, t in rows]
    seen = Counter(tuple(w[j:j + window]) for _, w in texts for j in range(len(w) - window + 1))
    out = []
    for i, w in texts:
        gone = set()
        for j in range(len(w) - window + 1):
            if seen[tuple(w[j:j + window])] > 1:
                gone.update(range(j, j + window))
        kept = [x for j, x in enumerate(w) if j not in gone]
        out.append((i, len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return cases.bag(out)


@pytest.mark.parametrize("window", [35, 6])
def test_substring_dedup(corpus, window):
    got = substring_dedup.table(corpus, window)
    want = trimmed(cases.pairs(corpus), window)
    assert cases.bag(r[:4] for r in got.collect()) == want
    assert sum(r[2] for r in want) > 500


def test_hot_runs_go_to_no_shard(spark, monkeypatch, tmp_path):
    """A line and a passage in all documents, with other neighbours in each."""
    draw = random.Random(8)
    some = lambda n: [f"n{draw.randrange(10 ** 9)}" for _ in range(n)]
    line, passage = some(25), some(60)
    rows = [(i, " ".join([*some(30), *line, *some(30), *passage, *some(i % 40)]))
            for i in range(60)]
    path = str(tmp_path / "hot")
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(path)
    judged, most = substring_dedup.judged, []

    def seen(shards, window):
        most.append(shards.groupBy("run").count().agg(F.max("count")).first()[0] or 0)
        return judged(shards, window)

    monkeypatch.setattr(substring_dedup, "judged", seen)
    got = substring_dedup.table(spark.read.parquet(path), hot=10).collect()
    assert cases.bag(r[:4] for r in got) == trimmed(rows, 35)
    assert most[0] <= 10 and sum(r.n_removed for r in got) >= 60 * 60


def test_substring_dedup_of_nothing(empty):
    assert substring_dedup.table(empty).count() == 0


# --- Jaccard join --------------------------------------------------------------------------

def shingles(text, width):
    words = cases.words_of((text or "").translate(
        {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}))
    if not words:
        return frozenset()
    width = min(width, len(words))
    return frozenset(tuple(words[i:i + width]) for i in range(len(words) - width + 1))


def expected_join(rows, rule):
    sets = [shingles(t, rule.width) for _, t in rows]
    part = list(range(len(rows)))

    def root(i):
        while part[i] != i:
            i = part[i]
        return i

    holders = defaultdict(list)
    for i, found in enumerate(sets):
        for j, common in Counter(k for s in found for k in holders[s]).items():
            if 100 * common >= rule.percent * (len(found) + len(sets[j]) - common):
                part[max(root(i), root(j))] = min(root(i), root(j))
        for s in found:
            holders[s].append(i)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[root(i)].append(rows[i][0])
    names = {r: min([x for x in ids if x is not None], default=None) for r, ids in groups.items()}
    return cases.bag((rows[i][0], len(sets[i]), names[root(i)], len(groups[root(i)]))
                     for i in range(len(rows)))


@pytest.mark.parametrize("width, percent", [(3, 90), (5, 80)])
def test_jaccard_join(corpus, width, percent):
    rule = jaccard_join.Rule(width, percent)
    got = jaccard_join.table(corpus, rule).collect()
    want = expected_join(cases.pairs(corpus), rule)
    assert cases.bag(got) == want
    kept = jaccard_join.representatives(corpus, rule)
    assert kept.schema == corpus.schema
    empty = sum(r[1] == 0 for r in want)
    assert kept.count() == len({(r[2], r[3]) for r in want if r[1]}) + empty


def test_long_lists_blocks_and_broken_edges(spark, monkeypatch, tmp_path):
    """Many near copies of near-threshold likeness, scanned in small blocks and long runs."""
    monkeypatch.setattr(jaccard_join, "BLOCK", 40)
    monkeypatch.setattr(jaccard_join, "SHORT_RUN", 4)
    draw = random.Random(3)
    base = [f"v{draw.randrange(9999)}" for _ in range(150)]
    rows = []
    for i in range(160):
        words = list(base)
        for _ in range(draw.choice([1, 2, 3, 4])):
            words[draw.randrange(150)] = f"e{i}.{draw.randrange(99)}"
        rows.append((i, " ".join(words)))
    path = str(tmp_path / "near")
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(path)
    rule = jaccard_join.Rule()
    got = jaccard_join.table(spark.read.parquet(path), rule).collect()
    assert cases.bag(got) == expected_join(rows, rule)


def test_join_of_nothing(empty):
    assert jaccard_join.table(empty).count() == 0


def test_boundary_follows_the_sizes():
    rule = jaccard_join.Rule()
    assert jaccard_join.boundary({}, rule) == jaccard_join.MOST_SUBSETS
    assert jaccard_join.boundary({5: 100, 29: 1000}, rule) == 28
    assert 9 <= jaccard_join.boundary({n: 100 for n in range(1, 30)}, rule) < 29


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, j) for j in range(101, 160)] + [(7, 7)]
    got = {r.node: r.component for r in components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 160), 100)}


# --- sketches ------------------------------------------------------------------------------

def test_sketches(spark, corpus):
    got = sketches.table(corpus)
    rows = sorted(cases.pairs(corpus), key=lambda r: (r[0] is not None, r[0] or 0))
    assert got.count() == len(rows)
    single = [r[0] for r in rows if sum(r[0] == x[0] for x in rows) == 1]
    found = {r.doc_id: r for r in got.collect()}
    for k, (i, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)]
        if i not in single or following[0] not in single:
            continue
        text, other = text or "", following[1] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + other[:half]
        row = found[i]
        assert (row.n_chars, row.edited_sha256) == (
            len(text), hashlib.sha256(edited.encode()).hexdigest())
        for near, (a, b) in ((row.near_edited, (text, edited)), (row.near_next, (text, other))):
            a, b = case_kept(a), case_kept(b)
            true = len(a & b) / len(a | b) if a | b else 1.0
            # Three standard deviations of a sample of K.
            assert abs(near - true) <= 3 * (true * (1 - true) / sketches.K) ** 0.5 + 1e-9
        if len(case_kept(text)) < sketches.K:
            assert row.n_shingles == len(case_kept(text))
    same = [found[i].fingerprint for i in (10_007, 10_008)]
    assert same[0] == same[1]


def case_kept(text):
    words = cases.words_of(text)
    width = min(5, len(words))
    return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)} if words else set()


def test_sketch_functions_are_native_and_mergeable(spark):
    a, b = " ".join(f"a{i}" for i in range(300)), " ".join(f"a{i}" for i in range(150, 450))
    df = spark.createDataFrame([(a, b, a + " " + b)], "a string, b string, ab string").select(
        *[F.col(c).alias(c) for c in "ab"], "ab").select(
        *[sketches.sketch(sketches.words(F.col(c))).alias(c) for c in ("a", "b", "ab")])
    row = df.select(
        sketches.resemblance(F.col("a"), F.col("b")).alias("r"),
        sketches.containment(F.col("a"), F.col("b")).alias("c"),
        sketches.distinct_shingles(sketches.merged(F.col("a"), F.col("b"))).alias("n"),
        sketches.resemblance(sketches.merged(F.col("a"), F.col("b")), F.col("ab")).alias("m"),
    ).first()
    assert abs(row.r - 1 / 3) < 0.15 and abs(row.c - 0.5) < 0.2 and abs(row.n - 446) < 120
    assert row.m > 0.95


def test_next_documents_whatever_the_ids(spark):
    """An id far from all others, a hot id, NULLs, and ids beyond the reach of doubles."""
    ids = [*range(0, 900, 3), 10**15, *[77] * 150, None, None, 2**53 + 1, 2**53, -5]
    docs = spark.createDataFrame([(i, f"text {n} of {i}") for n, i in enumerate(ids)],
                                 "doc_id long, text string")
    got = sketches.with_next(docs, lambda df: df, ranges=40).collect()
    tie = {r.text: r.tie for r in docs.selectExpr("text", "xxhash64(text) AS tie").collect()}
    order = sorted(((i is not None, i or 0, tie[t]), t) for i, t in cases.pairs(docs))
    want = {t: after for (_, t), (_, after) in zip(order, order[1:] + order[:1], strict=True)}
    assert {r.text: r.next_text for r in got} == want and len(got) == len(ids)
    buckets = Counter(r.bucket for r in got)
    assert max(buckets.values()) < len(ids) / 4


def test_sketches_of_nothing_and_of_one(spark, empty):
    assert sketches.table(empty).count() == 0
    one = sketches.table(spark.createDataFrame([(5, "abcd")], "doc_id long, text string")).first()
    assert one.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and one.near_next == 1.0


# --- mixing --------------------------------------------------------------------------------

def labelled(corpus):
    return corpus.filter("doc_id < 150").select("doc_id", F.col("lang").alias("domain"))


def test_rates_meet_the_targets(corpus):
    targets = {"de": 0.2, "en": 0.4, "es": 0.2, "fr": 0.2}
    got = domain_mix.table(corpus, labelled(corpus), targets).collect()
    assert len(got) == corpus.count()
    mass = {d: sum(r.rate * r.n_tokens * r[f"share_{d}"] for r in got) for d in targets}
    for d, want in targets.items():
        assert mass[d] / sum(mass.values()) == pytest.approx(want, abs=0.01)
    assert all(r.rate >= 0 and r.copies in (int(r.rate), int(r.rate) + 1) for r in got)
    assert {r.rate for r in got if r.n_tokens == 0} == {1.0}
    sizes = {i: len(cases.words_of(t)) for i, t in cases.pairs(corpus)}
    assert all(sizes[r.doc_id] == r.n_tokens for r in got if r.doc_id and r.doc_id < 10_000)


def test_mix_weighs_ids_of_a_vocabulary(spark, corpus):
    """Lengths are ids, run by run, and the targets are met in ids."""
    coder = Tokenizer.from_file(queries.VOCABULARY)
    size = lambda t: len(coder.encode(t or "", add_special_tokens=False).ids)
    for text in ("a<|endoftext|>b " * 99, " \t\n", "a \u00a0" * 200, "x\n\n y  " * 150, "one two " * 99, "日本 語 " * 70):
        runs = domain_mix.run_ids(text, queries.RANKS)
        assert runs.sum() == pytest.approx(size(text))
        assert len(runs) == max(1, -(-len(cases.words_of(text)) // domain_mix.RUN))
    rows = queries.QUERIES["op3_domain_mix"](spark, cases.SF_DIR).collect()
    texts = cases.pairs(spark.read.parquet(f"{cases.SF_DIR}/documents.parquet"))
    assert Counter((r.doc_id, r.n_tokens) for r in rows) == Counter(
        (i, size(t)) for i, t in texts)
    mass = {d: sum(r.rate * r.n_tokens * r[f"share_{d}"] for r in rows) for d in queries.TARGETS}
    for d, want in queries.TARGETS.items():
        assert mass[d] / sum(mass.values()) == pytest.approx(want, abs=0.01)
    blank = domain_mix.Domains(pd.DataFrame({"domain": ["a", "b"], "slot": [1, 2], "n": [3, 1]}),
                               ["a", "b"]).tokens(" \t\n", queries.RANKS)
    assert blank.tolist() == pytest.approx([0.75 * size(" \t\n"), 0.25 * size(" \t\n")])


def test_rates_are_those_of_a_solver_on_one_machine(spark, corpus, tmp_path):
    """Same tokens, many more gradient steps, all documents at hand."""
    draw = np.random.default_rng(3)
    tokens = draw.dirichlet([0.4] * 3, 400) * draw.integers(1, 900, (400, 1))
    path = str(tmp_path / "members")
    spark.createDataFrame([(t.tolist(),) for t in tokens], "tokens array<double>").write.parquet(path)
    members = spark.read.parquet(path)
    held = tokens.sum(axis=1, keepdims=True)
    shares = tokens.sum(axis=0) / held.sum()
    for goal, least, cover in (([0.2, 0.3, 0.5], 0.0, False), ([0.4, 0.3, 0.3], 1.0, True),
                               ([0.7, 0.2, 0.1], 0.0, False)):
        goal = np.array(goal)
        plan = domain_mix.solve(members, goal, least, cover)
        assert len(plan.steps) <= 80
        grown = plan.goal.sum()
        assert (grown == pytest.approx(1.0)) if not cover else grown >= max(1, max(shares / goal))
        posterior, rate = tokens / held, np.ones(400)
        for _ in range(5000):
            off = ((rate @ tokens) / held.sum() - plan.goal) / shares
            rate = np.maximum(rate - (posterior @ off + 1e-4 * (rate - 1)) / (1 + 1e-4), least)
        mine, *_ = plan.rates(posterior)
        assert mine.min() >= least
        assert np.abs(mine @ tokens / held.sum() - plan.goal).max() < 2e-3
        assert np.abs(mine - rate) @ held[:, 0] / held.sum() < 0.05


def test_covering_mix_drops_nothing(corpus):
    targets = {"de": 0.25, "en": 0.25, "es": 0.25, "fr": 0.25, "xx": 0.0}
    mixed = domain_mix.mixed_corpus(corpus, labelled(corpus), targets, least=1.0, cover=True)
    assert mixed.schema == corpus.schema
    before, after = Counter(map(str, corpus.collect())), Counter(map(str, mixed.collect()))
    assert all(after[r] >= n for r, n in before.items()) and after.keys() == before.keys()
    assert after.total() > before.total()


def test_mix_of_nothing_and_of_unknown_domains(corpus, empty):
    assert domain_mix.table(empty, labelled(corpus), {"en": 1.0}).count() == 0
    free = domain_mix.table(corpus, labelled(empty), {"en": 1.0})
    assert {(r.rate, r.copies) for r in free.collect()} == {(1.0, 1)}


def test_caps_are_told(spark, monkeypatch):
    monkeypatch.setattr("ledgerwake.llm.components.ROUNDS", 1)
    with pytest.raises(RuntimeError):
        components(spark.createDataFrame([(i, i + 1) for i in range(9)], "a long, b long"))
    monkeypatch.setattr(domain_mix, "STEPS", 1)
    members = spark.createDataFrame([([9.0, 1.0],), ([2.0, 8.0],)], "tokens array<double>")
    with pytest.raises(RuntimeError, match="off its target by"):
        domain_mix.solve(members, np.array([0.1, 0.9]))


# --- packing -------------------------------------------------------------------------------

def naive(pieces, capacity):
    """Best fit by looking at every bin."""
    bins, out = [], []
    for size, marks in pieces:
        fits = [b for b in bins if b[0] >= size and not b[1] & marks]
        best = min(fits, key=lambda b: b[0], default=None)
        if best is None:
            best = [capacity, set(), len(bins)]
            bins.append(best)
        best[0] -= size
        best[1] |= marks
        out.append(best[0])
    return out, len(bins)


@pytest.mark.parametrize("seed", range(5))
def test_successor_search_finds_the_tightest_compatible_bin(seed):
    draw = random.Random(seed)
    sizes = [draw.randrange(1, 60) for _ in range(300)]
    marks = [{draw.randrange(6), 10 + draw.randrange(40)} for _ in sizes]
    bins = bin_packing.Bins(64)
    rooms = []
    for size, mark in zip(sizes, marks, strict=True):
        found = bins.place(size, sum(1 << m for m in mark))
        rooms.append(64 - bins.used[found])
    # Among equal rooms either may be taken; the room left is the same.
    want, n = naive(list(zip(sizes, marks, strict=True)), 64)
    if seed == 0:
        assert rooms[:40] == want[:40]
    assert abs(len(bins.used) - n) <= 2 and max(bins.used) <= 64


@pytest.mark.parametrize("by_source", [True, False])
def test_packing(corpus, by_source):
    got = bin_packing.table(corpus, capacity=512, group_rows=60, by_source=by_source).collect()
    lengths = Counter()
    for i, t in cases.pairs(corpus):
        lengths[i] += len(cases.words_of(t)) + 1
    packed = Counter()
    bins = defaultdict(list)
    for r in got:
        packed[r.doc_id] += r.n_tokens
        bins[r.bin_id].append(r)
    assert packed == lengths
    for rows in bins.values():
        assert sum(r.n_tokens for r in rows) == rows[0].bin_tokens <= 512
        assert sorted(r.slot for r in rows) == list(range(len(rows)))
        assert len({r.cluster for r in rows}) == len(rows)
        if by_source:
            assert len({r.source for r in rows}) == len(rows)
    pieces = [r for r in got if r.doc_id == 10_006]
    assert sorted(r.text_start for r in pieces) == list(range(0, 30_001, 512))


def test_packing_by_ids_of_a_vocabulary(spark, corpus):
    """The pack stage and op6 count ids, also of a text without spaces."""
    odd = corpus.filter("doc_id >= 10000 or doc_id < 40 or doc_id is null").unionByName(
        spark.createDataFrame([(20_000, "日本語の" * 4000), (20_001, "Zq8/Lk2+" * 3000),
                               (20_002, "x <|endoftext|> y<|endoftext|>z")],
                              "doc_id long, text string"), allowMissingColumns=True)
    coder = Tokenizer.from_file(queries.VOCABULARY)
    lengths = Counter()
    for i, t in cases.pairs(odd):
        lengths[i] += len(coder.encode(t or "", add_special_tokens=False).ids) + 1
    got = corpus_pipeline.pack(spark, odd, cases.SF_DIR).collect()
    packed = Counter()
    for r in got:
        packed[r.doc_id] += r.n_tokens
    assert packed == lengths and max(r.bin_tokens for r in got) <= bin_packing.CAPACITY
    assert sum(r.doc_id == 20_000 for r in got) > 1
    sizes = Counter()
    for r in queries.QUERIES["op6_bin_packing"](spark, cases.SF_DIR).collect():
        sizes[r.doc_id] += r.n_tokens
    exact = Counter()
    for i, t in cases.pairs(spark.read.parquet(f"{cases.SF_DIR}/documents.parquet")):
        exact[i] += len(coder.encode(t or "", add_special_tokens=False).ids) + 1
    assert sizes == exact


def test_packing_of_nothing(empty):
    assert bin_packing.table(empty).count() == 0


# --- quality -------------------------------------------------------------------------------

def site():
    return {"host": F.col("source"), "path": F.col("lang")}


def test_quality_on_unseen_labels(spark, corpus):
    labels = spark.read.parquet(LABELS)
    unseen = labels.filter("doc_id % 3 = 0")
    got = site_quality.table(corpus, labels.filter("doc_id % 3 <> 0"), **site())
    assert got.count() == corpus.count()
    rows = {r.doc_id: r for r in got.collect()}
    truth = {r.doc_id: r.quality for r in unseen.collect()}
    right = [rows[i].keep == bool(q) for i, q in truth.items()]
    assert len(right) > 15 and np.mean(right) > 0.85
    for r in rows.values():
        assert 0 <= r.score <= 1 and 0 < r.path_posterior < 1 and r.keep == (r.score >= 0.5)
    assert rows[10_000].evidence == rows[10_002].evidence == 0.0


def test_good_documents_come_back_as_they_were(spark, corpus):
    labels = spark.read.parquet(LABELS)
    kept = site_quality.keep_good(corpus, labels, **site())
    assert kept.schema == corpus.schema
    table = site_quality.table(corpus, labels, **site())
    assert Counter(r.doc_id for r in kept.collect()) == Counter(
        r.doc_id for r in table.filter("keep").collect())


def test_sparse_sites_shrink(spark):
    rows = [("a", "a/x", 1.0)] * 50 + [("b", "b/x", 0.0)] * 50 + [("c", "c/x", 0.0)]
    sites = site_quality.site_table(spark.createDataFrame(
        rows, "_host string, _path string, _p double"))
    found = {r._site_host: r._host_posterior for r in sites.collect()}
    assert found["b"] < 0.05 < found["c"] < 0.5 < 0.95 < found["a"]


def test_quality_without_labels_or_documents(spark, corpus, empty):
    labels = spark.read.parquet(LABELS)
    got = site_quality.table(corpus, labels.limit(0), **site()).collect()
    assert {(r.evidence, r.keep) for r in got} == {(0.0, True)}
    assert site_quality.table(empty, labels, **site()).count() == 0
    assert site_quality.keep_good(empty, labels, **site()).count() == 0


def test_site_scores_by_hand(corpus):
    """Sums, strengths and scores from the evidence of each document, in plain Python."""
    labels = corpus.sparkSession.read.parquet(f"{cases.SF_DIR}/labels.parquet")
    rows = site_quality.table(corpus, labels, **site()).collect()
    model = site_quality.fit(corpus, labels)
    world = math.log(model.prior / (1 - model.prior))
    p = [1 / (1 + math.exp(-(r.evidence + world))) for r in rows]
    paths, hosts = defaultdict(list), defaultdict(list)
    for r, x in zip(rows, p, strict=True):
        paths[r.host, r.path].append(x)
        hosts[r.host].append(x)
    mean = sum(p) / len(p)

    def strength(sites):
        spread = sum((sum(x) / len(x) - m) ** 2 * len(x) for x, m in sites)
        expected = sum(m * (1 - m) for _, m in sites)
        n = sum(len(x) for x, _ in sites)
        noise = sum(m * (1 - m) * len(x) for x, m in sites)
        between = max((spread - expected) / n, 1e-6)
        return min(max(noise / n / between, 1.0), 1e4)

    pull = strength([(x, mean) for x in hosts.values()])
    shrunk = {h: (sum(x) + pull * mean) / (len(x) + pull) for h, x in hosts.items()}
    inner = strength([(x, shrunk[h]) for (h, _), x in paths.items()])
    for r, x in zip(rows, p, strict=True):
        own = paths[r.host, r.path]
        others = (sum(own) - x + inner * shrunk[r.host]) / (len(own) - 1 + inner)
        score = 1 / (1 + math.exp(-(r.evidence + math.log(others / (1 - others)))))
        assert r.host_posterior == pytest.approx(shrunk[r.host], rel=1e-6)
        assert r.path_posterior == pytest.approx(others, rel=1e-6)
        assert r.score == pytest.approx(score, rel=1e-6) and r.keep == (r.score >= 0.5)


def test_evidence_is_that_of_a_regression_by_gradient_descent():
    draw = np.random.default_rng(5)
    x = draw.normal(size=(300, site_quality.N_FEATURES))
    y = (x[:, 0] - x[:, 1] + draw.normal(size=300) > 0).astype(float)
    model = site_quality.Classifier.fit(x, y)
    z = np.column_stack([(x - model.mean) / model.scale, np.ones(300)])
    # At the fitted weights the gradient of the penalised likelihood vanishes.
    p = 1 / (1 + np.exp(-z @ model.weights))
    gradient = z.T @ (y - p)
    ridge = gradient[:-1] / model.weights[:-1]
    assert np.ptp(ridge) < 1e-3 * abs(ridge).max() and ridge.min() > 0
    assert abs(gradient[-1]) < 1e-4
