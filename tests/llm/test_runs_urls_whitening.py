"""Periodic runs, the URL filter and whitening, against plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest

from ledgerwake.llm import periodic_runs, queries, url_filter, whitening
from tests.llm import cases


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# --- periodic runs -------------------------------------------------------------------------

def longest_lyndon(words: list[int]) -> list[int]:
    n = len(words)
    return [max(j - i for j in range(i + 1, n + 1)
                if all(words[i:j] < words[k:j] for k in range(i + 1, j))) for i in range(n)]


def expected_runs(words: list, least: int, periods: int) -> list[tuple[int, int, int]]:
    """All maximal stretches by trying every period."""
    n, found = len(words), []
    for q in range(1, n // periods + 1):
        equal = [words[i] == words[i + q] for i in range(n - q)] + [False]
        start = None
        for i, same in enumerate(equal):
            if same and start is None:
                start = i
            if not same and start is not None:
                length = i - start + q
                whole = words[start:start + length]
                if length >= max(least, periods * q) and not any(
                        whole[p:] == whole[:-p] for p in range(1, q)):
                    found.append((start, length, q))
                start = None
    return sorted(found)


def sequences(draw: random.Random) -> list[list[int]]:
    every = []
    for _ in range(draw.randrange(1, 4)):
        words: list[int] = []
        for _ in range(draw.randrange(0, 6)):
            root = [draw.randrange(3) for _ in range(draw.randrange(1, 7))]
            words += (root * 9)[:draw.randrange(1, 40)]
        every.append(words)
    return every


def test_grouping_yields_the_lyndon_arrays_of_both_orders():
    draw = random.Random(1)
    for _ in range(400):
        every = [s[:18] for s in sequences(draw) if s] or [[0]]
        codes = np.array(sum(every, []))
        heads = np.cumsum([0, *map(len, every[:-1])])
        for sign in (1, -1):
            assert periodic_runs.lyndon_array(sign * codes, heads).tolist() == sum(
                (longest_lyndon([sign * w for w in s]) for s in every), [])


@pytest.mark.parametrize("least, periods", [(6, 4), (2, 2), (5, 3)])
def test_runs_are_those_of_all_periods(least, periods):
    draw = random.Random(periods)
    for _ in range(300):
        every = sequences(draw)
        codes = np.array(sum(every, []), dtype=np.int64)
        owner = np.repeat(np.arange(len(every)), [len(s) for s in every])
        bases = np.cumsum([0, *map(len, every)])
        want = [(a + bases[k], n, q) for k, s in enumerate(every)
                for a, n, q in expected_runs(s, least, periods)]
        got = periodic_runs.find_runs(codes, owner, least, periods)
        assert list(map(tuple, got.tolist())) == want


def expected_periodic(doc_id: int | None, text: str | None) -> tuple:
    words = cases.words_of(text)
    n = len(words)
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    runs = expected_runs(words, 6, 4)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else None
    dropped = {i for s, m, q in runs for i in range(s + q, s + m)}
    return (doc_id, len(runs), *(best or (None,) * 3),
            best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)),
            sha(" ".join(w for i, w in enumerate(words) if i not in dropped)), n)


def test_periodic_documents(spark, corpus, empty):
    short = corpus.filter("length(text) < 8000 OR text IS NULL")
    repeated = "the line of the line " * 50 + "end " * 7
    more = spark.createDataFrame(
        [(i, repeated if i % 2 else "x y " * (i % 50)) for i in range(20_000, 20_040)],
        "doc_id long, text string")
    docs = short.unionByName(more, allowMissingColumns=True)
    got = periodic_runs.table(docs).collect()
    want = [expected_periodic(i, t) for i, t in cases.pairs(docs)]
    assert cases.bag(got) == cases.bag(want)
    assert sum(r.n_runs > 0 for r in got) > 20
    assert periodic_runs.table(empty).collect() == []


def test_long_periodic_text_and_general_interface(spark):
    text = " ".join(["a", "b", "c"] * 100_000 + ["z"])
    docs = spark.createDataFrame([(1, text), (None, "q q q q q q"), (2, None), (2, " ")],
                                 "doc_id long, text string")
    got = {(r.doc_id, r.n_words): r for r in periodic_runs.scan(docs).collect()}
    long = got[1, 300_001]
    assert [tuple(r) for r in long.runs] == [(0, 300_000, 3)] and long.collapsed == "a b c z"
    assert got[None, 6].collapsed == "q" and tuple(got[None, 6].best) == (0, 6, 1)
    assert got[2, 0].runs == [] and got[2, 0].best is None and got[2, 0].collapsed == ""
    squares = periodic_runs.scan(docs, min_length=2, min_exponent=2).collect()
    assert sum(len(r.runs) for r in squares) == 2


# --- URL filter ----------------------------------------------------------------------------

ODD_URLS = [
    None, "", "no scheme/at all", "http://", "https://EXAMPLE.Net/en/x", "http://example.net",
    "http://a.example.net/en", "ftp://notexample.net/en/1", "http://org/fr/", "http://x.org/FR/",
    "http://b.example.com/de/?q=://x", "http://b.example.com?de=/de/", "x://y://net/",
    "http://é🎉.org/日本\n語", "http://h#/fr/", "http://net.example.com/net/", "http://net/",
    "http://long.example.com/" + "abc" * 4000]


def expected_split(url: str | None) -> tuple[str, str]:
    if url is None or "://" not in url:
        return "", ""
    rest = re.split(r"[?#]", url[url.index("://") + 3:], maxsplit=1)[0]
    host, slash, path = rest.partition("/")
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), slash + path


def expected_rule(host: str, path: str) -> tuple[str | None, str | None]:
    fitting = [r for r in queries.URL_RULES if (host == r.host or host.endswith("." + r.host))
               and path.startswith(r.path)]
    best = max(fitting, key=lambda r: len(str(r)), default=None)
    return (None, None) if best is None else (str(best), best.verdict)


class Markov:
    """The same model by recursion over contexts."""

    def __init__(self, texts: list[str], symbols: int, order: int):
        self.n, self.symbols, self.order = defaultdict(Counter), symbols, order
        for text in texts:
            for before, c in pieces(text, order):
                for k in range(order + 1):
                    self.n[before[order - k:]][c] += 1

    def p(self, before: str, c: str) -> float:
        below = self.p(before[1:], c) if before else 1 / self.symbols
        seen = self.n.get(before, {})
        total, kinds = sum(seen.values()), len(seen)
        return (seen.get(c, 0) + kinds * below) / (total + kinds) if total else below


def pieces(text: str, order: int) -> list[tuple[str, str]]:
    whole = "\1" * order + text + "\2"
    return [(whole[i - order:i], whole[i]) for i in range(order, len(whole))]


def expected_verdicts(urls: list[str | None], order: int) -> list[tuple]:
    rows = [(*s, *expected_rule(*s)) for s in map(expected_split, urls)]
    unseen = [zlib.crc32(r[0].encode()) % 4 == 2 for r in rows]
    symbols = len({c for r in rows for c in r[0] + r[1]} | {"\2"})
    texts = {v: [r[0] + r[1] for r, u in zip(rows, unseen) if r[3] == v and not u]
             for v in ("allow", "block")}
    models = {v: Markov(t, symbols, order) for v, t in texts.items()}
    known: dict[tuple, float] = {}

    def ratio(piece):
        if piece not in known:
            known[piece] = math.log(models["allow"].p(*piece)) - math.log(
                models["block"].p(*piece))
        return known[piece]

    scores = [sum(map(ratio, found)) / len(found)
              for found in (pieces(r[0] + r[1], order) for r in rows)]
    steps = [math.floor(s * url_filter.STEPS) for s in scores]
    labelled = [(s, r[3] == "allow") for s, r, u in zip(steps, rows, unseen) if u and r[3]]
    good = sum(g for _, g in labelled)
    bad = len(labelled) - good
    least = 0
    if good and bad:
        least = min({s for s, _ in labelled}, key=lambda t: (
            -Fraction(sum(g and s >= t for s, g in labelled), good)
            - Fraction(sum(not g and s < t for s, g in labelled), bad), abs(t), t))
    allowed = [s >= least for s in steps] if all(texts.values()) else [True] * len(rows)
    return [(host, path, rule, decided or ("allow" if a and host + path else "block"), score)
            for (host, path, rule, decided), a, score in zip(rows, allowed, scores)]


@pytest.fixture(scope="module")
def pages(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("pages") / "pages")
    given = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url")
    odd = [(None if i == 3 else 100_000 + i // 2, u) for i, u in enumerate(ODD_URLS)]
    given.unionByName(spark.createDataFrame(odd, given.schema)).selectExpr(
        "*", "'h' AS host", "1 AS `row`", "url AS text", "true AS decided",
        "2 AS size").write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("order", [5, 2])
def test_url_verdicts(pages, order):
    rows = [(r.page_id, r.url) for r in pages.collect()]
    want = expected_verdicts([u for _, u in rows], order)
    got = url_filter.table(pages, queries.URL_RULES, order)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict", "score"]
    found = got.collect()
    assert cases.bag(r[:5] for r in found) == cases.bag(
        (i, *w[:4]) for (i, _), w in zip(rows, want))
    assert sorted(r.score for r in found) == pytest.approx(sorted(w[4] for w in want), abs=1e-6)
    guessed = {r.verdict for r in found if r.rule is None}
    assert guessed == {"allow", "block"}


def test_url_models_carry_the_rules_over_to_unseen_hosts(spark, tmp_path):
    draw = random.Random(3)
    urls = [f"http://{''.join(draw.choices('abcdef', k=6))}.{end}{draw.randrange(99)}"
            for end in ("example.net/de/", "example.net/en/", "x.org/fr/", "com/en/", "com/de/")
            for _ in range(200)]
    path = str(tmp_path / "pages")
    spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").write.parquet(path)
    got = url_filter.table(spark.read.parquet(path), queries.URL_RULES).filter("rule IS NULL")
    assert got.count() == 400
    # No .com host is known to the models; what they know of paths decides for most of them.
    assert got.filter("(path LIKE '/en/%') = (verdict = 'allow')").count() >= 0.75 * 400


def test_urls_without_labels_and_without_rows(spark, tmp_path):
    for name, urls in (("none", []), ("one", ["http://a.com/", None, "http://b.net/"])):
        path = str(tmp_path / name)
        spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").write.parquet(path)
        got = url_filter.table(spark.read.parquet(path), queries.URL_RULES).collect()
        assert [r.verdict for r in sorted(got)] == ["allow", "block", "block"][:len(urls)]


# --- whitening -----------------------------------------------------------------------------

def vectors(spark, rows):
    return spark.createDataFrame(
        [(i, v, 1, "x") for i, v in rows],
        "vec_id long, embedding array<float>, i int, x string")


def expected_grid(rows) -> list[tuple[int, list[int]]]:
    usable = [(i, v) for i, v in rows if v and None not in v and all(map(math.isfinite, v))]
    longest = max((len(v) for _, v in usable), default=0)
    return [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v])
            for i, v in usable if len(v) == longest]


def check_whitening(got, rows, tolerance=1e-9) -> None:
    grid = expected_grid(rows)
    fit = sorted({tuple(x) for _, x in grid})
    n, d = len(fit), len(fit[0])
    sums = [sum(c) for c in zip(*fit)]
    centred = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(x, sums)] for x in fit])
    v = centred.T @ centred / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    k = min(16, int((e > e[0] * d * 2.3e-16).sum()))
    found = defaultdict(list)
    for r in got:
        found[r.vec_id, r.component].append(r)
    assert len(got) == len(grid) * k and {r.component for r in got} == set(range(1, k + 1))
    want = defaultdict(list)
    for i, x in grid:
        exact = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        exact = exact if exact < 1 << 63 else None
        y = np.array([float(Fraction(n * a - s, n)) for a, s in zip(x, sums)])
        for c in range(k):
            want[i, c + 1].append((exact, float(y @ u[:, c] / math.sqrt(e[c]))))
    signs = {}
    for (i, c), values in want.items():
        mine = cases.bag((r.deviation, abs(r.whitened)) for r in found[i, c])
        theirs = cases.bag((w[0], abs(w[1])) for w in values)
        assert [m[0] for m in mine] == [w[0] for w in theirs]
        assert sorted(m[1] for m in mine) == pytest.approx(
            sorted(w[1] for w in theirs), abs=1e-5)
        if len(values) == 1 and abs(values[0][1]) > 1e-3:
            sign = math.copysign(1, values[0][1] * found[i, c][0].whitened)
            assert signs.setdefault(c, sign) == sign
    for r in got:
        assert r.n == n and r.identity_error < tolerance
        assert r.explained == pytest.approx(e[r.component - 1] / v.trace(), rel=1e-9)


def test_whitening_of_the_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    check_whitening(whitening.table(table).collect(), rows)


def test_whitening_with_odd_rows(spark):
    draw = random.Random(8)
    rows = [(i, [draw.gauss(0, 1) * (1 + j) for j in range(5)]) for i in range(60)]
    rows += [(60 + i, rows[0][1]) for i in range(40)] + [(0, rows[1][1]), (None, rows[2][1])]
    rows += [(200, None), (201, []), (202, [1.0, None, 1.0, 1.0, 1.0]), (203, [1.0, 2.0]),
             (204, [float("nan")] * 5), (205, [float("inf"), 0.0, 0.0, 0.0, 0.0]),
             (9_007_199_254_740_993, rows[3][1])]
    check_whitening(whitening.table(vectors(spark, rows)).collect(), rows)


def test_whitening_without_variance(spark):
    assert whitening.table(vectors(spark, [])).collect() == []
    assert whitening.table(vectors(spark, [(1, None)])).collect() == []
    assert whitening.table(vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []
    flat = [(1, [1.0, 2.0]), (2, [3.0, 2.0]), (3, [7.0, 2.0])]
    check_whitening(whitening.table(vectors(spark, flat)).collect(), flat)


def test_whitening_of_huge_entries_is_exact(spark):
    rows = [(1, [1e9, 1.0]), (2, [-1e9, 2.0]), (3, [5e8, -3.0]), (4, [1e30, 0.0])]
    got = {r.vec_id: r for r in whitening.table(vectors(spark, rows)).collect()}
    assert set(got) == {1, 2, 3, 4} and got[4].deviation is None
    check_whitening(whitening.table(vectors(spark, rows[:3])).collect(), rows[:3], 1e-4)


def test_cross_covariance_by_polarisation():
    draw = np.random.default_rng(1)
    for scale in (50, 1 << 40):
        x = draw.integers(-scale, scale, (300, 4)) + 1_000_000
        n, sums = len(x), x.sum(axis=0).tolist()
        squares = whitening.centred_squares(x, np.array([s // n for s in sums]))
        places = {(i, j): int(squares[i, j]) for i in range(4) for j in range(i, 4)}
        got = whitening.covariance(places, [s % n for s in sums], n)
        for i in range(4):
            for j in range(4):
                exact = sum((n * int(r[i]) - sums[i]) * (n * int(r[j]) - sums[j]) for r in x)
                assert got[i, j] == float(Fraction(exact, n ** 3))
