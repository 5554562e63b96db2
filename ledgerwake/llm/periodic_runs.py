"""Periodic runs of words, from the Lyndon arrays that grouping of suffixes yields.

A *run* is a stretch of consecutive words with smallest period ``q`` (words ``q`` apart are
identical) that no neighbouring word extends. Here a run counts if it has ``min_length`` words and
``min_exponent`` periods at least.

Every run holds a Lyndon word of ``q`` words (its root) that is the longest Lyndon word at its
place, under the order of the words or under the reverse order. Phase one of Baier's suffix sorter
groups suffixes by just these words, so after it the length of a suffix's group context is the
Lyndon array (:func:`lyndon_array`); it is done once for each order. Each root is then extended to
both sides by longest common extensions (:class:`Extensions`, exact) and is a run if it covers two
periods. Both parts work on the words themselves as dictionary codes: no hash decides equality.

Only stretches that can hold a run are grouped: within a run that counts, each word occurs
``min_exponent`` times, so a word that is rarer than that between its neighbouring rare words
belongs to no run (:func:`stretches`).

A task holds about ``BLOCK_WORDS`` words at a time, or one document if that is longer. NULL, empty
and blank texts have no words, no runs and an empty collapsed text. Repeated rows and documents are
treated alike, other columns are ignored, and an empty table gives an empty one.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_LENGTH = 6
MIN_EXPONENT = 4
BLOCK_WORDS = 1 << 18
# Rounds of the search for rare words. More would only drop more places that hold no run.
RARE_ROUNDS = 8

RUN = "struct<start:bigint,length:bigint,period:bigint>"
SCHEMA = f"doc_id bigint, n_words bigint, runs array<{RUN}>, best {RUN}, collapsed string"
RUN_TYPE = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

# Words of a document -> the words to search, given the document's seed.
Change = Callable[[list[bytes], int], list[bytes]]


def lyndon_array(codes: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon word at each place of some sequences.

    The sequences stand behind each other in ``codes`` and begin at ``heads``. This is phase one
    of the grouping suffix sorter: groups are taken from the highest to the lowest; each suffix
    ``i`` of a group looks for the nearest suffix to its left in a lower group, and what is found
    moves to a new group right above its old one, whose context grows by that of ``i`` (``times``
    contexts, if so many of the group found it).
    """
    n = len(codes)
    order = np.argsort(codes, kind="stable")
    firsts = np.flatnonzero(np.diff(codes[order], prepend=codes[order[:1]] - 1))
    members = [part.tolist() for part in np.split(order, firsts[1:])]
    top = len(members)
    group = np.empty(n, dtype=np.int64)
    group[order] = np.repeat(np.arange(top), np.diff(firsts, append=n))
    group = group.tolist()
    context = [1] * top
    below, above = list(range(-1, top - 1)), list(range(1, top + 1))
    left = np.arange(-1, n - 1)
    left[heads] = -1
    left = left.tolist()
    done = bytearray(n)
    at = top - 1
    while at >= 0:
        own = [i for i in members[at] if group[i] == at]
        members[at] = ()
        for i in own:
            done[i] = 1
        found: dict[int, int] = {}
        for i in own:
            j = left[i]
            while j >= 0 and done[j]:
                k = left[j]
                if k >= 0 and done[k]:
                    left[j] = k = left[k]
                j = k
            left[i] = j
            if j >= 0:
                found[j] = found.get(j, 0) + 1
        moved: dict[tuple[int, int], list[int]] = defaultdict(list)
        for j, times in found.items():
            moved[times, group[j]].append(j)
        for times, old in sorted(moved, reverse=True):
            new, upper = len(members), above[old]
            members.append(moved[times, old])
            context.append(context[old] + times * context[at])
            for j in members[new]:
                group[j] = new
            below.append(old)
            above.append(upper)
            above[old] = below[upper] = new
        at = below[at]
    return np.array(context, dtype=np.int64)[group]


class Extensions:
    """Longest common extensions between places of some sequences.

    Level ``k`` names the blocks of ``2**k`` words so that equal blocks, and only those, have
    equal names; an extension is put together from the largest blocks downwards.
    """

    def __init__(self, codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
        """``start`` and ``end`` hold the bounds of the sequence that each place belongs to."""
        self.start, self.end = start, end
        self.levels = [np.unique(codes, return_inverse=True)[1]]
        longest = int((end - start).max(initial=0))
        width = 1
        while 2 * width <= longest:
            names, places = self.levels[-1], np.flatnonzero(np.arange(len(codes)) + 2 * width <= end)
            pairs = names[places] * len(codes) + names[places + width]
            level = np.full(len(codes), -1)
            level[places] = np.unique(pairs, return_inverse=True)[1]
            self.levels.append(level)
            width *= 2

    def right(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from ``a`` on equal those from ``b`` on, for places ``a < b``."""
        a, b, end = a.copy(), b.copy(), self.end[a]
        first = a.copy()
        for k in reversed(range(len(self.levels))):
            fits = np.flatnonzero(b + (1 << k) <= end)
            same = fits[self.levels[k][a[fits]] == self.levels[k][b[fits]]]
            a[same] += 1 << k
            b[same] += 1 << k
        return a - first

    def left(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words before ``a`` equal those before ``b``, for places ``a < b``."""
        a, b, start = a.copy(), b.copy(), self.start[a]
        first = a.copy()
        for k in reversed(range(len(self.levels))):
            fits = np.flatnonzero(a - (1 << k) >= start)
            x, y = a[fits] - (1 << k), b[fits] - (1 << k)
            same = fits[self.levels[k][x] == self.levels[k][y]]
            a[same] -= 1 << k
            b[same] -= 1 << k
        return first - a


def stretches(codes: np.ndarray, owner: np.ndarray, min_length: int, copies: int) -> np.ndarray:
    """Places that may belong to a run, in order; consecutive ones of an owner form a stretch."""
    places, piece = np.arange(len(codes)), owner
    for _ in range(RARE_ROUNDS):
        _, name, often = np.unique(piece * (int(codes.max(initial=0)) + 1) + codes[places],
                                   return_inverse=True, return_counts=True)
        kept = often[name] >= copies
        if kept.all():
            break
        places = places[kept]
        breaks = (np.diff(places, prepend=-2) != 1) | (np.diff(owner[places], prepend=-1) != 0)
        piece = np.cumsum(breaks)
        long = np.bincount(piece)[piece] >= min_length
        places, piece = places[long], piece[long]
    return places


def find_runs(codes: np.ndarray, owner: np.ndarray, min_length: int = MIN_LENGTH,
              min_exponent: int = MIN_EXPONENT) -> np.ndarray:
    """Rows ``start, length, period`` of all runs, by start and period.

    ``codes`` are the words of some documents behind each other, ``owner`` the document of each;
    starts count from the first of all words.
    """
    if min_exponent < 2:
        raise ValueError("a run has two periods at least")
    places = stretches(codes, owner, min_length, min_exponent)
    if not len(places):
        return np.zeros((0, 3), dtype=np.int64)
    kept = np.unique(codes[places], return_inverse=True)[1]
    heads = np.flatnonzero((np.diff(places, prepend=-2) != 1)
                           | (np.diff(owner[places], prepend=-1) != 0))
    sizes = np.diff(heads, append=len(places))
    start, end = np.repeat(heads, sizes), np.repeat(heads + sizes, sizes)
    extensions = Extensions(kept, start, end)
    here = np.arange(len(places))
    runs = []
    for ordered in (kept, kept.max() - kept):
        period = lyndon_array(ordered, heads)
        after, before = extensions.right(here, here + period), extensions.left(here, here + period)
        length = period + after + before
        counts = length >= np.maximum(min_length, min_exponent * period)
        runs.append(np.stack([places[here - before], length, period], axis=1)[counts])
    return np.unique(np.concatenate(runs), axis=0)


def best_run(runs: np.ndarray) -> tuple[int, int, int] | None:
    """The run of most periods; the first and then the shortest period among equals."""
    best = None
    for run in runs.tolist():
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = tuple(run)
    return best


def collapsed(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words without those that a run repeats, its first period staying."""
    if not len(runs):
        return words
    steps = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(steps, runs[:, 0] + runs[:, 2], 1)
    np.add.at(steps, runs[:, 0] + runs[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(steps[:-1]) == 0).tolist()]


def _block(ids: pa.Array, texts: list[list[bytes]], min_length: int,
           min_exponent: int) -> pa.RecordBatch:
    code: dict[bytes, int] = defaultdict(count().__next__)
    sizes = np.array([len(words) for words in texts], dtype=np.int64)
    codes = np.fromiter((code[word] for words in texts for word in words), dtype=np.int64,
                        count=int(sizes.sum()))
    bases = np.cumsum(sizes) - sizes
    found = find_runs(codes, np.repeat(np.arange(len(texts)), sizes), min_length, min_exponent)
    cuts = np.searchsorted(found[:, 0], np.append(bases, len(codes)))
    best, kept = [], []
    for words, base, low, high in zip(texts, bases, cuts[:-1], cuts[1:], strict=True):
        own = found[low:high] - [base, 0, 0]
        found[low:high] = own
        best.append(best_run(own))
        kept.append(b" ".join(collapsed(words, own)))
    runs = pa.StructArray.from_arrays([pa.array(c) for c in found.T], fields=list(RUN_TYPE))
    names = [field.name for field in RUN_TYPE]
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(sizes), pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), runs),
         pa.array([run and dict(zip(names, run, strict=True)) for run in best], RUN_TYPE),
         pa.array(kept, pa.binary()).view(pa.string())],
        names=["doc_id", "n_words", "runs", "best", "collapsed"])


def scan(docs: DataFrame, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT,
         seed: Column | None = None, change: Change | None = None) -> DataFrame:
    """Runs of every document's words, the best of them, and its text without repeats.

    ``change`` may replace the words of a document before they are searched; it is given the
    words and the document's ``seed``, where that is not NULL.
    """

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, texts, held = 0, [], 0
            ids, seeds = batch.column(0), batch.column(1)
            for row, text in enumerate(batch.column(2)):
                # Only the six blank characters of the contract part words of bytes.
                words = (text.as_py() or b"").split()
                if change is not None and seeds[row].is_valid:
                    words = change(words, seeds[row].as_py())
                texts.append(words)
                held += len(words)
                if held >= BLOCK_WORDS:
                    yield _block(ids[first:row + 1], texts, min_length, min_exponent)
                    first, texts, held = row + 1, [], 0
            if texts:
                yield _block(ids[first:], texts, min_length, min_exponent)

    given = F.lit(None) if seed is None else seed
    rows = docs.select(F.col("doc_id").cast("bigint"), given.cast("bigint").alias("seed"),
                       F.col("text").cast("binary"))
    return rows.mapInArrow(parts, SCHEMA)


def periodic_copy(words: list[bytes], seed: int) -> list[bytes]:
    """For one seed in ten, let the words repeat from a place on; seed decides place and period."""
    g, rest = divmod(seed, 10)
    if rest or not words:
        return words
    n = len(words)
    first = g % n
    period = 1 + (n - first) // (3 + g % 8)
    root = words[first:first + period]
    return words[:first] + (root * (-(-(n - first) // period)))[:n - first]


def table(docs: DataFrame) -> DataFrame:
    """Runs of the documents, of which one in ten is made periodic by its id's checksum.

    A NULL ``doc_id`` has no checksum, so such a document is searched as it is.
    """
    checksum = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    found = scan(docs, seed=checksum, change=periodic_copy)
    best = F.col("best")
    lines = F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
        r["period"].cast("string"), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"),
        best["start"].alias("start"), best["length"].alias("length"),
        best["period"].alias("period"),
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
        "n_words")
