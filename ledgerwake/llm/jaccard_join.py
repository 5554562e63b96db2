"""Exact Jaccard self-join on word n-grams: a size-aware, heavy-light join.

Equal sets are one class, represented by their first row, so copies never multiply. Classes are
joined in two ways:

* **Small sets** list their subsets of fixed sizes: two sets that link share the subset that is
  their intersection, and neither lacks more than a tenth of its members in it. Each subset
  keeps its smallest set; every other one with that subset becomes a candidate with it. That
  finds all links up to connection, in as many rows as there are subsets.
* **Large sets** go to inverted lists. A list belongs to an n-gram and holds the sets that have
  it in their prefix, the few members that come first in one global order (rare before heavy,
  then by hash). Linked sets share a member of the prefix. A list is scanned in blocks of
  bounded size, two at a time; a pair passes if the sizes allow the link and the parity bitmaps,
  whose distance never exceeds that of the sets, do too. Of the pairs that pass only a minimum
  spanning forest leaves the task.

The boundary between small and large minimises the estimated cost over the histogram of set
sizes. All candidates are then verified on their whole sets, which are made from the texts once
more; a shingle is a 64-bit hash of its words, and equal sets are those of one digest over these
hashes, so words are never compared themselves. Where an edge of a forest turns
out to be no link, its list is scanned once more for all pairs between different components, so
no link that matters to a component is lost. There is no cap anywhere.

Documents link when ``100 * intersection >= percent * union``. A text with fewer words than
``width`` is one shingle; NULL and blank texts have an empty set and link with nothing. Very
long texts have all their shingles, and an empty table gives an empty one.
Rows repeated in full, or with a repeated ``doc_id``, are rows of their own. A component is named
by its smallest ``doc_id`` (NULL if it has none). Other columns are carried through by
:func:`representatives`, which keeps the smallest ``doc_id`` (NULL last, then the first in input
order) of each component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwake.llm.common import (
    MIX,
    gram_hashes,
    mixed,
    partitions,
    staged,
    text_of,
    whole_rows,
    with_row,
    word_hashes,
)
from ledgerwake.llm.components import components

# An n-gram is heavy if more than one document in so many has it.
HEAVY_SHARE = 256
# Rows of a list that are scanned together with as many others.
BLOCK = 2048
# Largest size the subset method is considered for, and the cost of a list entry in subsets.
MOST_SUBSETS = 29
ENTRY_COST = 8
# Bits of a parity bitmap: at least NARROW, else three for each member that may differ.
NARROW, WIDEST = 256, 1 << 14
SHORT_RUN = 16
# Texts that meet in a verification task, on average.
TEXTS = 256


@dataclass(frozen=True)
class Rule:
    """Shingle width and link threshold in percent."""

    width: int = 3
    percent: int = 90

    def shingles(self, text: str | None) -> np.ndarray:
        return np.unique(gram_hashes(word_hashes(text, lower=True), self.width))

    def lacks(self, n: int) -> int:
        """Members of a set of size ``n`` that a linked set may be without."""
        return n - -(-self.percent * n // 100)

    def spread(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Largest symmetric difference of linked sets of these sizes; -1 if they cannot link."""
        common = -(-self.percent * (a + b) // (100 + self.percent))
        return np.where(common <= np.minimum(a, b), a + b - 2 * common, -1)

    def bits(self, n: int) -> int:
        """Width of the parity bitmap of a set: a power of two."""
        return min(WIDEST, max(NARROW, 1 << int(3 * self.spread(n, n)).bit_length()))

    def links(self, left: np.ndarray, right: np.ndarray) -> bool:
        common = len(np.intersect1d(left, right, assume_unique=True))
        union = len(left) + len(right) - common
        return bool(union) and 100 * common >= self.percent * union


@dataclass
class Order:
    """Global order of n-grams: light ones by hash, then heavy ones by frequency."""

    heavy: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.uint64))
    rank: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.uint64))

    def first(self, grams: np.ndarray, n: int) -> np.ndarray:
        if n >= len(grams):
            return grams
        place = grams >> np.uint64(1)
        if len(self.heavy):
            at = np.minimum(np.searchsorted(self.heavy, grams), len(self.heavy) - 1)
            hit = self.heavy[at] == grams
            place = np.where(hit, np.uint64(1 << 63) + self.rank[at], place)
        return grams[np.argpartition(place, n - 1)[:n]]


def heavy_order(docs: DataFrame, rule: Rule) -> Order:
    """Heavy n-grams of the whole corpus.

    A heavy n-gram reaches its share in at least one batch of documents, so a batch reports
    no others. The result has at most ``2 * HEAVY_SHARE`` times the mean set size members.
    """

    def frequent(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            grams = [rule.shingles(text) for text in batch["text"]]
            values, counts = np.unique(np.concatenate([*grams, np.zeros(0, np.uint64)]),
                                       return_counts=True)
            keep = counts >= max(2, len(grams) / HEAVY_SHARE)
            yield pd.DataFrame({"gram": values[keep].view(np.int64), "n": counts[keep]})

    found = docs.select("text").mapInPandas(frequent, "gram bigint, n bigint").groupBy(
        "gram").agg(F.sum("n").alias("n"))
    n = docs.count()
    top = found.filter(F.col("n") * (2 * HEAVY_SHARE) >= n).orderBy("n", "gram").toPandas()
    grams = top["gram"].to_numpy(dtype=np.int64).view(np.uint64)
    by_value = np.argsort(grams)
    return Order(grams[by_value], np.arange(len(grams), dtype=np.uint64)[by_value])


def parity(grams: np.ndarray, width: int) -> bytes:
    """Bitmap with the parity of the members in each cell."""
    cells = (grams >> np.uint64(9)).astype(np.int64) & (width - 1)
    return np.packbits(np.bincount(cells, minlength=width) & 1, bitorder="little").tobytes()


def folded(bits: bytes, width: int) -> np.ndarray:
    """The bitmap of a smaller width, as 64-bit words. Cells that meet add up modulo 2."""
    words = np.frombuffer(bits, dtype=np.uint64).reshape(-1, width // 64)
    return np.bitwise_xor.reduce(words, axis=0)


def subset_keys(grams: np.ndarray, lacks: int) -> np.ndarray:
    """A key for each subset with up to ``lacks`` members missing."""
    members = mixed(grams)
    total = members.sum(dtype=np.uint64)
    keys = [np.array([total])]
    for missing in range(1, lacks + 1):
        out = np.array(list(combinations(range(len(grams)), missing)))
        keys.append(total - members[out].sum(axis=1, dtype=np.uint64))
    sizes = np.repeat([len(grams) - m for m in range(lacks + 1)], [len(k) for k in keys])
    return mixed(np.concatenate(keys) ^ mixed(sizes.astype(np.uint64)))


def signatures(docs: DataFrame, rule: Rule, order: Order) -> DataFrame:
    """For each row: set size, digest, bitmap and prefix, and all members of a small set."""
    shared = docs.sparkSession.sparkContext.broadcast(order)

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [rule.shingles(text) for text in batch["text"]]
            yield pd.DataFrame({
                "row": batch["row"], "doc_id": batch["doc_id"], "n": [len(s) for s in sets],
                "digest": [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets],
                "bits": [parity(s, rule.bits(len(s))) for s in sets],
                "grams": [s[:len(s) if len(s) <= MOST_SUBSETS else 0].view(np.int64)
                          for s in sets],
                "prefix": [shared.value.first(s, rule.lacks(len(s)) + 1).view(np.int64)
                           for s in sets]})

    light = docs.select("row", F.col("doc_id").cast("string").alias("doc_id"), "text")
    return light.mapInPandas(sign, "row bigint, doc_id string, n int, digest binary, "
                                   "bits binary, grams array<bigint>, prefix array<bigint>")


def boundary(sizes: dict[int, int], rule: Rule) -> int:
    """Largest size for the subset method, from the number of sets of each size."""

    def subsets(n: int) -> int:
        return sum(comb(n, m) for m in range(rule.lacks(n) + 1))

    best, cheapest, saved = 0, 0, 0
    for n in range(1, MOST_SUBSETS + 1):
        saved += sizes.get(n, 0) * (subsets(n) - ENTRY_COST * (rule.lacks(n) + 1))
        if saved <= cheapest:
            best, cheapest = n, saved
    return best


def small_candidates(classes: DataFrame, rule: Rule, limit: int) -> DataFrame:
    """Every class with the smallest class of each of its subsets, as ``a, b``."""

    @F.pandas_udf("array<bigint>")
    def keys(grams: pd.Series) -> pd.Series:
        return pd.Series([
            subset_keys(np.array(g, dtype=np.int64).view(np.uint64), rule.lacks(len(g))).view(
                np.int64) for g in grams])

    rows = classes.filter(F.col("n").between(1, limit)).select(
        "class", "n", F.explode(keys("grams")).alias("key"))
    least = rows.groupBy("key").agg(
        F.min(F.struct("n", "class")).alias("least"), F.count(F.lit(1)).alias("sets"))
    return rows.join(least.filter("sets > 1"), "key").select(
        F.col("least.class").alias("a"), F.col("class").alias("b")).filter("a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def list_entries(classes: DataFrame, rule: Rule, limit: int) -> DataFrame:
    """Entries ``gram, class`` of all inverted lists.

    A set just below the boundary may link with one above it, so it is listed, too.
    """
    lowest = -(-rule.percent * (limit + 1) // 100)
    listed = classes.filter((F.col("n") >= lowest) & (F.col("n") > 0))
    return listed.select("class", F.explode("prefix").alias("gram"))


def blocks(entries: DataFrame, classes: DataFrame, *extra: str) -> DataFrame:
    """Entries with size and bitmap, dealt to pairs of blocks ``gram, lo, hi``.

    ``entries`` has the length ``df`` of its list, a list of one being left out before.
    """
    info = classes.select("class", "n", "bits", *extra)
    count = F.ceil(F.col("df") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("class"), count.cast("bigint")).cast("int")
    dealt = entries.withColumns({"own": own, "count": count}).withColumn(
        "with", F.explode(F.sequence(F.lit(0), F.col("count") - 1)))
    paired = dealt.filter("count = 1 OR with <> own").select(
        "class", "gram", F.least("own", "with").alias("lo"), F.greatest("own", "with").alias("hi"))
    return paired.join(info, "class").select("gram", "lo", "hi", "class", "n", "bits", *extra)


class Bitmaps:
    """Bitmaps of a list, compared in the full width two of them have in common."""

    def __init__(self, bits: list[bytes]) -> None:
        self.width = np.array([8 * len(b) for b in bits])
        self.rows = {w: np.flatnonzero(self.width >= w) for w in np.unique(self.width).tolist()}
        self.words = {w: np.stack([folded(bits[i], w) for i in rows.tolist()])
                      for w, rows in self.rows.items()}

    def distances(self, i: int) -> np.ndarray:
        out = np.zeros(len(self.width), dtype=np.int64)
        for width, rows in self.rows.items():  # ascending: the widest in common comes last
            if width <= self.width[i]:
                own = self.words[width][np.searchsorted(rows, i)]
                out[rows] = np.bitwise_count(self.words[width] ^ own).sum(axis=1, dtype=np.int64)
        return out


class Scan:
    """Looks for pairs within the runs of a sorted partition."""

    def __init__(self, rule: Rule, cross: bool) -> None:
        self.rule, self.cross = rule, cross

    def pairs(self, run: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Positions of candidate pairs in one list."""
        sizes = run["n"].to_numpy(dtype=np.int64)
        words = Bitmaps(run["bits"].tolist())
        part = run["component"].to_numpy() if self.cross else None
        if part is not None:
            for i in range(len(run) - 1):
                near = self._near(words, sizes, i)[i + 1:] >= 0
                hit = np.flatnonzero(near & (part[i + 1:] != part[i])) + i + 1
                yield np.full(len(hit), i), hit
            return
        # Prim's algorithm: an edge for each row that some row before it is near to. Equal
        # distances are told apart by a hash of the pair, so lists with the same members
        # mostly agree on their edges.
        far = np.int64(1 << 60)
        who = run["class"].to_numpy().view(np.uint64)
        best = np.full(len(run), far)
        parent = np.zeros(len(run), dtype=np.int64)
        left = np.ones(len(run), dtype=bool)
        now, a, b = 0, [], []
        for _ in range(len(run) - 1):
            left[now] = False
            gap = self._near(words, sizes, now)
            tie = mixed((who ^ who[now]) * MIX[0] + who + who[now]) >> np.uint64(34)
            gap = np.where(gap >= 0, (gap << 30) + tie.view(np.int64), -1)
            closer = left & (gap >= 0) & (gap < best)
            best[closer] = gap[closer]
            parent[closer] = now
            now = int(np.argmin(np.where(left, best, far + 1)))
            if best[now] < far:
                a.append(parent[now])
                b.append(now)
        yield np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)

    def _near(self, words: Bitmaps, sizes: np.ndarray, i: int) -> np.ndarray:
        """Bitmap distance of every row from row ``i``; -1 where a link is impossible."""
        gap = words.distances(i)
        return np.where(gap <= self.rule.spread(sizes, sizes[i]), gap, -1)

    def short(self, rows: pd.DataFrame, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Candidate pairs of all short lists at once; the tree is not worth it here."""
        sizes = rows["n"].to_numpy(dtype=np.int64)
        words = np.stack([folded(b, NARROW) for b in rows["bits"]])
        part = rows["component"].to_numpy() if self.cross else None
        a, b = [], []
        for step in range(1, SHORT_RUN):
            left = np.flatnonzero(runs[step:] == runs[:-step])
            if not len(left):
                break
            right = left + step
            gap = np.bitwise_count(words[left] ^ words[right]).sum(axis=1, dtype=np.int64)
            hit = gap <= self.rule.spread(sizes[left], sizes[right])
            if part is not None:
                hit &= part[left] != part[right]
            a.append(left[hit])
            b.append(right[hit])
        return np.concatenate([*a, np.zeros(0, int)]), np.concatenate([*b, np.zeros(0, int)])

    def _passes(self, rows: pd.DataFrame, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The bitmap test again, in the full width two sets have in common."""
        bits, sizes = rows["bits"].to_numpy(), rows["n"].to_numpy(dtype=np.int64)
        keep = np.ones(len(a), dtype=bool)
        for k, (i, j) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
            width = 8 * min(len(bits[i]), len(bits[j]))
            if width > NARROW:
                gap = int(np.bitwise_count(folded(bits[i], width) ^ folded(bits[j], width)).sum())
                keep[k] = gap <= self.rule.spread(sizes[i], sizes[j])
        return keep

    def block(self, rows: pd.DataFrame) -> pd.DataFrame:
        """Candidates of complete lists, each a run of equal ``gram, lo, hi``."""
        keys = rows[["gram", "lo", "hi"]].to_numpy()
        new = np.ones(len(rows), dtype=bool)
        new[1:] = (keys[1:] != keys[:-1]).any(axis=1)
        runs = np.cumsum(new)
        length = np.bincount(runs)[runs]
        few = (length <= SHORT_RUN) & (length > 1)
        a, b = [], []
        short = 0
        if few.any():
            at = np.flatnonzero(few)
            i, j = self.short(rows[few], runs[few])
            i, j = at[i], at[j]
            keep = self._passes(rows, i, j)
            a.append(i[keep])
            b.append(j[keep])
            short = len(a[0])
        for first in np.flatnonzero(new & (length > SHORT_RUN)):
            for i, j in self.pairs(rows.iloc[first:first + length[first]]):
                a.append(i + first)
                b.append(j + first)
        a = np.concatenate([*a, np.zeros(0, np.int64)])
        b = np.concatenate([*b, np.zeros(0, np.int64)])
        who = rows["class"].to_numpy()
        found = pd.DataFrame({
            "a": np.minimum(who[a], who[b]), "b": np.maximum(who[a], who[b]),
            "gram": rows["gram"].to_numpy()[a], "forest": np.arange(len(a)) >= short})
        # Of a short list every pair is here already; of a long one the list may be asked again.
        once = found[~found["forest"]].sort_values("gram").drop_duplicates(["a", "b"])
        return pd.concat([once, found[found["forest"]].drop_duplicates()])


def scanned(dealt: DataFrame, rule: Rule, cross: bool = False) -> DataFrame:
    """Candidates ``a, b`` of all lists, with a ``gram`` they share.

    ``forest`` marks those of long lists, where they stand for pairs that were left out.
    """

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        worker = Scan(rule, cross)
        held: list[pd.DataFrame] = []
        for batch in batches:
            if not len(batch):
                continue
            # The last list of a batch may go on in the next one. Two blocks bound its rows.
            tail = batch[["gram", "lo", "hi"]].to_numpy()
            cut = len(batch)
            while cut and (tail[cut - 1] == tail[-1]).all():
                cut -= 1
            if held:
                ahead = held[0][["gram", "lo", "hi"]].to_numpy()[0]
                if cut == 0 and (ahead == tail[-1]).all():
                    held.append(batch)
                    continue
            held.append(batch.iloc[:cut])
            ready = pd.concat(held, ignore_index=True)
            if len(ready):
                yield worker.block(ready)
            held = [batch.iloc[cut:]]
        if held:
            yield worker.block(pd.concat(held, ignore_index=True))

    key = ["gram", "lo", "hi"]
    ranged = dealt.repartition(partitions(dealt.sparkSession), *key).sortWithinPartitions(
        *key, "class")
    return ranged.mapInPandas(scan, "a bigint, b bigint, gram bigint, forest boolean")


def texts_of(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """Packed texts of all classes in candidate pairs."""

    @F.pandas_udf("binary")
    def packed(text: pd.Series) -> pd.Series:
        press = zstandard.ZstdCompressor(level=3).compress
        return pd.Series([press(t.encode("utf-8", "surrogatepass")) for t in text])

    rows = pairs.select(F.explode(F.array("a", "b")).alias("row")).distinct()
    # The wanted texts grow with the corpus, so they are merged, at any size.
    return staged(docs.select("row", packed(text_of()).alias("z")).join(
        rows.hint("merge"), "row"), "texts")


def verified(texts: DataFrame, pairs: DataFrame, rule: Rule) -> DataFrame:
    """``a, b, linked`` for staged candidate pairs ``a, b, home``, decided on the texts.

    Pairs with one home meet in one task, so a text travels once for each home and not for each
    pair. A pair whose two sets are already connected there by verified links is left out.
    """
    wanted = staged(pairs.select(F.explode(F.array("a", "b")).alias("row"), "home").distinct(),
                    "wanted")
    buckets = max(1, wanted.count() // TEXTS)

    def check(some: pd.DataFrame, texts: pd.DataFrame) -> pd.DataFrame:
        unpress = zstandard.ZstdDecompressor().decompress
        packed_by = dict(zip(texts["row"], texts["z"], strict=True))
        sets: dict[int, np.ndarray] = {}
        above: dict[int, int] = {}

        def shingles(row: int) -> np.ndarray:
            if row not in sets:
                sets[row] = rule.shingles(
                    unpress(packed_by[row]).decode("utf-8", "surrogatepass"))
            return sets[row]

        def root(row: int) -> int:
            while above.get(row, row) != row:
                above[row] = above.get(above[row], above[row])
                row = above[row]
            return row

        found = []
        for a, b in zip(some["a"].tolist(), some["b"].tolist(), strict=True):
            left, right = root(a), root(b)
            if left == right:
                continue
            linked = rule.links(shingles(a), shingles(b))
            if linked:
                above[left] = right
            found.append((a, b, linked))
        return pd.DataFrame(found, columns=["a", "b", "linked"])

    bucket = F.pmod(F.xxhash64("home"), F.lit(buckets)).alias("bucket")
    at = wanted.select("row", bucket).distinct()
    dealt = texts.join(at.hint("merge"), "row").groupBy("bucket")
    judged = pairs.select("a", "b", bucket).groupBy("bucket").cogroup(dealt).applyInPandas(
        check, "a bigint, b bigint, linked boolean")
    return staged(judged, "verified")


def linked_classes(docs: DataFrame, classes: DataFrame, rule: Rule) -> DataFrame:
    """``node, component`` for all classes with a link to another one."""
    sizes = classes.filter(F.col("n") <= MOST_SUBSETS).groupBy("n").count().collect()
    limit = boundary({r["n"]: r["count"] for r in sizes}, rule)  # one row for each small size
    entries = list_entries(classes, rule, limit)
    lengths = entries.groupBy("gram").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    found = staged(
        scanned(blocks(entries.join(lengths, "gram"), classes), rule).unionByName(
            small_candidates(classes, rule, limit).withColumns(
                {"gram": F.col("a"), "forest": F.lit(False)})), "scanned")
    pairs = homed(staged(distinct_pairs(found), "candidates"))
    texts = texts_of(docs, pairs)
    judged = verified(texts, pairs, rule)
    edges = judged.filter("linked").select("a", "b")
    parts = staged(components(edges), "components")
    # Long lists one of whose forest edges is no link.
    failed = judged.filter("NOT linked").select("a", "b")
    broken = staged(
        found.filter("forest").join(failed, ["a", "b"]).select("gram").distinct(), "broken")
    if broken.isEmpty():
        return parts
    named = classes.join(parts.withColumnRenamed("node", "class"), "class", "left").withColumn(
        "component", F.coalesce("component", "class"))
    again = entries.join(broken, "gram")
    lengths = again.groupBy("gram").agg(F.count(F.lit(1)).alias("df"))
    more = scanned(blocks(again.join(lengths, "gram"), named, "component"), rule, cross=True)
    fresh = staged(distinct_pairs(more).join(failed, ["a", "b"], "left_anti"), "more")
    if fresh.isEmpty():
        return parts
    fresh = homed(fresh)
    # Whoever is in a pair now was in a forest before, so the texts are at hand.
    extra = verified(texts, fresh, rule).filter("linked").select("a", "b")
    return components(edges.unionByName(extra))


def distinct_pairs(found: DataFrame) -> DataFrame:
    return found.select("a", "b").distinct()


def homed(pairs: DataFrame) -> DataFrame:
    """Give staged pairs a ``home``: the component of candidates they are in.

    Large components are dealt in blocks of members, two to a home, so that a task holds a
    bounded number of texts and a text goes to no more homes than its component has blocks.
    """
    parts = staged(components(pairs), "groups")
    sizes = parts.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    count = F.ceil(F.col("size") / (2 * TEXTS))
    one, two = (F.pmod(F.xxhash64(c), count) for c in "ab")
    named = pairs.join(parts.withColumnRenamed("node", "a"), "a").join(sizes, "component")
    return staged(named.select("a", "b", F.xxhash64(
        "component", F.least(one, two), F.greatest(one, two)).alias("home")), "pairs")


def memberships(docs: DataFrame, rule: Rule, find: Callable = linked_classes) -> DataFrame:
    """``row, doc_id, n, class, component`` for all rows; both are NULL for an empty set.

    ``docs`` has ``row`` (unique, stable), ``doc_id`` and ``text``.
    """
    rows = staged(signatures(docs, rule, heavy_order(docs, rule)), "signatures")
    rows = rows.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))
    sets = rows.filter("n > 0")
    classes = staged(
        sets.groupBy("digest").agg(F.min("row").alias("class"))
        .join(sets.withColumnRenamed("row", "class").drop("doc_id"), ["digest", "class"]),
        "classes")
    parts = staged(find(docs, classes, rule), "parts")
    known = staged(classes.select("digest", "class").join(
        parts.withColumnRenamed("node", "class"), "class", "left").select(
        "digest", "class", F.coalesce("component", "class").alias("component")), "known")
    empty = rows.filter("n = 0").select(
        "row", "doc_id", "n", F.lit(None).cast("bigint").alias("class"),
        F.lit(None).cast("bigint").alias("component"))
    full = sets.select("row", "doc_id", "n", "digest").join(known, "digest").drop("digest")
    return full.unionByName(empty)


def table(docs: DataFrame, rule: Rule | None = None) -> DataFrame:
    """Set size and component of every document."""
    rows = staged(memberships(with_row(docs, "doc_id", "text"), rule or Rule()), "members")
    names = staged(rows.filter("component IS NOT NULL").groupBy("component").agg(
        F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("component_size")), "names")
    return rows.join(names, "component", "left").select(
        "doc_id", F.col("n").cast("bigint").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias(
            "component_id"),
        F.coalesce("component_size", F.lit(1)).cast("bigint").alias("component_size"))


def representatives(docs: DataFrame, rule: Rule | None = None,
                    written: bool = False) -> DataFrame:
    """One document of each component, and all with an empty set, as they came."""
    keyed = whole_rows(docs, "join-input", written)
    rows = staged(memberships(keyed, rule or Rule()), "members")
    best = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("best")
    kept = rows.filter("component IS NOT NULL").groupBy("component").agg(best).select("best.row")
    kept = kept.unionByName(rows.filter("component IS NULL").select("row"))
    return keyed.join(kept, "row", "left_semi").select("_d.*")
