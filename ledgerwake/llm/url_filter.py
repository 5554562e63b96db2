"""URL filter: rules first, then the ratio of two character models; DataFrame functions only.

A rule has a verdict, a host and the beginning of a path. It fits its host and all subdomains of
it, if the URL's path begins as the rule's does; of several that fit the longest decides. URLs that
no rule fits are judged by two variable-order Markov models over characters, one of accepted and
one of rejected URLs. Which URLs these are is up to the caller; :func:`table` learns from those that
the rules decide, so that the models carry the rules' policy to all other URLs.

A model's probability of a character interpolates over contexts of 0 to ``order`` characters: a
context of ``n`` occurrences and ``d`` different successors gives ``d / (n + d)`` of its weight to
the next shorter one (Witten-Bell), and one that was never seen all of it, so the order in effect
varies from place to place. Below order 0 all characters are equally likely. A URL's score is the
mean over its characters, end included, of the difference of both log probabilities. The score
from which on URLs are allowed is calibrated on labelled URLs whose hosts the models have not seen
(a checksum of the host picks a quarter of them): the step of ``1 / STEPS`` with the best mean of
both classes' accuracies, the one nearest 0 among equals.

Only host (A-Z folded) and path are scored; scheme, query and fragment are not. Everything that is
counted stays in tables: grams are counted with map-side combine, a context never joins more rows
than there are characters, and the driver sees one number. NULL URLs and such without ``://`` have
an empty host and path, fit no rule and are blocked. If one class has no URLs to learn from, the
rest is allowed, and if it has none to calibrate on, the step is 0. Repeated rows and ids are judged
alike, long URLs as a whole; other columns are ignored, an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerwake.llm.common import staged, with_row

ALLOW, BLOCK = "allow", "block"
ORDER = 5
STEPS = 100
START, END = "\u0001", "\u0002"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"://([^/?#]*)([^?#]*)"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    def __str__(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return path.startswith(self.path) & (
            (host == self.host) | host.endswith("." + self.host))


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?``, ``#`` or end."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 1)
    return F.translate(found, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 2)


def ruled(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``rule`` and ``decided``, its verdict, to ``df(host, path)``; NULL where none fits."""
    ranked = sorted(rules, key=lambda r: (-len(str(r)), str(r)))
    fits = [r.fits(F.col("host"), F.col("path")) for r in ranked]

    def first(values: list[str]) -> Column:
        options = [F.when(fit, F.lit(value)) for fit, value in zip(fits, values, strict=True)]
        return F.coalesce(*options, F.lit(None).cast("string"))

    return df.withColumns({"rule": first([str(r) for r in ranked]),
                           "decided": first([r.verdict for r in ranked])})


def held_out(host: Column) -> Column:
    return F.crc32(host.cast("binary")) % 4 == 2


def grams(df: DataFrame, text: Column, order: int) -> DataFrame:
    """A row for each character of ``text`` and its end: ``gram`` ends with that character and
    begins with the ``order`` characters before it. ``size`` is their number."""
    symbols = F.concat(F.array_repeat(F.lit(START), order),
                       F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0)), F.array(F.lit(END)))
    rows = df.withColumn("_symbols", symbols)
    size = F.size("_symbols") - order
    every = F.transform(F.sequence(F.lit(1), size), lambda i: F.array_join(
        F.slice(F.col("_symbols"), i, order + 1), ""))
    return rows.withColumns({"size": size, "gram": F.explode(every)}).drop("_symbols")


def _suffixes(order: int) -> Column:
    """All ends of a gram: the character with contexts of 0 to ``order`` characters."""
    return F.explode(F.array(*[
        F.substring("gram", order + 1 - k, k + 1) for k in range(order + 1)])).alias("suffix")


def gram_ratios(examples: DataFrame, order: int) -> DataFrame:
    """``gram, ratio``: difference of log probabilities of a gram's last character.

    ``examples(gram, accepted, rejected)`` has a row for each occurrence, also of grams that
    neither class holds.
    """
    seen = staged(examples.groupBy("gram").agg(
        F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected")), "url-grams")
    counts = seen.select(_suffixes(order), "accepted", "rejected").groupBy("suffix").agg(
        F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected"))
    counts = staged(counts.withColumn(
        "context", F.expr("substring(suffix, 1, char_length(suffix) - 1)")), "url-suffixes")
    contexts = counts.groupBy("context").agg(
        F.count(F.lit(1)).alias("symbols"),
        *[x for c in ("accepted", "rejected") for x in (
            F.sum(c).alias(f"{c}_n"), F.count_if(F.col(c) > 0).alias(f"{c}_d"))])
    known = staged(counts.join(contexts, "context"), "url-contexts")
    terms = seen.select("gram", _suffixes(order)).join(known, "suffix").groupBy("gram").agg(
        F.array_sort(F.collect_list(F.struct(
            F.char_length("suffix").alias("k"), "symbols", "accepted", "accepted_n", "accepted_d",
            "rejected", "rejected_n", "rejected_d"))).alias("terms"))

    def probability(kind: str) -> Column:
        def longer(p: Column, t: Column) -> Column:
            weight = t[f"{kind}_n"] + t[f"{kind}_d"]
            return F.when(weight > 0, (t[kind] + t[f"{kind}_d"] * p) / weight).otherwise(p)

        # The shortest context, with which the terms begin, is followed by every character.
        return F.aggregate("terms", F.lit(1.0) / F.col("terms")[0]["symbols"], longer)

    return terms.select("gram", (F.ln(probability("accepted"))
                                 - F.ln(probability("rejected"))).alias("ratio"))


def scores(rows: DataFrame, order: int = ORDER) -> DataFrame:
    """``row, score`` for ``rows(row, text, accepted, rejected)``, a scan of written files.

    ``accepted`` and ``rejected`` are 1 for the URLs that the models learn from, else 0.
    """
    every = grams(rows, F.col("text"), order)
    ratios = gram_ratios(every.select("gram", "accepted", "rejected"), order)
    return every.select("row", "size", "gram").join(staged(ratios, "url-ratios"), "gram").groupBy(
        "row").agg((F.sum("ratio") / F.first("size")).alias("score"))


def step(score: Column) -> Column:
    return F.floor(score * STEPS)


def calibrated(labelled: DataFrame) -> int:
    """The step of ``labelled(score, good)`` that parts good from bad best."""
    steps = labelled.groupBy(step(F.col("score")).alias("step")).agg(
        F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad"))
    # A row for each step in use; scores lie within the logarithm of the smallest probability.
    before = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    below = {c: F.coalesce(F.sum(c).over(before), F.lit(0)) for c in ("good", "bad")}
    total = {c: F.sum(c).over(whole) for c in ("good", "bad")}
    rated = steps.select("step", (
        (total["good"] - below["good"]) / F.nullif(total["good"], F.lit(0))
        + below["bad"] / F.nullif(total["bad"], F.lit(0))).alias("rate")).filter("rate IS NOT NULL")
    best = rated.orderBy(F.desc("rate"), F.abs("step"), "step").first()
    return 0 if best is None else best.step


def table(pages: DataFrame, rules: Sequence[Rule], order: int = ORDER) -> DataFrame:
    """Host, path, deciding rule and verdict of every page, and the score of the models."""
    url = F.col("url")
    rows = ruled(with_row(pages, F.col("page_id"), host_of(url).alias("host"),
                          path_of(url).alias("path")), rules)
    unseen = held_out(F.col("host"))
    learned = {
        name: (F.col("decided").eqNullSafe(verdict) & ~unseen).cast("bigint")
        for name, verdict in (("accepted", ALLOW), ("rejected", BLOCK))}
    found = staged(scores(rows.select(
        "row", F.concat("host", "path").alias("text"),
        *[c.alias(name) for name, c in learned.items()]), order), "url-scores")
    judged = rows.join(found, "row")
    classes = rows.filter("decided IS NOT NULL").filter(~unseen).select("decided").distinct()
    if classes.count() < 2:
        allowed = F.lit(True)
    else:
        least = calibrated(judged.filter(F.col("decided").isNotNull() & unseen).select(
            "score", (F.col("decided") == ALLOW).alias("good")))
        allowed = step(F.col("score")) >= least
    blank = (F.col("host") == "") & (F.col("path") == "")
    guess = F.when(allowed & ~blank, F.lit(ALLOW)).otherwise(F.lit(BLOCK))
    return judged.select("page_id", "host", "path", "rule",
                         F.coalesce("decided", guess).alias("verdict"),
                         F.round("score", 6).alias("score"))
