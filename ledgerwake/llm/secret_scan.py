"""Secret scan: fixed patterns, and random strings found by token efficiency.

The base kinds are three patterns; their spans always stay:

* ``assign``: a credential word, ``:`` or ``=``, and a value of six or more characters;
* ``access``: ``AKIA`` and capitals or digits, 20 or more characters in all;
* ``hex``: 24 or more lower-case hexadecimal digits.

Each is matched leftmost and without overlap, and a match that is too short is dropped after it
has used up its characters. The fourth kind, ``random``, is the method: 20 or more characters of
a credential alphabet that a byte-pair vocabulary needs many tokens for, at most ``MAX_RATIO``
characters for each. Prose in any spelling costs fewer tokens than a random string. A run of that
alphabet is taken without the base spans in it, first as a whole and then, so that readable
neighbours hide nothing, in stretches of parts between ``_ . / = + -`` that are each at or below
the ratio.

Known by form, and never random, are digests (hexadecimal of the usual lengths), UUIDs, numbers of
up to 8 digits and parts of up to 3 letters; other parts are identifiers only if their own ratio
is above ``MAX_RATIO``. A run of known parts and identifiers alone is not random.

Offsets are code points, end exclusive. NULL and empty texts have no spans. Very long texts are
scanned whole. Repeated rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The base patterns, in the order in which spans of one start are listed.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "random")
MIN_VALUE, MIN_ACCESS = 6, 20

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=.-]{20,}")
MAX_RATIO = 2.0
DIGEST = re.compile(r"(?:[0-9a-fA-F]{32}|[0-9a-fA-F]{40}|[0-9a-fA-F]{56}|[0-9a-fA-F]{64}"
                    r"|[0-9a-fA-F]{96}|[0-9a-fA-F]{128})")
UUID = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
PART = re.compile(rf"(?<![A-Za-z0-9]){UUID.pattern}(?![A-Za-z0-9])|[A-Za-z0-9]+")
SHORT = re.compile(r"[A-Z]?[a-z]{1,3}|[A-Z]{1,3}|[A-Za-z]{1,2}\d|\d{1,8}")
MIN_RANDOM = 20

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text)
             if len(m[2]) >= MIN_VALUE]
    found += [("access", *m.span()) for m in ACCESS.finditer(text)
              if len(m[0]) >= MIN_ACCESS]
    # A run is matched from its first character, so asking for 24 at once drops the same runs.
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return ordered(found)


def ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def listed(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def free(runs: Iterable[tuple[int, int]], taken: list[Span]) -> Iterator[tuple[int, int]]:
    """What sorted spans leave of some runs, in one sweep over both; the runs follow each other."""
    spans = iter(taken)
    span = next(spans, None)
    reach = 0  # where the spans that began so far end
    for start, end in runs:
        start = max(start, min(reach, end))
        while span is not None and span[1] < end:
            if start < span[1]:
                yield start, span[1]
            reach = max(reach, span[2])
            start = max(start, min(reach, end))
            span = next(spans, None)
        if start < end:
            yield start, end


class TokenEfficiency:
    """Finds strings that cost a vocabulary many tokens."""

    def __init__(self, ranks_path: str, pattern: str) -> None:
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(piece): int(rank)
                     for piece, rank in (line.split() for line in lines)}
        self.encoding = tiktoken.Encoding(
            "scan", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def ratio(self, text: str) -> float:
        """Characters for each token."""
        return len(text) / max(1, len(self.encoding.encode_ordinary(text)))

    def random(self, text: str, start: int, end: int) -> Iterator[tuple[int, int]]:
        """Spans of random strings in a run of the credential alphabet."""
        end = start + len(text[start:end].rstrip(".-"))
        if end - start < MIN_RANDOM:
            return
        parts = []
        for m in PART.finditer(text, start, end):
            form = DIGEST.fullmatch(m[0]) or UUID.fullmatch(m[0])
            short = bool(SHORT.fullmatch(m[0]))
            opaque = not (form or short) and self.ratio(m[0]) <= MAX_RATIO
            parts.append((*m.span(), short, opaque))
        if not any(opaque for *_, opaque in parts):
            return
        if self.ratio(text[start:end]) <= MAX_RATIO:
            yield start, end
            return
        # Short parts belong to a stretch if opaque ones stand on both sides.
        stretch: list[int] = []
        for a, b, short, opaque in [*parts, (end, end, False, False)]:
            if opaque:
                stretch = [stretch[0] if stretch else a, b]
            elif stretch and not short:
                a, b = stretch
                stretch = []
                if b - a >= MIN_RANDOM and self.ratio(text[a:b]) <= MAX_RATIO:
                    yield a, b

    def spans(self, text: str, taken: list[Span]) -> list[Span]:
        runs = (m.span() for m in CANDIDATE.finditer(text))
        return [("random", a, b) for start, end in free(runs, taken)
                for a, b in self.random(text, start, end)]


_scanners: dict[tuple[str, str], TokenEfficiency] = {}


def scanner(ranks_path: str, pattern: str) -> TokenEfficiency:
    """One for each vocabulary and worker process."""
    key = ranks_path, pattern
    if key not in _scanners:
        _scanners[key] = TokenEfficiency(*key)
    return _scanners[key]


def spans_of(text: str, efficiency: TokenEfficiency) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans."""
    base = base_spans(text)
    return base, ordered(base + efficiency.spans(text, base))


def scan(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Counts of base spans, checksum of their list, and the list of all spans."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        efficiency = scanner(ranks_path, pattern)
        for batch in batches:
            found = []
            for text in batch["text"]:
                base, every = spans_of(text or "", efficiency)
                kinds = [kind for kind, _, _ in base]
                found.append([*(kinds.count(k) for k in KINDS[:3]),
                              hashlib.sha256(listed(base).encode()).hexdigest(), listed(every)])
            names = ["n_assign", "n_access", "n_hex", "base_sha256", "spans"]
            yield batch[["doc_id"]].join(
                pd.DataFrame(found, columns=names, index=batch.index))

    # The id travels as text: pandas would turn integers beside a NULL into floats.
    light = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    found = light.mapInPandas(rows, "doc_id string, n_assign bigint, n_access bigint, "
                                    "n_hex bigint, base_sha256 string, spans string")
    return found.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))
