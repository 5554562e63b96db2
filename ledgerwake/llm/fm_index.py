"""Compressed FM-index over sequences of symbols, with backward search on whole arrays.

The Burrows-Wheeler transform is kept as a wavelet matrix of packed bits with a rank count for
each word of 64, so a level takes an eighth and a sixteenth of a byte for each symbol. All
searches of a shard advance together: a step extends every open pattern by one symbol.
"""

from __future__ import annotations

import numpy as np


class BitRank:
    """Packed bits with the number of ones before each 64-bit word."""

    def __init__(self, bits: np.ndarray) -> None:
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, dtype=np.uint64)
        self.words.view(np.uint8)[:len(packed)] = packed
        ones = np.bitwise_count(self.words).astype(np.int32)
        self.before = np.concatenate([[0], np.cumsum(ones[:-1])]).astype(np.int32)
        self.zeros = len(bits) - int(ones.sum())

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Ones among the first ``at`` bits."""
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class WaveletMatrix:
    """Rank of any symbol before any position, one bit level after the other."""

    def __init__(self, symbols: np.ndarray) -> None:
        self.depth = max(1, int(symbols.max(initial=0)).bit_length())
        self.levels = []
        for level in range(self.depth - 1, -1, -1):
            bits = (symbols >> level & 1).astype(bool)
            self.levels.append(BitRank(bits))
            symbols = np.concatenate([symbols[~bits], symbols[bits]])

    def place(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where position ``at`` stands among ``symbol`` after all levels."""
        for level, rank in zip(range(self.depth - 1, -1, -1), self.levels, strict=True):
            ones = rank.ones(at)
            at = np.where(symbol >> level & 1, rank.zeros + ones, at - ones)
        return at


def suffix_order(ranks: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; sequences end in symbols that occur once."""
    n = len(ranks)
    step = 1
    order = np.argsort(ranks, kind="stable")
    while True:
        ordered = ranks[order]
        fresh = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        ranks = np.empty(n, dtype=np.int64)
        ranks[order] = fresh
        if n == 0 or fresh[-1] == n - 1:
            return order
        ahead = np.zeros(n, dtype=np.int64)
        ahead[:n - step] = ranks[step:] + 1
        ranks = ranks * (n + 1) + ahead
        order = np.argsort(ranks, kind="stable")
        step *= 2


class FmIndex:
    """Index of weighted sequences that answers how often windows of one length occur."""

    def __init__(self, sequences: list[np.ndarray], weights: np.ndarray, window: int) -> None:
        self.window = window
        lengths = np.array([len(s) for s in sequences], dtype=np.int64)
        flat = np.concatenate(sequences) if sequences else np.zeros(0, np.uint64)
        self.known, dense = np.unique(flat, return_inverse=True)
        # Sequence i ends in terminator i; symbol 0 of the transform stands for all of them.
        ends = np.cumsum(lengths + 1) - 1
        n = int(lengths.sum() + len(lengths))
        text = np.zeros(n, dtype=np.int64)
        inner = np.ones(n, dtype=bool)
        inner[ends] = False
        text[inner] = dense + 1
        ranks = text + len(lengths)
        ranks[ends] = np.arange(len(lengths))
        order = suffix_order(ranks)
        self.size = n
        self.matrix = WaveletMatrix(text[order - 1])
        symbols = np.arange(len(self.known) + 1)
        counts = np.bincount(text, minlength=len(symbols))
        first = np.concatenate([[0], np.cumsum(counts)[:-1]])
        self.base = first - self.matrix.place(symbols, np.zeros(len(symbols), dtype=np.int64))
        owner = np.repeat(np.arange(len(lengths)), lengths + 1)
        self.weight = np.concatenate([[0], np.cumsum(np.asarray(weights)[owner[order]])])
        self._group(text, order, ends, owner)

    def _group(self, text: np.ndarray, order: np.ndarray, ends: np.ndarray,
               owner: np.ndarray) -> None:
        """Runs of suffixes that share their first ``window - 1`` symbols."""
        depth = self.window - 1
        differs = np.ones(self.size, dtype=bool)
        if self.size > 1:
            a, b = order[:-1], order[1:]
            room = np.minimum(ends[owner[a]] - a, ends[owner[b]] - b)
            same = room >= depth
            for i in range(depth):
                at = np.flatnonzero(same)
                if not len(at):
                    break
                same[at] = text[a[at] + i] == text[b[at] + i]
            differs[1:] = ~same
        starts = np.flatnonzero(differs)
        self.start = starts[np.cumsum(differs) - 1] if self.size else starts
        self.end = np.append(starts[1:], self.size)[np.cumsum(differs) - 1]

    def extend(self, lo: np.ndarray, hi: np.ndarray, symbol: np.ndarray):
        """Intervals of the patterns with one more symbol in front."""
        both = self.base[np.concatenate([symbol, symbol])] + self.matrix.place(
            np.concatenate([symbol, symbol]), np.concatenate([lo, hi]))
        return both[:len(lo)], both[len(lo):]

    def occurrences(self, sequences: list[np.ndarray]) -> list[np.ndarray]:
        """For each window of each sequence, the weight of its occurrences in the index.

        Matching statistics cut off at the window: a pattern grows to the left until it is a
        window long, is counted, and gives up its last symbol; where it cannot grow, the search
        starts again one symbol further to the left.
        """
        lengths = np.array([len(s) for s in sequences], dtype=np.int64)
        found = [np.zeros(max(0, n - self.window + 1), dtype=np.int64) for n in lengths.tolist()]
        if not self.size or not len(lengths) or lengths.max() < self.window:
            return found
        flat = np.concatenate(sequences)
        at = np.minimum(np.searchsorted(self.known, flat), max(0, len(self.known) - 1))
        symbols = np.where(self.known[at] == flat, at + 1, 0)
        offset = np.cumsum(lengths) - lengths
        slots = np.cumsum(np.maximum(lengths - self.window + 1, 0))
        out = np.zeros(int(slots[-1]), dtype=np.int64)
        slot = slots - np.maximum(lengths - self.window + 1, 0)
        who = np.flatnonzero(lengths >= self.window)
        right = lengths[who] - 1
        now = right.copy()
        lo, hi = np.zeros(len(who), dtype=np.int64), np.full(len(who), self.size)
        while len(who):
            symbol = symbols[offset[who] + now]
            lo, hi = self.extend(lo, hi, symbol)
            fits = (symbol > 0) & (lo < hi)
            now = now - fits
            full = fits & (right - now == self.window)
            out[slot[who[full]] + now[full] + 1] = self.weight[hi[full]] - self.weight[lo[full]]
            lo, hi = (np.where(full, self.start[np.where(full, lo, 0)], lo),
                      np.where(full, self.end[np.where(full, lo, 0)], hi))
            shorter = full | ~fits
            right = right - shorter
            again = ~fits
            lo, hi = np.where(again, 0, lo), np.where(again, self.size, hi)
            now = np.where(again, right, now)
            alive = right >= self.window - 1
            who, right, now, lo, hi = (x[alive] for x in (who, right, now, lo, hi))
        return [out[s:s + len(f)] for s, f in zip(slot.tolist(), found, strict=True)]
