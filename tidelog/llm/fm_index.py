"""A compressed full-text index over passages of words, searched backwards.

The text is all passages, each closed by a separator. Kept are: its Burrows-Wheeler
transform as a wavelet matrix (one bit vector per bit of a word number, with counts
every 64 bits), where each word's suffixes begin, and a bit vector that marks the
blocks of suffixes that agree in their first ``width`` words, with the smallest owner
of each block. Suffix array and text are only needed to build these.
"""

from __future__ import annotations

import numpy as np


class Bits:
    """A bit vector with rank."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        words = np.zeros(len(bits) // 64 + 1, np.uint64)
        words.view(np.uint8)[: len(packed)] = packed
        self.words = words
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(words))[:-1])).astype(np.int64)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class WaveletMatrix:
    def __init__(self, symbols: np.ndarray, sigma: int):
        self.levels, self.zeros = [], []
        self.depth = max(1, int(sigma - 1).bit_length())
        for b in range(self.depth - 1, -1, -1):
            ones = (symbols >> b & 1).astype(bool)
            self.levels.append(Bits(ones))
            self.zeros.append(int(len(ones) - ones.sum()))
            symbols = np.concatenate((symbols[~ones], symbols[ones]))
        every = np.arange(sigma)
        self.start = self._down(every, np.zeros(sigma, np.int64))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for k, (bits, zeros) in enumerate(zip(self.levels, self.zeros, strict=True)):
            ones = bits.rank(at)
            at = np.where(symbol >> (self.depth - 1 - k) & 1, zeros + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        return self._down(symbol, at) - self.start[symbol]


def suffix_order(start: np.ndarray, depths: set[int]) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """Suffixes in order, by doubling, and the ranks by the first d symbols for d in ``depths``.

    Some symbol near the end of every repeat must be unique, as separators are here.
    """
    n, depth, kept = len(start), 1, {}
    rank = np.unique(start, return_inverse=True)[1].astype(np.int64)
    while True:
        if depth in depths:
            kept[depth] = rank
        if rank.max(initial=0) == n - 1 and depth >= max(depths, default=1):
            order = np.empty(n, np.int64)
            order[rank] = np.arange(n)
            return order, kept
        after = np.zeros(n, np.int64)
        after[: max(0, n - depth)] = rank[depth:] + 1
        rank = np.unique(rank * (n + 1) + after, return_inverse=True)[1].astype(np.int64)
        depth *= 2


class FMIndex:
    """Passages of word numbers (1 and up), each with an owner."""

    def __init__(self, passages: list[np.ndarray], owners: np.ndarray, width: int):
        self.width, count = width, len(passages)
        sizes = np.array([len(p) for p in passages])
        n = int(sizes.sum()) + count
        ends = np.cumsum(sizes + 1) - 1
        text = np.zeros(n, np.int64)
        is_word = np.ones(n, bool)
        is_word[ends] = False
        text[is_word] = np.concatenate(passages)
        sigma = int(text.max(initial=0)) + 1
        # Separators differ from each other and come before all words.
        ranked = text + count
        ranked[ends] = np.arange(count)
        parts = [1 << b for b in range(width.bit_length()) if width >> b & 1]
        order, ranks = suffix_order(ranked, set(parts))

        self.matrix = WaveletMatrix(text[order - 1], sigma)
        self.first = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=sigma))[:-1]))
        self.size = n

        agree, at = np.ones(max(0, n - 1), bool), 0
        for d in sorted(parts, reverse=True):
            p, q = order[:-1] + at, order[1:] + at
            ok = (p < n) & (q < n)
            agree &= ok & (ranks[d][np.minimum(p, n - 1)] == ranks[d][np.minimum(q, n - 1)])
            at += d
        starts = np.flatnonzero(np.concatenate(([True], ~agree)))
        marks = np.zeros(n, bool)
        marks[starts] = True
        self.marks = Bits(marks)
        self.block_start = np.append(starts, n)
        self.block_owner = np.minimum.reduceat(np.repeat(owners, sizes + 1)[order], starts)

    def step(self, word: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One word to the left: the suffixes that begin with it and go on as before."""
        both = self.matrix.rank(np.concatenate((word, word)), np.concatenate((low, high)))
        begin = self.first[word]
        return begin + both[: len(word)], begin + both[len(word) :]

    def window_owners(self, passages: list[np.ndarray]) -> list[np.ndarray]:
        """For each window of ``width`` words of each passage, the smallest owner of an equal one.

        All passages are searched side by side from their ends. Once a match is
        ``width`` long, its suffixes are a whole block; one word more to the left is
        matched and the last one let go, by widening to the block around. A word or
        window that the index has not gives the largest integer.
        """
        none = np.iinfo(np.int64).max
        out = [np.full(max(0, len(p) - self.width + 1), none, np.int64) for p in passages]
        live = np.array([k for k, p in enumerate(passages) if len(p) >= self.width], np.int64)
        if not len(live):
            return out
        sizes = np.array([len(passages[k]) for k in live])
        grid = np.zeros((len(live), int(sizes.max())), np.int64)
        for row, k in enumerate(live):
            grid[row, : sizes[row]] = passages[k][::-1]
        found = np.full(grid.shape, none, np.int64)
        low, high = np.zeros(len(live), np.int64), np.full(len(live), self.size, np.int64)
        length = np.zeros(len(live), np.int64)
        for t in range(grid.shape[1]):
            at = np.flatnonzero(sizes > t)
            word = grid[at, t]
            known = word < len(self.first)
            lo, hi = self.step(np.where(known, word, 0), low[at], high[at])
            good = known & (hi > lo) & (word > 0)
            lost = at[~good]
            low[lost], high[lost], length[lost] = 0, self.size, 0
            at, lo, hi = at[good], lo[good], hi[good]
            length[at] += 1
            whole = length[at] >= self.width
            block = self.marks.rank(lo + 1) - 1
            low[at] = np.where(whole, self.block_start[block], lo)
            high[at] = np.where(whole, self.block_start[np.minimum(block + 1, len(self.block_start) - 1)], hi)
            found[at[whole], t] = self.block_owner[block[whole]]
        for row, k in enumerate(live):
            out[k] = found[row, self.width - 1 : sizes[row]][::-1].copy()
        return out
