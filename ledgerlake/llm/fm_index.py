"""An FM-index over a sequence of small numbers: Burrows-Wheeler transform, wavelet tree of ranks, sampled positions.

Every search runs for many patterns at once, one array operation a step.
"""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of all suffixes of a sequence of numbers; zeros end a suffix, and stand in order of their place.

    Prefix doubling; only suffixes that still tie are ordered again.
    """
    n = len(text)
    rank = text.astype(np.int64)
    ends = text == 0
    rank[ends] = np.arange(ends.sum())
    rank[~ends] += ends.sum()
    order = np.argsort(rank, kind="stable")
    rank = _ranks(rank[order], order, n)
    step = 1
    while True:
        sizes = np.bincount(rank, minlength=n)
        open_ = np.flatnonzero(sizes[rank[order]] > 1)  # places in the order whose group is not settled
        if not len(open_):
            return order
        members = order[open_]
        key = rank[members] * np.int64(n + 1) + np.where(members + step < n, rank[np.minimum(members + step, n - 1)] + 1, 0)
        again = np.argsort(key, kind="stable")
        members, key = members[again], key[again]
        order[open_] = members
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        first = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))
        head = np.ones(len(key), bool)  # where an old group begins
        head[1:] = key[1:] // (n + 1) != key[:-1] // (n + 1)
        base = np.maximum.accumulate(np.where(head, np.arange(len(key)), 0))
        fresh = rank.copy()
        fresh[members] = rank[members] + (first - base)
        rank = fresh
        step *= 2


def _ranks(values: np.ndarray, order: np.ndarray, n: int) -> np.ndarray:
    """Rank of each suffix: how many are before its group."""
    new = np.ones(n, bool)
    new[1:] = values[1:] != values[:-1]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    return rank


class WaveletTree:
    """Ranks in a sequence of numbers, bit by bit from the highest; each level is stably split by its bit."""

    def __init__(self, values: np.ndarray, bits: int):
        self.bits, self.levels, self.zeros = bits, [], []
        values = values.astype(np.int64)
        for level in range(bits):
            bit = (values >> (bits - 1 - level)) & 1
            self.levels.append(np.concatenate([[0], np.cumsum(bit)]).astype(np.int32))
            self.zeros.append(int(len(bit) - bit.sum()))
            values = np.concatenate([values[bit == 0], values[bit == 1]])
        # In the last level, equal numbers stand together; where each number's begin.
        self.begins = self._walk(np.arange(1 << bits), np.zeros(1 << bits, np.int64))

    def _walk(self, value: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level in range(self.bits):
            ones = self.levels[level][at]
            bit = (value >> (self.bits - 1 - level)) & 1
            at = np.where(bit == 1, self.zeros[level] + ones, at - ones)
        return at

    def rank(self, value: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often value[i] stands before place at[i]."""
        return self._walk(value, at.astype(np.int64)) - self.begins[value]

    def access(self, at: np.ndarray) -> np.ndarray:
        """The number at each place."""
        at, value = at.astype(np.int64), np.zeros(len(at), np.int64)
        for level in range(self.bits):
            ones = self.levels[level][at]
            bit = self.levels[level][at + 1] - ones
            at = np.where(bit == 1, self.zeros[level] + ones, at - ones)
            value = 2 * value + bit
        return value


class FMIndex:
    """text: numbers from 1 up, with 0 as the end of each part; it ends with 0. Every `sample`-th place is kept."""

    def __init__(self, text: np.ndarray, sample: int = 8):
        order = suffix_array(text)
        self.bits = max(1, int(text.max(initial=1)).bit_length())
        self.tree = WaveletTree(text[order - 1], self.bits)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=1 << self.bits))])
        # The place after an end is kept too, so that no walk has to pass an end.
        marked = (order % sample == 0) | (text[order - 1] == 0)
        self.marks = np.concatenate([[0], np.cumsum(marked)])
        self.places = order[marked]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """patterns: one in each row, of one length -> begin and end of its suffixes in the order."""
        low = np.zeros(len(patterns), np.int64)
        high = np.full(len(patterns), self.marks.size - 1, np.int64)
        for i in range(patterns.shape[1] - 1, -1, -1):
            c = patterns[:, i].astype(np.int64)
            known = c < 1 << self.bits
            c = np.where(known, c, 0)
            low = np.where(known, self.before[c] + self.tree.rank(c, low), 0)
            high = np.where(known, self.before[c] + self.tree.rank(c, high), 0)
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The place in the text of each row of the order, by steps back to a kept place."""
        out = np.empty(len(rows), np.int64)
        left, at, steps = np.arange(len(rows)), rows.astype(np.int64), 0
        while len(left):
            kept = self.marks[at + 1] > self.marks[at]
            out[left[kept]] = self.places[self.marks[at[kept]]] + steps
            left, at = left[~kept], at[~kept]
            c = self.tree.access(at)
            at = self.before[c] + self.tree.rank(c, at)
            steps += 1
        return out
