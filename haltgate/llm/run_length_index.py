"""A run-length index over a bounded collection of byte strings.

The suffixes are sorted; of their Burrows-Wheeler transform only the runs
count. Where a suffix and its neighbour in sorted order have the same
preceding byte, their common prefix is one shorter than that of the suffixes
one byte to the left. So the common prefixes of all suffixes with their
neighbours follow from those at the ends of the runs: the index keeps the
positions and common prefixes sampled at run ends, and the matching
statistics of the collection against its other suffixes are streamed from
them in text order.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class RunLengthIndex:
    data: np.ndarray  # all strings, one after another
    left: np.ndarray  # bytes from a position to the end of its string
    heads: tuple[np.ndarray, np.ndarray]  # positions at run heads, common prefix with the suffix before
    tails: tuple[np.ndarray, np.ndarray]  # positions at run tails, common prefix with the suffix after
    runs: int

    @classmethod
    def build(cls, strings: list[bytes]) -> RunLengthIndex:
        lengths = np.array([len(s) for s in strings], dtype=np.int64)
        data = np.frombuffer(b"".join(strings), dtype=np.uint8)
        ends = np.cumsum(lengths)
        left = np.repeat(ends, lengths) - np.arange(len(data))
        order = suffix_order(data, left)
        first = left[order] == np.repeat(lengths, lengths)[order]  # suffixes that are whole strings: no byte before
        before = np.where(first, -1, data[order - 1].astype(np.int64))
        same = (before[1:] == before[:-1]) & (before[1:] >= 0)
        at = np.flatnonzero(~same)
        common = common_prefix(data, left, order[at], order[at + 1])
        return cls(data, left, (order[at + 1], common), (order[at], common), len(at) + bool(len(order)))

    def matching_statistics(self) -> np.ndarray:
        """For each position, the length of the longest prefix of its suffix (within its
        string) that also starts at another position of the collection."""
        n = len(self.data)
        out = np.zeros(n, dtype=np.int64)
        here = np.arange(n)
        for positions, common in (self.heads, self.tails):
            reach = np.zeros(n, dtype=np.int64)
            reach[positions] = positions + common
            np.maximum(out, np.maximum.accumulate(reach) - here, out=out)
        return out


def suffix_order(data: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Suffixes, each to the end of its string, in order; equal ones by position."""
    n = len(data)
    if n == 0:
        return np.zeros(0, dtype=np.int64)
    longest = int(left.max())
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    word = np.zeros(n, dtype=np.uint64)
    for k in range(7):  # seven bytes, then how many of them belong to the string
        word = word << np.uint64(8) | np.where(left > k, padded[k : k + n], 0).astype(np.uint64)
    word = word << np.uint64(8) | np.minimum(left, 7).astype(np.uint64)
    depth = 7
    while True:
        order = np.argsort(word, kind="stable")
        ordered = word[order]
        new = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])]).astype(np.uint64)
        if depth >= longest or int(new[-1]) == n - 1:
            return order
        rank = np.empty(n, dtype=np.uint64)
        rank[order] = new + np.uint64(1)
        after = np.zeros(n, dtype=np.uint64)
        has = np.flatnonzero(left > depth)
        after[has] = rank[has + depth]
        word = rank << np.uint64(32) | after
        depth *= 2


def common_prefix(data: np.ndarray, left: np.ndarray, a: np.ndarray, b: np.ndarray, step: int = 32) -> np.ndarray:
    """Lengths of the common prefixes of suffix pairs, compared ``step`` bytes at a time."""
    out = np.zeros(len(a), dtype=np.int64)
    most = np.minimum(left[a], left[b])
    padded = np.concatenate([data, np.zeros(step, dtype=np.uint8)])
    views = np.lib.stride_tricks.sliding_window_view(padded, step)
    open_ = np.arange(len(a))
    while len(open_):
        at = out[open_]
        equal = views[a[open_] + at] == views[b[open_] + at]
        whole = equal.all(axis=1)
        gain = np.where(whole, step, np.argmin(equal, axis=1))
        out[open_] = np.minimum(at + gain, most[open_])
        open_ = open_[whole & (at + step < most[open_])]
    return out
