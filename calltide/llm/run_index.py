"""A run-length compressed index of short texts, and matching statistics of many patterns against it."""

from __future__ import annotations

import numpy as np


def suffix_order(text: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Suffix array of texts laid end to end, each closed by a 0; equal suffixes of different texts keep their order.

    Prefix doubling from ranks of seven symbols; what lies behind the 0 of a text never counts.
    """
    n = len(text)
    at = np.arange(n)
    end = ends[np.searchsorted(ends, at)]  # the 0 that closes the text around each place
    key = np.zeros(n, np.int64)
    for k in range(7):
        key *= 257
        near = at + k <= end
        key[near] += text[at[near] + k]
    rank = np.unique(key, return_inverse=True)[1]
    width, longest = 7, int(np.diff(np.concatenate([[-1], ends])).max())
    while width < longest:
        inside = at + width <= end
        second = np.zeros(n, np.int64)
        second[inside] = rank[at[inside] + width] + 1
        rank = np.unique(rank * (n + 1) + second, return_inverse=True)[1]
        width *= 2
    return np.argsort(rank, kind="stable")


class RunIndex:
    """Runs of the Burrows-Wheeler transform of some texts, by symbol, with suffix positions at both ends of each run.

    Neither the transform nor the suffix array is kept: a rank is found from the run around a place, and a jump to the next
    run of a symbol takes the position sampled at its near end.
    """

    def __init__(self, texts: list[bytes]):
        parts = [np.frombuffer(t, np.uint8) for t in texts]
        sizes = np.array([len(p) + 1 for p in parts], np.int64)
        self.text = np.zeros(int(sizes.sum()), np.int64)
        ends = np.cumsum(sizes) - 1
        for p, e in zip(parts, ends):
            self.text[e - len(p) : e] = p.astype(np.int64) + 1
        order = suffix_order(self.text, ends)
        bwt = self.text[order - 1]
        starts = np.concatenate([[0], np.flatnonzero(bwt[1:] != bwt[:-1]) + 1])
        lengths = np.diff(np.concatenate([starts, [len(bwt)]]))
        symbols = bwt[starts]
        by_symbol = np.lexsort((starts, symbols))
        self.symbol, self.start, length = symbols[by_symbol], starts[by_symbol], lengths[by_symbol]
        self.end = self.start + length - 1
        self.first, self.last = order[self.start], order[self.end]
        # Where the rank of each run begins among all suffixes: symbols in order, then earlier runs of the same symbol.
        self.base = np.cumsum(length) - length
        self.scale = len(bwt) + 1
        self.keys = self.symbol * self.scale + self.start
        self.origin = int(order[0])

    @property
    def runs(self) -> int:
        return len(self.symbol)

    def _common(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Length of the common prefix of the text at a and at b, at most ``most``."""
        out = np.zeros(len(a), np.int64)
        longest = int(most.max()) if len(most) else 0
        if not longest:
            return out
        step = np.arange(longest)
        for at in range(0, len(a), 8192):
            s = slice(at, at + 8192)
            x = self.text[np.minimum(a[s, None] + step, len(self.text) - 1)]
            y = self.text[np.minimum(b[s, None] + step, len(self.text) - 1)]
            differs = (x != y) | (step >= most[s, None])
            out[s] = np.where(differs.any(1), differs.argmax(1), longest)
        return out

    def matching_statistics(self, patterns: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """For each place of each pattern the length of the longest match with the indexed texts that starts there.

        All patterns are read from their ends in step. Returns a matrix, one right-aligned row per pattern, and the
        patterns' lengths.
        """
        sizes = np.array([len(p) for p in patterns], np.int64)
        width = int(sizes.max()) if len(sizes) else 0
        out = np.zeros((len(patterns), width), np.int64)
        shown = np.zeros((len(patterns), width), np.int64)
        for k, p in enumerate(patterns):
            shown[k, width - len(p) :] = np.frombuffer(p, np.uint8).astype(np.int64) + 1
        row = np.zeros(len(patterns), np.int64)
        place = np.full(len(patterns), self.origin, np.int64)
        size = np.zeros(len(patterns), np.int64)
        for column in range(width - 1, -1, -1):
            live = np.flatnonzero(sizes >= width - column)
            c, q = shown[live, column], row[live]
            r = np.searchsorted(self.keys, c * self.scale + q, side="right") - 1
            held = (r >= 0) & (self.symbol[r] == c)
            inside = held & (q <= self.end[r])
            new_row, new_place, new_size = np.zeros_like(q), np.full_like(q, self.origin), np.zeros_like(q)
            k = np.flatnonzero(inside)
            new_row[k] = self.base[r[k]] + q[k] - self.start[r[k]]
            new_place[k], new_size[k] = place[live[k]] - 1, size[live[k]] + 1
            k = np.flatnonzero(~inside)
            if len(k):
                before = held[k]
                after = (r[k] + 1 < self.runs) & (self.symbol[np.minimum(r[k] + 1, self.runs - 1)] == c[k])
                now, most = place[live[k]], size[live[k]]
                low = np.where(before, self._common(now, self.last[r[k]], most), -1)
                high_run = np.minimum(r[k] + 1, self.runs - 1)
                high = np.where(after, self._common(now, self.first[high_run], most), -1)
                use_low, use_high = (low >= high) & before, (high > low) & after
                a, b = k[use_low], k[use_high]
                new_row[a] = self.base[r[a]] + self.end[r[a]] - self.start[r[a]]
                new_place[a], new_size[a] = self.last[r[a]] - 1, low[use_low] + 1
                new_row[b] = self.base[high_run[use_high]]
                new_place[b], new_size[b] = self.first[high_run[use_high]] - 1, high[use_high] + 1
            row[live], place[live], size[live] = new_row, new_place, new_size
            out[live, column] = new_size
        return out, sizes
