"""Run-length index over a collection of byte strings: its Burrows-Wheeler transform in runs, suffix
samples at the run ends, and the matching statistics that stream from them.

Strings are closed by separators that differ from each other, so no match crosses a string's end. Between
two suffixes that are neighbours in sorted order, the match grows by one when both step back over the same
byte; so only neighbours at a run boundary, whose bytes before differ, need their common length measured.
From a sample ``(j, n)`` the statistics of the positions behind follow: at j + d a match of n - d bytes with
another place. In a repetitive collection the runs are few next to the bytes.
"""

from __future__ import annotations

import numpy as np


class RunIndex:
    def __init__(self, strings: list[np.ndarray]):
        sizes = np.array([len(s) for s in strings], dtype=np.int64)
        #: place of each string's first byte; a separator stands behind each string
        self.first = np.r_[0, np.cumsum(sizes + 1)]
        n = int(self.first[-1])
        text = np.zeros(n, dtype=np.int64)
        inside = np.ones(n, dtype=bool)
        inside[self.first[1:] - 1] = False
        text[inside] = np.concatenate(strings).astype(np.int64) + len(strings) if n else 0
        text[~inside] = np.arange(len(strings))
        self.text, self.inside = text, inside
        self.order, self.ranks = self._sorted(int(sizes.max(initial=0)) + 1)
        # the transform, its run boundaries, and the suffixes at the run ends
        before = text[self.order - 1]
        edge = np.flatnonzero(before[1:] != before[:-1])
        self.runs = before[np.r_[0, edge + 1]] if n else before
        self.ends, self.heads = self.order[edge], self.order[edge + 1]

    def _sorted(self, longest: int):
        """Suffix order by doubling; ``ranks`` holds (width, rank of the first width symbols) for each width."""
        n, ranks = len(self.text), []
        if not n:
            return np.zeros(0, dtype=np.int64), ranks
        def joined(rank: np.ndarray, by: int, times: int) -> np.ndarray:
            """Keys that sort by the ranks here, ``by`` further on, and so on."""
            base, key = int(rank.max()) + 2, rank.astype(np.int64) + 1
            for shift in range(by, by * times + 1, by):
                moved = np.zeros(n, dtype=np.int64)
                moved[: max(0, n - shift)] = rank[shift:] + 1
                key = key * base + moved
            return key

        # four symbols fit into a key at first, if their number is below 2^15
        width = 4 if int(self.text.max()) + 2 < 2**15 else 2
        key = joined(self.text, 1, width - 1)
        while True:
            order = np.argsort(key)
            there = key[order]
            rank = np.empty(n, dtype=np.int32)
            rank[order] = np.cumsum(np.r_[0, there[1:] != there[:-1]])
            ranks.append((width, rank))
            if rank[order[-1]] == n - 1 or width >= longest:
                return order, ranks
            key = joined(rank, width, 1)
            width *= 2

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common prefix of the suffixes at ``a`` and ``b``."""
        n = len(self.text)
        out = np.zeros(len(a), dtype=np.int64)
        for width, rank in [*reversed(self.ranks), (2, None), (1, None)]:
            for _ in range(2 if width <= 2 else 1):
                x, y = a + out, b + out
                ok = np.maximum(x, y) + width <= n
                x, y = np.minimum(x, n - 1), np.minimum(y, n - 1)
                if rank is not None:
                    ok &= rank[x] == rank[y]
                else:
                    for d in range(width):
                        ok &= self.text[np.minimum(x + d, n - 1)] == self.text[np.minimum(y + d, n - 1)]
                out[ok] += width
        return out

    def long_matches(self, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Samples ``(j, n)`` of the matching statistics with n >= least, whose streams cover just the bytes
        inside matches of that length with another place."""
        length = self.common(self.ends, self.heads)
        far = length >= least
        return np.r_[self.ends[far], self.heads[far]], np.r_[length[far], length[far]]
