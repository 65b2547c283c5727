"""A run-compressed Burrows-Wheeler index over byte strings, in numpy.

The strings are sorted suffix by suffix (each ends in a border of its own, so no
match crosses one), the Burrows-Wheeler transform is cut into runs, and of the
suffix array only the entries at the runs' first and last rows are kept, each
with the length of the match it has with the row above or below. That is enough
for matching statistics: a suffix inside a run goes on as the suffix one byte
earlier did, so its match with its neighbour is the last sampled one, less the
bytes passed since. The longer of the two neighbours' matches is the longest
match that the suffix has anywhere else in the strings.

Repetitive strings have few runs, and only runs are kept.
"""

from __future__ import annotations

import numpy as np

#: Bytes compared per level of the suffix sort: 4, then twice as many each time.
_FIRST = 4


class RunLengthIndex:
    def __init__(self, strings: list[bytes]):
        lengths = np.array([len(s) for s in strings], dtype=np.int64)
        #: Where each string begins; a border follows each string.
        self.starts = np.concatenate([[0], np.cumsum(lengths + 1)])[:-1]
        self.size = int((lengths + 1).sum())
        text = np.empty(self.size, dtype=np.int64)
        borders = self.starts + lengths
        inside = np.ones(self.size, dtype=bool)
        inside[borders] = False
        text[inside] = np.frombuffer(b"".join(strings), dtype=np.uint8).astype(np.int64) + len(strings)
        text[borders] = np.arange(len(strings))
        order, levels = _suffix_order(text, len(strings) + 256)
        before = text[order - 1]  # the transform; row 0's entry wraps to the last border
        head = np.ones(self.size, dtype=bool)
        head[1:] = before[1:] != before[:-1]
        tail = np.ones(self.size, dtype=bool)
        tail[:-1] = head[1:]
        self.runs = int(head.sum())
        rows = np.flatnonzero(head)
        self.heads = self._samples(order, rows, rows - 1, text, levels)
        rows = np.flatnonzero(tail)
        self.tails = self._samples(order, rows, rows + 1, text, levels)

    def _samples(self, order: np.ndarray, rows: np.ndarray, others: np.ndarray, text: np.ndarray,
                 levels: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(positions in text order, match with the neighbouring row) of sampled rows."""
        real = (others >= 0) & (others < self.size)
        at, match = order[rows], np.zeros(len(rows), dtype=np.int64)
        match[real] = _common(at[real], order[others[real]], text, levels)
        by_place = np.argsort(at)
        return at[by_place], match[by_place]

    def matching_statistics(self) -> np.ndarray:
        """For each position, the length of its longest match that begins elsewhere, streamed from the samples."""
        out = np.zeros(self.size, dtype=np.int64)
        for at, match in (self.heads, self.tails):
            # the last sample at or before each position; position 0 is always one
            gaps = np.diff(np.append(at, self.size))
            out = np.maximum(out, np.repeat(match + at, gaps) - np.arange(self.size))
        return out


def _suffix_order(text: np.ndarray, symbols: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffix array, and ranks of all suffixes by their first 4, 8, 16 ... symbols."""
    n, bits = len(text), int(symbols).bit_length()
    if bits * _FIRST > 63:
        raise ValueError("too many strings for one index")
    key = np.zeros(n, dtype=np.int64)
    for k in range(_FIRST):
        key <<= bits
        key[:n - k] |= text[k:]
    order = np.argsort(key)
    new = np.concatenate([[True], key[order][1:] != key[order][:-1]])
    rank = np.empty(n, dtype=np.int32)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    levels, width = [rank.copy()], _FIRST
    while True:
        single = new & np.append(new[1:], True)
        open_ = np.flatnonzero(~single)
        if not len(open_):
            return order, levels
        own = order[open_]
        after = own + width
        second = np.where(after < n, rank[np.minimum(after, n - 1)], -1).astype(np.int64)
        pair = rank[own].astype(np.int64) * (n + 1) + second + 1
        by = np.argsort(pair)
        pair = pair[by]
        order[open_] = own[by]
        new[open_] = np.concatenate([[True], pair[1:] != pair[:-1]])
        first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        rank[order[open_]] = first[open_]
        levels.append(rank.copy())
        width *= 2


def _common(x: np.ndarray, y: np.ndarray, text: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Length of the common prefix of the suffixes at x and y, from the widest level down.

    Borders differ from one another, so no common prefix reaches one."""
    x, y, total, last = x.copy(), y.copy(), np.zeros(len(x), dtype=np.int64), len(text) - 1
    for rank, width in [(r, _FIRST << k) for k, r in enumerate(levels)][::-1] + [(text, 1)] * (_FIRST - 1):
        same = rank[np.minimum(x, last)] == rank[np.minimum(y, last)]
        step = np.where(same, width, 0)
        x, y, total = x + step, y + step, total + step
    return total
