"""Distinct word shingles of texts as 64-bit hashes, in numpy.

Words are the maximal runs of bytes other than space and tab to carriage
return, with A-Z lower-cased. A text of ``width`` words or more has the hashes
of every ``width`` consecutive words; a shorter one has the hash of its whole
sequence; one without words has none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np

from tripspark.llm.common import mix64

WORDS_PER_SHINGLE = 5
#: Bytes of a word that are hashed together with the other words of a batch;
#: the rest of a longer word enters through a digest.
_LONG = 48

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_CODE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_STEP = np.uint64(0x100000001B3 * 0x10001 | 1)


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, first word of each row and the end) of concatenated rows."""
    word = ~_SPACE[raw]
    first = np.zeros(len(raw) + 1, dtype=bool)
    first[offsets] = True
    begins = word & first[:-1]
    begins[1:] |= word[1:] & ~word[:-1]
    ends = word & first[1:]
    ends[:-1] |= word[:-1] & ~word[1:]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    length = stops - starts
    low = _LOWER[raw]
    h = np.zeros(len(starts), dtype=np.uint64)
    left = np.arange(len(starts))
    for k in range(_LONG):
        left = left[length[left] > k]
        if not len(left):
            break
        h[left] = h[left] * _STEP + _CODE[low[starts[left] + k]]
    for i in np.flatnonzero(length > _LONG):
        rest = hashlib.blake2b(low[starts[i] + _LONG:stops[i]].tobytes(), digest_size=8).digest()
        h[i] ^= np.frombuffer(rest, dtype=np.uint64)[0]
    return mix64(h ^ mix64(length.astype(np.uint64))), np.searchsorted(starts, offsets)


def _sequence(words: np.ndarray, count: int, width: int) -> np.ndarray:
    """Hash of each run of ``width`` words; ``count`` runs."""
    out = np.full(count, np.uint64(width), dtype=np.uint64)
    for k in range(width):
        out = mix64(out + words[k:k + count] * np.uint64(2 * k + 3))
    return out


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, width: int = WORDS_PER_SHINGLE) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row."""
    words, at = word_hashes(raw, offsets)
    runs = _sequence(words, max(0, len(words) - width + 1), width)
    for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        n = hi - lo
        if n == 0:
            yield np.zeros(0, dtype=np.uint64)
        elif n < width:
            yield _sequence(words[lo:hi], 1, n)
        else:
            s = np.sort(runs[lo:hi - width + 1])
            keep = np.ones(len(s), dtype=bool)
            np.not_equal(s[1:], s[:-1], out=keep[1:])
            yield s[keep]
