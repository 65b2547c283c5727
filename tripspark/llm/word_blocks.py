"""Blocks of texts as numbers of their distinct words, in numpy.

Words are the runs of bytes between white space (Unicode's, as tokenizers have
it). A block holds each distinct word's bytes once and a 32-bit number for each
word of its rows; no Python object for a word or a row. Words are told apart by
128 bits of hashes, half of them sorted and half compared; words that agree in
the first half only are kept in a dictionary.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np

from tripspark.llm.common import mix64

#: Bytes of text that are cut into words at a time.
CHUNK_BYTES = 512 << 10
#: Bytes of a word that are hashed position by position; the rest of a longer word enters through a digest.
_LONG = 32

_ASCII_SPACE = np.zeros(256, dtype=bool)
_ASCII_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: White space beyond ASCII, in UTF-8, by its first byte.
_WIDE_SPACE = {0xC2: [b"\xc2\x85", b"\xc2\xa0"], 0xE1: [b"\xe1\x9a\x80"],
               0xE2: [bytes([0xE2, 0x80, b]) for b in (*range(0x80, 0x8B), 0xA8, 0xA9, 0xAF)] + [b"\xe2\x81\x9f"],
               0xE3: [b"\xe3\x80\x80"]}
_CODES = [mix64(np.arange(256, dtype=np.uint64) + np.uint64(seed)) for seed in (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)]
_STEPS = [np.uint64(0x100000001B3 * 0x10001 | 1), np.uint64(0x9FB21C651E98DF25)]


def _spaces(raw: np.ndarray) -> np.ndarray:
    space = _ASCII_SPACE[raw]
    for first, marks in _WIDE_SPACE.items():
        at = np.flatnonzero(raw == first)
        if len(at):
            for mark in marks:
                hit = at[at + len(mark) <= len(raw)]
                for k, b in enumerate(mark[1:], 1):
                    hit = hit[raw[hit + k] == b]
                for k in range(len(mark)):
                    space[hit + k] = True
    return space


def _hashes(raw: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
    out = []
    for code, step in zip(_CODES, _STEPS, strict=True):
        h = np.zeros(len(begins), dtype=np.uint64)
        left = np.arange(len(begins))
        for k in range(_LONG):
            left = left[lengths[left] > k]
            if not len(left):
                break
            h[left] = h[left] * step + code[raw[begins[left] + k]]
        out.append(h)
    for i in np.flatnonzero(lengths > _LONG):
        rest = hashlib.blake2b(raw[begins[i] + _LONG:begins[i] + lengths[i]].tobytes(), digest_size=16).digest()
        for h, part in zip(out, np.frombuffer(rest, np.uint64), strict=True):
            h[i] ^= part
    return [mix64(h ^ mix64(lengths.astype(np.uint64))) for h in out]


def pieces(text: bytes) -> Iterator[bytes]:
    """A text cut behind spaces or line feeds into pieces of about CHUNK_BYTES; a longer word stays whole."""
    at = 0
    while len(text) - at > CHUNK_BYTES:
        ends = [e for mark in (b" ", b"\n") if (e := text.find(mark, at + CHUNK_BYTES)) >= 0]
        if not ends:
            break
        yield text[at:min(ends) + 1]
        at = min(ends) + 1
    yield text[at:] if at else text


class WordBlock:
    """Texts given row by row; ``close`` sorts the words by bucket."""

    def __init__(self) -> None:
        self._waiting: list[tuple[int, bytes]] = []
        self._size = 0
        self.rows = 0
        self.words = 0
        self._known = np.zeros(0, dtype=np.uint64)
        self._second = np.zeros(0, dtype=np.uint64)
        self._number = np.zeros(0, dtype=np.int32)
        self._odd: dict[bytes, int] = {}
        self._bytes: list[bytes] = []
        self._lengths: list[np.ndarray] = []
        self._hash_of: list[np.ndarray] = []
        self._numbers: list[np.ndarray] = []
        self._counts: list[np.ndarray] = []
        self._counted = 0

    def add(self, text: bytes) -> None:
        for piece in pieces(text):
            self._waiting.append((self.rows, piece))
            self._size += len(piece)
            if self._size >= CHUNK_BYTES:
                self._flush()
        self.rows += 1

    def _flush(self) -> None:
        """Number the words of the waiting texts."""
        waiting, self._waiting, self._size = self._waiting, [], 0
        raw = np.frombuffer(b"\n".join(t for _, t in waiting), dtype=np.uint8)
        ends = np.cumsum([len(t) + 1 for _, t in waiting])
        edge = np.ones(len(raw) + 2, dtype=np.int8)
        edge[1:-1] = _spaces(raw)
        turn = np.diff(edge)
        begins = np.flatnonzero(turn == -1)
        lengths = np.flatnonzero(turn == 1) - begins
        owner = np.searchsorted(ends, begins, side="right")
        rows = np.array([r for r, _ in waiting])
        counts = np.bincount(rows[owner] - rows[0], minlength=int(rows[-1] - rows[0]) + 1)
        if rows[0] < self._counted:  # a row that goes on
            self._counts[-1][-1] += counts[0]
            counts = counts[1:]
        self._counted = int(rows[-1]) + 1
        if len(counts):
            self._counts.append(counts)
        if not len(begins):
            return
        first, second = _hashes(raw, begins, lengths)
        own, at, of = np.unique(first, return_index=True, return_inverse=True)
        place = np.minimum(np.searchsorted(self._known, own), max(len(self._known) - 1, 0))
        there = self._known[place] == own if len(self._known) else np.zeros(len(own), dtype=bool)
        new = np.flatnonzero(~there)
        new = new[np.argsort(at[new], kind="stable")]  # numbers in the order of first sight
        numbers = np.empty(len(own), dtype=np.int32)
        numbers[there] = self._number[place[there]]
        numbers[new] = self.words + np.arange(len(new), dtype=np.int32)
        expected = second[at]
        expected[there] = self._second[place[there]]
        found = numbers[of]
        self._take(raw, begins[at[new]], lengths[at[new]], own[new])
        for i in np.flatnonzero(expected[of] != second):
            word = raw[begins[i]:begins[i] + lengths[i]].tobytes()
            if word not in self._odd:
                self._odd[word] = self.words
                self._take(raw, begins[i:i + 1], lengths[i:i + 1], first[i:i + 1])
            found[i] = self._odd[word]
        self._numbers.append(found)
        if len(new):
            known = np.concatenate([self._known, own[new]])
            order = np.argsort(known, kind="stable")
            self._known = known[order]
            self._second = np.concatenate([self._second, expected[new]])[order]
            self._number = np.concatenate([self._number, numbers[new]])[order]

    def _take(self, raw: np.ndarray, begins: np.ndarray, lengths: np.ndarray, hashes: np.ndarray) -> None:
        """Keep the bytes of new words."""
        if len(begins):
            self._bytes.append(gather(raw, begins, lengths).tobytes())
            self._lengths.append(lengths.astype(np.int32))
            self._hash_of.append(hashes)
            self.words += len(begins)

    def close(self, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """(the words' numbers in the order of their buckets, the bucket of each)."""
        self._flush() if self._waiting else None
        empty = np.zeros(0, dtype=np.uint64)
        bucket = (np.concatenate([empty, *self._hash_of]) % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable").astype(np.int32)
        return order, bucket[order]

    def lists(self, order: np.ndarray, bucket: np.ndarray) -> Iterator[tuple[int, bytes]]:
        """(bucket, its words joined by spaces) of a closed block."""
        flat = b"".join(self._bytes)
        ends = np.cumsum(np.concatenate([np.zeros(0, np.int32), *self._lengths]), dtype=np.int64)
        begins = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        own, starts = np.unique(bucket, return_index=True)
        for b, lo, hi in zip(own.tolist(), starts.tolist(), [*starts[1:].tolist(), len(bucket)], strict=True):
            words = order[lo:hi]
            yield b, b" ".join([flat[s:e] for s, e in zip(begins[words].tolist(), ends[words].tolist(), strict=True)])

    def numbers(self) -> Iterator[np.ndarray]:
        """The numbers of each row's words, in order, of a closed block; what was given is let go."""
        parts, at = [], 0
        left, self._numbers = self._numbers[::-1], []
        for n in np.concatenate([np.zeros(0, np.int64), *self._counts]).tolist():
            while n > 0:
                take = left[-1][at:at + n]
                parts.append(take)
                n, at = n - len(take), at + len(take)
                if at == len(left[-1]):
                    left.pop()
                    at = 0
            yield parts[0] if len(parts) == 1 else np.concatenate([np.zeros(0, np.int32), *parts])
            parts = []


def gather(raw: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The concatenated ``raw[begin:begin + length]``."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return raw[np.arange(total) + np.repeat(begins - (ends - lengths), lengths)]
