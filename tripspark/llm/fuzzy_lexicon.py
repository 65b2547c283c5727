"""Levenshtein automata of a lexicon's terms, intersected with the lexicon's trie.

A term is a whole word, or a stem that any ending may follow, with the number of
edits (a letter added, left out or changed, or two neighbours exchanged) that a
word may be away from it. The automaton's states are sets of (trie node, edits
made so far); they are formed once, when the lexicon is known, for the letters of
the lexicon and one class for all other letters. Words of a batch of texts then
walk through the table together, a letter at a time, and most leave it after two
or three letters.
"""

from __future__ import annotations

import sys
import unicodedata
from dataclasses import dataclass

import numpy as np

#: Classes of characters: between words, and letters that no term has.
BETWEEN, OTHER = 0, 1
DEAD = 0


@dataclass(frozen=True)
class Term:
    letters: str
    #: A whole word; otherwise a stem.
    whole: bool
    edits: int


def _is_letter(char: str) -> bool:
    return char.isalnum() or unicodedata.category(char)[0] == "M"


def fold(text: str) -> str:
    """Lower case, character by character, so that places stay the same."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower()[0] for c in text)


_classes: dict[str, np.ndarray] = {}


def character_classes(alphabet: str) -> np.ndarray:
    """The class of every code point; letters of the alphabet (lower case) have the classes from 2 on."""
    if alphabet not in _classes:
        table = np.zeros(sys.maxunicode + 1, dtype=np.int16)
        of = {c: i for i, c in enumerate(alphabet, OTHER + 1)}
        for point in range(sys.maxunicode + 1):
            char = chr(point)
            if _is_letter(char):
                table[point] = of.get(char.lower()[0], OTHER)
        _classes[alphabet] = table
    return _classes[alphabet]


class Trie:
    """Nodes of the terms' letters; ``ends`` and ``allowed`` (most edits of a term below) by node."""

    def __init__(self, terms: list[Term], number: dict[str, int]) -> None:
        self.children: list[dict[int, int]] = [{}]
        self.ends: list[list[int]] = [[]]
        self.allowed = [0]
        for t, term in enumerate(terms):
            node = 0
            for letter in term.letters:
                self.allowed[node] = max(self.allowed[node], term.edits)
                if number[letter] not in self.children[node]:
                    self.children[node][number[letter]] = len(self.children)
                    self.children.append({})
                    self.ends.append([])
                    self.allowed.append(0)
                node = self.children[node][number[letter]]
            self.allowed[node] = max(self.allowed[node], term.edits)
            self.ends[node].append(t)


class TooManyStates(ValueError):
    """The terms' automaton has more states than allowed."""


class Automaton:
    """``table[state, class]`` is the next state, ``found[state]`` what a word that ends there is:
    3 * term + edits, or -1. State 0 is dead, state 1 the start."""

    def __init__(self, terms: list[Term], most: int = 1 << 30) -> None:
        self.terms = terms
        self.alphabet = "".join(sorted({c for t in terms for c in t.letters}))
        number = {c: i for i, c in enumerate(self.alphabet, OTHER + 1)}
        self._trie = Trie(terms, number)
        width = len(self.alphabet) + 2
        start = self._close({(0, -1, -1): 0}) if terms else frozenset()
        states = {frozenset(): DEAD}
        order = [frozenset()]
        if start:
            states[start] = 1
            order.append(start)
        rows: list[np.ndarray] = [np.zeros(width, dtype=np.int32)]
        at = 1
        while at < len(order):
            items = order[at]
            if len(order) > most:
                raise TooManyStates(f"more than {most} states")

            def number_of(target: frozenset) -> int:
                if target not in states:
                    states[target] = len(order)
                    order.append(target)
                return states[target]

            row = np.full(width, number_of(self._step(items, OTHER)), dtype=np.int32)
            for letter in self._letters(items):
                row[letter] = number_of(self._step(items, letter))
            row[BETWEEN] = DEAD
            rows.append(row)
            at += 1
        self.table = np.stack(rows)
        self.found = np.array([self._outcome(s) for s in order], dtype=np.int32)
        #: States that no further letter changes.
        self.settled = (self.table[:, 1:] == np.arange(len(order))[:, None]).all(axis=1)
        del self._trie

    # Items of a state: (node, -1, -1), or (node, letter, -1) while an exchanged pair still wants its second
    # letter, or (-1, -1, term) for a stem that has been read; each with the least number of edits.

    def _close(self, items: dict[tuple, int]) -> frozenset:
        """Add what letters left out by the word lead to, and stems that are complete."""
        trie, todo = self._trie, list(items.items())
        best = dict(items)

        def offer(item: tuple, edits: int) -> None:
            if edits < best.get(item, 99):
                best[item] = edits
                todo.append((item, edits))

        while todo:
            (node, letter, term), edits = todo.pop()
            if term >= 0 or letter >= 0 or best[(node, letter, term)] < edits:
                continue
            for t in trie.ends[node]:
                if not self.terms[t].whole and edits <= self.terms[t].edits:
                    offer((-1, -1, t), edits)
            for child in trie.children[node].values():
                if edits < trie.allowed[child]:
                    offer((child, -1, -1), edits + 1)
        return frozenset((item, edits) for item, edits in best.items())

    def _letters(self, items: frozenset) -> set[int]:
        """Letters on which a state's step differs from that on any other letter."""
        trie, out = self._trie, set()
        for (node, letter, term), _ in items:
            if letter >= 0:
                out.add(letter)
            elif term < 0:
                out.update(trie.children[node])
                for child in trie.children[node].values():
                    out.update(trie.children[child])
        return out

    def _step(self, items: frozenset, read: int) -> frozenset:
        trie, best = self._trie, {}

        def offer(item: tuple, edits: int) -> None:
            if edits < best.get(item, 99):
                best[item] = edits

        for (node, letter, term), edits in items:
            if term >= 0:
                offer((-1, -1, term), edits)
                continue
            if letter >= 0:
                if read == letter:
                    offer((node, -1, -1), edits)
                continue
            if edits < trie.allowed[node]:
                offer((node, -1, -1), edits + 1)  # a letter added
            for label, child in trie.children[node].items():
                if label == read:
                    offer((child, -1, -1), edits)
                elif edits < trie.allowed[child]:
                    offer((child, -1, -1), edits + 1)  # a letter changed
                    after = trie.children[child].get(read)
                    if after is not None and edits < trie.allowed[after]:
                        offer((after, label, -1), edits + 1)  # two letters exchanged
        return self._close(best) if best else frozenset()

    def _outcome(self, items: frozenset) -> int:
        trie, hits = self._trie, []
        for (node, letter, term), edits in items:
            if term >= 0:
                hits.append((edits, term))
            elif letter < 0:
                hits += [(edits, t) for t in trie.ends[node] if self.terms[t].whole and edits <= self.terms[t].edits]
        if not hits:
            return -1
        edits, term = min(hits)
        return 3 * term + edits

    def match(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(begin, end, outcome) of each word of the text; words are runs of letters, digits and marks."""
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        classes = character_classes(self.alphabet)[points]
        inside = np.zeros(len(classes) + 2, dtype=np.int8)
        inside[1:-1] = classes > BETWEEN
        edge = np.diff(inside)
        begins, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        state = np.full(len(begins), 1 if len(self.table) > 1 else DEAD, dtype=np.int32)
        left, k = np.arange(len(begins)), 0
        lengths = ends - begins
        while len(left):
            left = left[lengths[left] > k]
            now = self.table[state[left], classes[begins[left] + k]]
            state[left] = now
            left = left[~self.settled[now]]
            k += 1
        return begins, ends, self.found[state]
