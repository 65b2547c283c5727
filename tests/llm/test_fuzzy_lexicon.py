"""The lexicon's automaton against edit distances computed by their recurrence."""

from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tripspark.llm.fuzzy_lexicon import Automaton, Term, TooManyStates, fold


def distance(a: str, b: str) -> int:
    """Edits between two words: a letter added, left out or changed, or neighbours exchanged."""
    d = {(i, -1): i + 1 for i in range(-1, len(a))} | {(-1, j): j + 1 for j in range(-1, len(b))}
    for i in range(len(a)):
        for j in range(len(b)):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i] != b[j]))
            if i and j and a[i] == b[j - 1] and a[i - 1] == b[j]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a) - 1, len(b) - 1]


def brute(terms: list[Term], word: str) -> int:
    found = []
    for t, term in enumerate(terms):
        edits = distance(word, term.letters) if term.whole else \
            min(distance(word[:n], term.letters) for n in range(len(word) + 1))
        if edits <= term.edits:
            found.append((edits, t))
    return 3 * min(found)[1] + min(found)[0] if found else -1


TERMS = [Term("idiot", True, 1), Term("disgusting", True, 2), Term("abab", True, 1), Term("lowei", False, 0),
         Term("lostra", False, 1), Term("aba", True, 0), Term("stupid", True, 1), Term("patheticus", False, 2),
         Term("réêou", True, 1)]


def outcomes(automaton: Automaton, words: list[str]) -> list[int]:
    begins, ends, found = automaton.match(" ".join(words))
    assert len(begins) == len(words)
    return found.tolist()


def test_misspelled_terms():
    r, words = random.Random(1), []
    for term in TERMS:
        for _ in range(200):
            w = list(term.letters + ("" if term.whole else r.choice(["", "x", "schaft"])))
            for _ in range(r.randint(0, 3)):
                i, k = r.randrange(len(w) + 1), r.randrange(4)
                if k == 0:
                    w[i:i + 1] = []
                elif k == 1:
                    w.insert(i, r.choice("abidotx0é"))
                elif k == 2:
                    w[i:i + 1] = [r.choice("abidotx0é")]
                else:
                    w[i:i + 2] = w[i:i + 2][::-1]
            if w:
                words.append("".join(w))
    automaton = Automaton(TERMS)
    expected = [brute(TERMS, w) for w in words]
    assert sum(e >= 0 for e in expected) > 500
    assert outcomes(automaton, words) == expected
    assert outcomes(automaton, [w.upper() for w in words]) == expected


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.text("abc", min_size=1, max_size=5), st.booleans(), st.integers(0, 2)), min_size=1, max_size=4),
       st.lists(st.text("abcx", min_size=1, max_size=7), min_size=1, max_size=20))
def test_any_lexicon(terms, words):
    terms = [Term(*t) for t in terms]
    assert outcomes(Automaton(terms), words) == [brute(terms, w) for w in words]


def test_no_terms_and_odd_texts():
    assert outcomes(Automaton([]), ["some", "words"]) == [-1, -1]
    automaton = Automaton(TERMS)
    for text in ("", " \n", "!!??", "\ud800 x"):
        assert (automaton.match(text)[2] == -1).all()
    begins, ends, found = automaton.match("An IDIOT, an_idiott! é")
    assert [("An IDIOT, an_idiott! é")[b:e] for b, e in zip(begins, ends)] == ["An", "IDIOT", "an", "idiott", "é"]
    assert found.tolist() == [-1, 0, -1, 1, -1]
    assert fold("İX ẞ") == "ix ß" and len(fold("İX")) == 2


def test_bound_on_states():
    with pytest.raises(TooManyStates):
        Automaton(TERMS, 100)
