from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tripspark.llm import lexical_search as op

_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return _TERM.findall((text or "").translate(_LOWER))


def brute(docs, items, k=20):
    """Scores of all documents for all items, by the formula."""
    texts = [(i, split(t)) for i, t in docs]
    n_all, length = sum(bool(w) for _, w in texts), sum(len(w) for _, w in texts)
    df = Counter(t for _, w in texts for t in set(w))
    out = []
    for item, text in items:
        scores = []
        for i, w in texts:
            if w:
                m, tf = 75 + 25 * len(w) * n_all // length, Counter(w)
                s = sum(math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 12 * m))
                        for t in split(text))
                scores.append((-s, i is None, i or 0))
        ranked = [(-s, None if none else i) for s, none, i in sorted(scores) if s < 0][:k]
        out += [(item, r, i, s) for r, (s, i) in enumerate(ranked, 1)]
    return sorted(out, key=str)


def run(spark, docs, items, **kw):
    return sorted([tuple(r) for r in op.search(docs, spark.createDataFrame(items, "item_id long, text string"), **kw).collect()], key=str)


ITEMS = [(1, "the er on then one two THE one"), (2, "漢字 long word, xx! it's"), (3, None), (4, " .. "), (5, "nosuchterm"),
         (5, "same id again one row"), (None, "and")]


def items_of(docs):
    """Queries made of the documents' own words, long ones too."""
    texts = [r["text"] for r in docs.collect() if r["text"]]
    return ITEMS + [(100 + i, " ".join(t.split()[:40])) for i, t in enumerate(texts[::4])]


def test_fixture_against_brute_force(spark, docs):
    items = items_of(docs)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    for k in (1, 3, 20):
        assert run(spark, docs, items, k=k) == brute(rows, items, k)


def test_small_blocks_and_groups_of_queries(spark, docs, monkeypatch):
    monkeypatch.setattr(op, "QUERY_TERMS", 60)
    items = items_of(docs)
    assert run(spark, docs, items) == brute([(r["doc_id"], r["text"]) for r in docs.collect()], items)


def test_terms_of_long_texts(monkeypatch):
    monkeypatch.setattr(op, "PIECE", 7)
    for text in ("", "a", "  Ab-c4 \x85é_Ωx  zz" * 9, "x" * 50, "\x00q\x7fq", "ends in space "):
        assert [w.decode() for piece in op.terms(text.encode()) for w in piece] == split(text)


def test_empty_tables(spark, docs, empty_docs):
    assert run(spark, empty_docs, ITEMS) == []
    assert run(spark, docs, []) == []
    assert run(spark, docs.filter("text IS NULL"), ITEMS) == []


def test_stops_early_and_whole():
    """Reading stops before the ends of the lists, with the results of a full reading; ties go by id."""
    r = random.Random(4)
    n = 20_000
    shares = [np.array([r.randint(1, 50) for _ in range(n)], dtype=np.int64) for _ in range(4)]
    for s in shares:
        s[:40] += 1000
    lists = [(op.ImpactList(np.arange(n), s), 1 + i % 2) for i, s in enumerate(shares)]
    best = op.Best(20)
    scored = op.best_positions(lists, n, best, list(range(n)))
    total = sum(s * c for (_, c), s in zip(lists, shares, strict=True))
    assert best.rows == sorted(((int(s), i) for i, s in enumerate(total.tolist())), key=lambda x: (-x[0], x[1]))[:20]
    assert scored < 1000
    # equal shares everywhere: an unread document could tie, so that the smallest ids win only if all are read
    same = [(op.ImpactList(np.arange(200), np.ones(200, dtype=np.int64)), 1)]
    best = op.Best(20)
    assert op.best_positions(same, 200, best, list(range(200, 0, -1))) == 200
    assert [i for _, i in best.rows] == list(range(1, 21))


@pytest.mark.parametrize("seed", range(6))
def test_random_lists(seed):
    r = random.Random(seed)
    n, m = r.choice([5, 50, 700]), r.randint(1, 6)
    lists, total = [], Counter()
    for _ in range(m):
        docs = sorted(r.sample(range(n), r.randint(1, n)))
        shares = np.array([r.randint(1, r.choice([3, 1000])) for _ in docs], dtype=np.int64)
        lists.append((op.ImpactList(np.array(docs), shares), r.randint(1, 3)))
        for d, s in zip(docs, shares.tolist(), strict=True):
            total[d] += s * lists[-1][1]
    best = op.Best(4)
    op.best_positions(lists, n, best, list(range(n)), first=r.choice([1, 2, 32]))
    assert best.rows == sorted(((s, d) for d, s in total.items()), key=lambda x: (-x[0], x[1]))[:4]
