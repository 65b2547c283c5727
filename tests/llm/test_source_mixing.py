from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest

from tripspark.llm import source_mixing as op


def size(text):
    return len(re.findall("[^\x20\x09-\x0d]+", text or ""))


def brute_targets(sizes):
    """Share out, cut at the limits, share the excess by weight, until nothing is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, free, left = dict.fromkeys(order, 0.0), set(order), 1.5 * sum(sizes.values())
    while free and left > 1e-9:
        w = sum(weight[s] for s in free)
        for s in free:
            target[s] += left * weight[s] / w
        left = 0.0
        for s in list(free):
            if target[s] >= 2 * sizes[s]:
                left += target[s] - 2 * sizes[s]
                target[s] = 2.0 * sizes[s]
                free.discard(s)
    return target


def check(df, rows):
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += size(t)
    want, taken = brute_targets(sizes), Counter()
    found = op.assign(df).collect()
    assert len(found) == len(rows)
    for r in found:
        assert r["size"] == size(r["text"]) and r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        assert len(r["draws"]) <= 2
        taken[r["source"]] += r["size"] * len(r["draws"])
    for s, t in want.items():
        longest = max((size(x) for _, x, y in rows if y == s), default=0)
        assert abs(taken[s] - t) <= longest
    return found


def rows(df):
    return [(r["doc_id"], r["text"], r["source"]) for r in df.select("doc_id", "text", "source").collect()]


def test_targets_sizes_and_draws(docs):
    check(docs, rows(docs))


def test_table(sf_docs):
    found = check(sf_docs, rows(sf_docs))
    again = {(r["doc_id"], str(r["draws"])) for r in op.assign(sf_docs.repartition(7)).collect()}
    assert again == {(r["doc_id"], str(r["draws"])) for r in found}


def test_mix_holds_each_row_as_often_as_it_is_drawn(docs, monkeypatch):
    monkeypatch.setattr(op, "SHARD_WORDS", 1000)
    drawn = Counter()
    for r in op.assign(docs).collect():
        drawn[(r["doc_id"], r["text"])] += len(r["draws"])
    mixed = op.mix(docs)
    assert mixed.columns == docs.columns
    assert Counter((r["doc_id"], r["text"]) for r in mixed.collect()) == +drawn
    assert len({d["shard"] for r in op.assign(docs).collect() for d in r["draws"]}) > 1


def test_leaves_add_up_to_the_quotas_and_are_disjoint():
    quotas = np.array([1000, 0, 1, 37, 5000])
    parts = [op.leaf(quotas, 4, s) for s in range(16)]
    assert (sum(m for m, _ in parts) == quotas).all()
    assert all((parts[i][1] + parts[i][0] == parts[i + 1][1]).all() for i in range(15))
    totals = [m.sum() for m, _ in parts]
    assert max(totals) - min(totals) <= 4
    # within a shard, a source's share follows its share of all blocks
    assert np.std([m[4] for m, _ in parts]) < 40


def test_one_source_no_words_and_empty_table(spark, empty_docs):
    assert op.assign(empty_docs).count() == 0 and op.mix(empty_docs).count() == 0
    df = spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert sorted((r["doc_id"], r["size"], r["target"]) for r in op.assign(df).collect()) == [(1, 0, 0.0), (2, 0, 0.0)]
    one = spark.createDataFrame([(i, "w " * 10, "a") for i in range(100)], "doc_id long, text string, source string")
    assert abs(sum(r["size"] * len(r["draws"]) for r in op.assign(one).collect()) - 1500) <= 10
