from __future__ import annotations

import re
from collections import Counter
from fractions import Fraction
from itertools import permutations

from tripspark.llm import filter_audit as op

LABELS = "doc_id bigint, quality int, toxic int"


def brute(docs, labels):
    """The filters applied one after the other in every order."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    least: dict[str, int] = {}
    for i, text, _ in docs:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    rows = []
    for i, text, lang in docs:
        text = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w),
                 "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text), "D": re.search(r"[#$%&*|]", text) is not None,
                 "E": i is not None and i > least[text]}
        rows.append((lang or "", {f for f, bad in fails.items() if bad}, i in good, i in toxic))
    out, shares = [], Counter()
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                earlier = [r for r in mine if f in r[1] and r[1] & set(order[:step - 1])]
                left = [r for r in left if f not in r[1]]
                shares[part, f] += len(gone)
                out.append((part, "".join(order), step, len(left), len(gone), len(earlier), sum(r[1] == {f} for r in mine),
                            sum(r[2] for r in gone), sum(r[3] for r in gone), f))
    return Counter((*r[:-1], shares[r[0], r[-1]]) for r in out)


def test_fixture_against_brute_force(spark, docs):
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in docs.collect()]
    marks = [(i, i % 2, i % 3 % 2) for i in range(60)] + [(3, 1, None), (None, 1, 1), (500, None, 1), (10**6, 1, 1), (4, 7, 9)]
    more = [(700, "w " * 300, "en"), (701, "w " * 300, "en"), (702, "A B|C " * 80, "fr"), (702, "A B|C " * 80, "fr"),
            (699, "A B|C " * 80, ""), (None, "A B|C " * 80, "fr"), (None, None, None)]
    extra = spark.createDataFrame([(*m, None, None, None, "s", 1) for m in more], docs.schema)
    out = op.audit(docs.unionByName(extra), spark.createDataFrame(marks, LABELS).withColumn("text", op.F.lit("clash")))
    assert Counter(tuple(r) for r in out.collect()) == brute(rows + more, marks)


def test_empty_tables(spark, docs, empty_docs):
    none = spark.createDataFrame([], LABELS)
    assert op.audit(empty_docs, none).count() == 0
    out = op.audit(docs, none)
    parts = {r["lang"] or "" for r in docs.collect()}
    assert out.count() == 600 * len(parts) and out.filter("good_lost + toxic_lost > 0").count() == 0


def test_least_squares_gives_shapley_values():
    """Against the mean over all orders, for games that are no covers as well."""
    for n, value in ((2, [0, 5, 7, 3]), (3, [0, 1, 4, 4, 9, 2, 2, 11]), (4, [i * i % 17 if i else 0 for i in range(16)])):
        game = dict(enumerate(value))
        mean = [Fraction(0)] * n
        orders = list(permutations(range(n)))
        for order in orders:
            s = 0
            for i in order:
                mean[i] += Fraction(game[s | 1 << i] - game[s], len(orders))
                s |= 1 << i
        assert op.shapley(game, n) == mean
