from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import words
from tripspark.llm import toxicity as op

INSULTS = ["blockhead", "nitwit", "scoundrel"]


def labelled(n=600):
    """Every third row holds insults; a stem with any ending in some; clean rows quote one of the words."""
    r, out = random.Random(1), []
    for i in range(n):
        w, toxic = words(i, r.randint(5, 60)), i % 3 == 0
        if toxic:
            for _ in range(r.randint(1, 3)):
                bad = r.choice(INSULTS) if i % 2 else "vermi" + r.choice(["nous", "nation", "lot", "xor", "tas"])
                w.insert(r.randrange(len(w)), bad)
        elif i % 3 == 1 and i % 2:
            w.insert(r.randrange(len(w)), f'author wrote "{r.choice(INSULTS)}" once')
        out.append((i, " ".join(w), int(toxic)))
    return out


def frames(spark, rows):
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    return docs, spark.createDataFrame([(i, 0, q) for i, _, q in rows], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def fitted(spark):
    docs, labels = frames(spark, labelled())
    return docs, labels, op.fit(docs, labels)


def test_held_out_rows_are_told_apart(fitted):
    docs, labels, model = fitted
    out = op.score_toxicity(docs, model).join(labels, "doc_id").filter(op.held_out(F.col("doc_id"))).collect()
    assert len(out) > 150 and np.mean([r["predicted"] == r["toxic"] for r in out]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in out)


def test_lexicon_is_learned(fitted):
    terms = {t.letters: t for t in fitted[2].automaton.terms}
    assert set(INSULTS) <= set(terms) and terms["blockhead"].edits == 2
    assert not terms["vermi"].whole


def test_misspelling_quotation_and_context(fitted):
    model = fitted[2]
    plain, base = " ".join(words(3, 20)), None

    def score(text):
        return model.score(model.features(text))

    base = score(plain)
    said = score(f"{plain} blockhead scoundrel {plain}")
    misspelled = score(f"{plain} blokhead scuondrel {plain}")
    quoted = score(f'{plain} author wrote "blockhead" once {plain}')
    assert base < 0.3 and said > 0.7 and base < misspelled <= said and quoted < said
    assert model.quoted < 0
    assert score(f"{plain} vermination vermilot {plain}") > 0.7


def test_long_texts_are_read_to_the_end(fitted, monkeypatch):
    monkeypatch.setattr(op, "PIECE", 1000)
    model, plain = fitted[2], " ".join(words(5, 2000))
    a, b = model.features(plain), model.features(plain + " you blockhead")
    assert b[0] > a[0] and b[2] > a[2]
    assert "".join(op.pieces(plain)) == plain and len(list(op.pieces(plain))) > 5
    assert len(list(op.pieces("x" * 5000))) == 1


def test_held_out_labels_are_not_learned_from(spark, fitted):
    docs, labels, model = fitted
    turned = labels.withColumn("toxic", F.when(op.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    other = op.fit(docs, turned)
    assert other.automaton.terms == model.automaton.terms and other.curve == model.curve
    assert (other.weights == model.weights).all()


def test_odd_labels_and_texts(spark, docs):
    d, labels = frames(spark, labelled(240))
    odd = spark.createDataFrame([(0, 0, 0), (None, 1, 1), (3, None, None), (7, 9, 9), (10**6, 1, 1)], labels.schema)
    model = op.fit(d.union(d.limit(3)).withColumn("toxic", F.lit("clash")), labels.union(odd))
    out = op.score_toxicity(docs, model)
    assert out.columns == [*docs.columns, "score", "predicted"] and out.count() == docs.count()
    assert {r["score"] for r in out.filter("text IS NULL OR text = ''").collect()} == {model.score((0.0, 0.0, 0.0))}


def test_without_both_classes_all_scores_are_the_share(spark, empty_docs):
    docs, labels = frames(spark, [(i, t, 1) for i, t, _ in labelled(40)])
    scores = {round(r["score"], 9) for r in op.score_toxicity(docs, op.fit(docs, labels)).collect()}
    assert len(scores) == 1 and scores.pop() > 0.9
    none = op.fit(empty_docs, labels.limit(0))
    assert {r["score"] for r in op.score_toxicity(docs, none).collect()} == {0.5}
    assert op.score_toxicity(empty_docs, none).count() == 0


def test_automaton_stays_within_its_bound():
    r = random.Random(2)
    terms = [op.Term("".join(r.choice("abcdefgh") for _ in range(9)), True, 2) for _ in range(12)]
    automaton = op.build(terms, 2000)
    assert len(automaton.table) <= 2001 and [t.letters for t in automaton.terms] == [t.letters for t in terms]
    assert {t.edits for t in automaton.terms} <= {0, 1}


def test_table_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    out = op.score_toxicity(docs, op.fit(docs, labels), ("doc_id",)).join(labels, "doc_id").filter(op.held_out(F.col("doc_id"))).collect()
    toxic = [r["predicted"] for r in out if r["toxic"] == 1]
    clean = [r["predicted"] for r in out if r["toxic"] == 0]
    assert np.mean(toxic) >= 0.85 and np.mean(clean) <= 0.02
