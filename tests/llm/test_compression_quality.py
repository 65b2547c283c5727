from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from tripspark.llm import compression_quality as op
from tripspark.llm.common import held_out

from tests.llm.conftest import words


def labelled(n=400):
    r, out = random.Random(1), []
    for i in range(n):
        w = words(i, 60)
        good = i % 3 > 0
        out.append((i, " ".join(w) if good else "!! ".join(w[:20]).upper() + " $$$ " * r.randint(1, 9), int(good)))
    return out


def frames(spark, rows):
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    return docs, spark.createDataFrame([(i, q, 0) for i, _, q in rows], "doc_id long, quality int, toxic int")


def test_held_out_rows_are_told_apart(spark):
    docs, labels = frames(spark, labelled())
    out = op.score_quality(docs, op.fit(docs, labels)).join(labels, "doc_id").filter(held_out(F.col("doc_id"))).collect()
    assert len(out) > 60 and np.mean([r["predicted"] == r["quality"] for r in out]) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in out)


def test_held_out_labels_are_not_learned_from(spark):
    docs, labels = frames(spark, labelled())
    turned = labels.withColumn("quality", F.when(held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = op.fit(docs, labels), op.fit(docs, turned)
    assert (a.good, a.bad, a.weight, a.bias) == (b.good, b.bad, b.weight, b.bias)


def test_odd_labels_and_texts(spark, docs):
    rows = labelled(120)
    d, labels = frames(spark, rows)
    labels = labels.union(spark.createDataFrame([(0, 0, 0), (None, 1, 0), (3, None, 0), (7, 9, 0), (10**6, 1, 0)], labels.schema))
    model = op.fit(d, labels)
    out = op.score_quality(docs, model)
    assert out.columns == [*docs.columns, "score", "predicted"] and out.count() == docs.count()
    blank = {r["score"] for r in out.filter("text IS NULL OR text = ''").collect()}
    assert blank == {model.score(0.0)}


def test_without_both_classes_all_scores_are_the_share(spark, empty_docs):
    docs, labels = frames(spark, [(i, t, 1) for i, t, _ in labelled(40)])
    scores = {round(r["score"], 9) for r in op.score_quality(docs, op.fit(docs, labels)).collect()}
    assert len(scores) == 1 and scores.pop() > 0.9
    none = op.fit(empty_docs, labels.limit(0))
    assert {r["score"] for r in op.score_quality(docs, none).collect()} == {0.5}
    assert op.score_quality(empty_docs, none).count() == 0


def test_long_texts_are_read_to_the_end(spark):
    docs, labels = frames(spark, labelled())
    model = op.fit(docs, labels)
    c = model.compressors()
    good, bad = (" ".join(" ".join(words(i, 60)) for i in range(900, 1000)).encode(), "!! ".join(words(5, 400)).upper().encode())
    assert model.difference(good + b" ", c) > model.difference(good + b" " + bad, c)


def test_table_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    out = op.score_quality(docs, op.fit(docs, labels), ("doc_id",)).join(labels, "doc_id").filter(held_out(F.col("doc_id"))).collect()
    assert np.mean([r["predicted"] == r["quality"] for r in out]) >= 0.9
