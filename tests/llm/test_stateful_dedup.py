from __future__ import annotations

import hashlib
import re
from collections import defaultdict

from pyspark.sql import functions as F

from tripspark.llm import stateful_dedup as op


def norm(text):
    return re.sub("[\x20\x09-\x0d]+", " ", text or "")


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[norm(t)].append(i)
    out = []
    for i, t in rows:
        ids = groups[norm(t)]
        keep = min((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256(norm(t).encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], bytes(r["digest"]).hex())
                   for r in df.collect()), key=str)


def rows(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_small_corpus_matches_brute_force(docs):
    assert got(op.stateful_dedup(docs)) == brute(rows(docs))


def test_table_matches_brute_force(sf_docs):
    assert got(op.stateful_dedup(sf_docs)) == brute(rows(sf_docs))


def test_empty_table(empty_docs):
    assert op.stateful_dedup(empty_docs).count() == 0
    assert op.dedup_documents(empty_docs).columns == empty_docs.columns


def test_documents_kept_once_with_all_columns(docs):
    kept = op.dedup_documents(docs)
    assert kept.columns == docs.columns
    found = rows(kept)
    assert len({norm(t) for _, t in rows(docs)}) == len({norm(t) for _, t in found}) == len(found)
    ids = {}
    for i, t in rows(docs):
        ids.setdefault(norm(t), []).append(i)
    assert dict((norm(t), i) for i, t in found) == {t: min((i for i in x if i is not None), default=None)
                                                    for t, x in ids.items()}


def test_state_carries_over_between_runs(spark, tmp_path):
    """A second run with the same checkpoint continues from the state on disk."""
    first = spark.createDataFrame([(5, "a b"), (7, "c"), (9, "a  b")], "doc_id long, text string")
    second = spark.createDataFrame([(2, "a\nb"), (8, "d")], "doc_id long, text string")
    folder, ckpt = str(tmp_path / "in"), str(tmp_path / "state")
    for part, want in ((first, {(5, 2), (7, 1)}), (second, {(2, 3), (7, 1), (8, 1)})):
        slim = op.digest_rows(part)
        slim.write.mode("append").parquet(folder)
        state = op.stream_state(spark.readStream.schema(slim.schema).parquet(folder), ckpt)
        assert {(r["keep_id"], r["group_size"]) for r in state.collect()} == want


def test_colliding_digests_are_told_apart_by_the_full_text(docs, monkeypatch):
    real = F.sha2
    monkeypatch.setattr(op.F, "sha2", lambda c, n: F.substring(real(c, n), 1, 2))
    found = [(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in op.stateful_dedup(docs).collect()]
    monkeypatch.undo()
    assert sorted(found, key=str) == sorted((x[:4] for x in brute(rows(docs))), key=str)


def test_plan_is_native(docs):
    plan = op.stateful_dedup(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
