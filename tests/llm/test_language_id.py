from __future__ import annotations

import random
import zlib

import numpy as np

from tripspark.llm import language_id as op

LANGS = {"aa": ["foo", "bar", "baz", "qux", "foobar"], "bb": ["élan", "çava", "être", "déjà"], "cc": ["漢字", "かな", "日本"]}


def text(lang, n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(LANGS[lang]) for _ in range(n))


def greedy(s, train):
    """Phrases of s by the longest match anywhere in the training texts, a byte at least."""
    s, train, n, at = bytes(s), [bytes(t) for t in train], 0, 0
    while at < len(s):
        k = 1
        while at + k <= len(s) and any(s[at:at + k] in t for t in train):
            k += 1
        at += max(1, k - 1)
        n += 1
    return n


def test_phrases_match_greedy_brute_force():
    for seed in range(5):
        train = [op.symbols(text(l, 30, seed)) for l in ("aa", "bb")]
        model = op.Model({"x": [text(l, 30, seed) for l in ("aa", "bb")]})
        for t in (text("aa", 20, seed + 50), text("cc", 10, seed), "zzz foo zzz", "", "Q", text("bb", 15, seed) + " 12!"):
            s = op.symbols(t)[:op.LANE]
            assert op._count([t[:len(t)]], model)[0, 0] == greedy(s, train) or len(op.symbols(t)) > op.LANE


def test_lanes_add_up_over_long_texts():
    model = op.Model({"x": [text("aa", 50, 1)]})
    long = text("aa", 5000, 2)
    s = op.symbols(long)
    parts = sum(greedy(s[i:i + op.LANE], [op.symbols(text("aa", 50, 1))]) for i in range(0, len(s), op.LANE))
    assert op._count([long, "", long], model)[:, 0].tolist() == [parts, 0, parts]


def rows(n=120):
    out = [(i, text(lang, 5 + i % 40, i), lang) for i in range(n) for lang in [sorted(LANGS)[i % 3]]]
    return out + [(900, None, "aa"), (901, "", "bb"), (902, "12 !? \n", "cc"), (903, "foo bar", None), (903, "foo bar", None),
                  (None, "déjà", "bb"), (904, "foo " * 30_000, "aa")]


def test_predictions_and_cases(spark):
    df = spark.createDataFrame(rows(), "doc_id long, text string, lang string").repartition(3)
    model = op.fit(df)
    assert model.languages == ["aa", "bb", "cc"]
    out = {(r["doc_id"]): (r["lang_pred"], r["score"]) for r in op.identify(df, model).collect()}
    assert all(out[i][0] == lang for i, _, lang in rows()[:120])
    assert out[900] == out[901] == out[902] == ("und", 0.0)
    assert out[903][0] == out[904][0] == "aa" and out[None][0] == "bb"
    assert all(0 <= s <= 1 for _, s in out.values())
    held = [t for i, t, _ in rows() if i is not None and t and zlib.crc32(str(i).encode()) % 4 == 2]
    assert held and not any(p in model.pieces[k] for k in model.languages for p in [t[:op.TRAIN_CHARS] for t in held if len(t) > 150])


def test_no_language_to_learn_and_empty_table(spark, empty_docs):
    df = spark.createDataFrame([(1, "foo", None)], "doc_id long, text string, lang string")
    assert [tuple(r) for r in op.identify(df, op.fit(df)).collect()] == [(1, "und", 0.0)]
    assert op.identify(empty_docs, op.fit(empty_docs)).count() == 0
    one = spark.createDataFrame([(i, "foo", "aa") for i in range(8)], "doc_id long, text string, lang string")
    assert {tuple(r)[1:] for r in op.identify(one, op.fit(one)).collect()} == {("aa", 1.0)}


def test_held_out_accuracy(spark, sf_docs):
    from pyspark.sql import functions as F

    from tripspark.llm.common import held_out

    out = op.identify(sf_docs, op.fit(sf_docs), ("doc_id", "lang"))
    found = out.filter(held_out(F.col("doc_id")) & (F.col("lang_pred") != "und")).collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in found]) >= 0.95
