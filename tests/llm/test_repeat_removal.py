from __future__ import annotations

import random

import numpy as np
import pytest

from tripspark.llm import repeat_removal as op
from tripspark.llm.run_length_index import RunLengthIndex

SCHEMA = "doc_id long, text string, mark long, spans int, row string"


def brute_statistics(strings):
    """Longest match of every suffix that begins elsewhere, borders last in each string (0)."""
    out = []
    for i, s in enumerate(strings):
        for p in range(len(s)):
            best = 0
            for j, t in enumerate(strings):
                for q in range(len(t)):
                    if (i, p) != (j, q):
                        k = 0
                        while p + k < len(s) and q + k < len(t) and s[p + k] == t[q + k]:
                            k += 1
                        best = max(best, k)
            out.append(best)
        out.append(0)
    return out


@pytest.mark.parametrize("seed", range(12))
def test_matching_statistics_match_brute_force(seed):
    r = random.Random(seed)
    base = bytes(r.choice(b"ab\x00\xff") for _ in range(40))
    strings = [base[r.randrange(20):r.randrange(20, 41)] * r.randint(1, 2) + bytes(r.choice(b"abc") for _ in range(r.randint(0, 9)))
               for _ in range(6)] + [b"", b"a", base]
    index = RunLengthIndex(strings)
    found = index.matching_statistics()
    want = brute_statistics(strings)
    assert found[:len(want)].tolist() == want
    assert index.runs <= index.size


def test_repetitive_strings_have_few_runs():
    r = random.Random(1)
    base = bytes(r.choice(b"abcdefgh") for _ in range(500))
    copies = [base[:i] + b"x" + base[i:] for i in range(0, 500, 10)]
    index = RunLengthIndex(copies)
    assert index.runs < index.size / 10 and len(index.heads[0]) == index.runs


def covered(texts):
    """Removed flags of each text's bytes: windows found twice anywhere, by brute force."""
    seen = {}
    for i, t in enumerate(texts):
        for p in range(len(t) - op.WINDOW + 1):
            seen.setdefault(t[p:p + op.WINDOW], []).append((i, p))
    flags = [np.zeros(len(t), dtype=bool) for t in texts]
    for places in seen.values():
        if len(places) > 1:
            for i, p in places:
                flags[i][p:p + op.WINDOW] = True
    return flags


def brute(rows):
    texts = [(t or "").encode() for _, t in rows]
    out = []
    for (d, _), t, f in zip(rows, texts, covered(texts)):
        edges = np.flatnonzero(np.diff(np.concatenate([[0], f, [0]]))).tolist()
        out.append((d, len(t), list(zip(edges[::2], edges[1::2])), bytes(np.frombuffer(t, np.uint8)[~f])))
    return sorted(out, key=str)


def got(df):
    return sorted(((r["doc_id"], r["n_bytes"], [(s["begin"], s["end"]) for s in r["spans"]], bytes(r["kept"]))
                   for r in df.collect()), key=str)


def rows(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def made(spark, data):
    return spark.createDataFrame([(d, t, 1, 2, "x") for d, t in data], SCHEMA).repartition(4)


def noise(r, n, letters="abcdefghij é"):
    return "".join(r.choice(letters) for _ in range(n))


def planted(count=60):
    """Texts that share passages of lengths around the window, at odd places, with edits, periods and copies."""
    r = random.Random(7)
    passages = [noise(r, n, "abcdefghij ") for n in (198, 199, 200, 201, 215, 260, 400, 900)]
    data = []
    for i in range(count):
        parts = [noise(r, r.randint(0, 300))]
        for p in r.sample(passages, r.randint(0, 3)):
            if r.random() < 0.4:
                at = r.randrange(len(p))
                p = p[:at] + "X" + p[at + 1:]
            parts += [p, noise(r, r.randint(0, 60))]
        data.append((i, "".join(parts)))
    data += [(100, "z" * 700), (101, "z" * 199), (102, "z" * 100 + "y" + "z" * 250), (103, "ab" * 300), (104, "ab" * 150),
             (105, None), (106, ""), (107, data[3][1]), (107, data[3][1]), (None, data[4][1]), (108, passages[7] + passages[7]),
             (109, noise(r, 20_000) + passages[5]), (110, "é" * 99 + "x"), (111, "é" * 99 + "x"), (112, "é" * 100), (113, "é" * 100)]
    return data


def test_planted_repeats_match_brute_force(spark):
    assert got(op.remove_repeats(made(spark, planted()))) == brute(planted())


def test_small_corpus_matches_brute_force(docs):
    assert got(op.remove_repeats(docs)) == brute(rows(docs))


def test_hot_minimizers_are_dealt_again(spark, monkeypatch):
    """With tiny limits, passages' edges go to offset ranges and then to single windows."""
    from tripspark.llm import run_length_index

    monkeypatch.setattr(op, "HOT", 3)
    data = planted(40)
    df = made(spark, data)
    cut = []
    real = op.materialize
    monkeypatch.setattr(op, "materialize", lambda d, kind: cut.append(kind) or real(d, kind))
    assert got(op.remove_repeats(df)) == brute(data)
    assert "repeats-windows" in cut and run_length_index


def test_ranges_too_many_to_broadcast_are_joined(spark, monkeypatch):
    monkeypatch.setattr(op, "BROADCAST_RANGES", 0)
    data = planted(30)
    assert got(op.remove_repeats(made(spark, data))) == brute(data)


def test_segments_cover_every_window_once():
    r = np.random.default_rng(1)
    texts = [r.integers(97, 101, n).astype(np.uint8) for n in (0, 5, 199, 200, 201, 1000, 4000)]
    raw, offsets = np.concatenate(texts), np.cumsum([0, *map(len, texts)])
    own, _, _, first, count, distance = op.segments(raw, offsets)
    for i, t in enumerate(texts):
        windows = [w for o, f, c in zip(own, first, count) if o == i for w in range(f, f + c)]
        assert windows == list(range(max(0, len(t) - op.WINDOW + 1)))
    assert (count <= op.SPAN).all() and (distance >= 0).all() and (distance < op.SPAN).all()


def test_empty_table(empty_docs):
    assert op.remove_repeats(empty_docs).count() == 0
