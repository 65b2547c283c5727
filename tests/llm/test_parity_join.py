from __future__ import annotations

import re

import numpy as np

from tripspark.llm import parity_join as op
from tripspark.llm.components import connected_components


def shingles(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall("[^\x20\x09-\x0d]+", low)
    return frozenset([tuple(w)] if 0 < len(w) < 5 else [tuple(w[i:i + 5]) for i in range(len(w) - 4)])


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, len(sets[i]), least.get(find(i))) for i, (d, _) in enumerate(rows)), key=str)


def rows(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect()), key=str)


def test_small_corpus_matches_brute_force(docs):
    assert got(op.jaccard_components(docs)) == brute(rows(docs))


def test_table_matches_brute_force(sf_docs):
    assert got(op.jaccard_components(sf_docs)) == brute(rows(sf_docs))


def test_group_with_links_that_no_centre_has(spark):
    """Chained edits: neighbours link, ends don't; every member shares passages with all others."""
    base = [f"w{i}" for i in range(300)]
    data = []
    for i in range(40):
        v = list(base)
        for k in range(i):
            v[(7 * k) % 300] = f"e{k}"
        data.append((100 - i, " ".join(v)))
    df = spark.createDataFrame(data, "doc_id long, text string")
    assert got(op.jaccard_components(df)) == brute(data)


def test_rows_of_a_large_key_meet_one_centre_a_round():
    """300 rows that may all link: a pair a row in a round, all pairs in the last one; a pair is found if there is one."""
    r = np.random.default_rng(0)
    sketch = r.integers(0, 2**63, 8).astype(np.uint64)
    held = [(100 + i % 3, 0, i, i, sketch) for i in range(300)]
    held.sort(key=lambda h: h[0])
    count = lambda rows, attempt: sum(len(a) for a, _ in op._compared((1, 0, 0), rows, attempt))
    assert 0 < count(held, 0) < 300 and count(held, None) == 300 * 299 // 2
    apart = [(100, 0, i, i, sketch if i in (7, 211) else r.integers(0, 2**63, 8).astype(np.uint64)) for i in range(300)]
    for attempt in (0, 1, 2):
        [(a, b)] = op._compared((1, 0, 0), apart, attempt)
        assert {a[0], b[0]} == {7, 211} and len(a) == 1
    joined = [(n, t, i, 5, s) for n, t, i, _, s in held]
    assert count(joined, 0) == 0


def test_keys_that_the_same_rows_share_are_taken_once(spark, monkeypatch):
    words = [[f"w{g}x{k}" for k in range(200)] for g in range(3)]
    data = [(3 * g + c, " ".join([*words[g], *["more"] * c])) for g in range(3) for c in range(3)]
    sizes = {}

    def counted(df, kind, write=op.materialize):
        table = write(df, kind)
        sizes.setdefault(kind, []).append(table.count())
        return table

    monkeypatch.setattr(op, "materialize", counted)
    docs = spark.createDataFrame(data, "doc_id bigint, text string")
    assert got(op.jaccard_components(docs)) == brute(data)
    # Any two or all three rows of a group: four sets of rows at most, which hold nine rows.
    assert 9 <= sizes["jaccard-met"][0] <= 27


def test_rows_meet_under_every_key_they_share(spark):
    keys = [(1, 10), (2, 10), (1, 11), (2, 11), (2, 12), (3, 12), (4, 13), (1, 14), (2, 14), (3, 14)]
    met = op._meetings(spark.createDataFrame(keys, "row bigint, key bigint")).collect()
    groups = {}
    for r in met:
        groups.setdefault((r["key"], r["lo"]), []).append(r["row"])
    assert sorted((lo, *sorted(rows)) for (_, lo), rows in groups.items()) == [(1, 1, 2), (1, 1, 2, 3), (2, 2, 3)]


def passages(seed, groups, shared, own, copies):
    """Documents of passages that many share: each has some of them and words of its own, with near copies."""
    r = np.random.default_rng(seed)
    common = [[f"p{g}x{k}" for k in range(shared)] for g in range(groups)]
    data = []
    for d in range(copies):
        w = [x for g in r.permutation(groups)[:6] for x in common[g]] + [f"d{d}x{k}" for k in range(own)]
        data += [(3 * d, " ".join(w)), (3 * d + 1, " ".join([*w, f"e{d}"]))]
    return data


def test_sample_of_frequent_blocks_grows_with_the_table(spark):
    """A passage that 24 of 320 documents share is frequent, however few rows the least sample has."""
    passage = " ".join(f"p{k}" for k in range(40))
    data = [(d, " ".join(f"d{d}x{k}" for k in range(30)) + (" " + passage if d % 13 == 0 else "")) for d in range(320)]
    found = op.frequent_blocks(spark.createDataFrame(data, "doc_id bigint, text string"), rows=16)
    assert len(found) >= 30


def test_small_and_large_keys_give_the_same_links(spark, monkeypatch):
    data = passages(1, 8, 14, 24, 25) + [(500 + i, " ".join([*(f"c{k}" for k in range(100)), *["z"] * i])) for i in range(30)]
    data += [(None, data[0][1] + " more"), (7, data[5][1]), (7, ""), (8, None)]
    docs = spark.createDataFrame(data, "doc_id bigint, text string").repartition(3)
    monkeypatch.setattr(op, "SMALL_KEY", 3)
    monkeypatch.setattr(op, "frequent_blocks", lambda docs: np.zeros(0, np.uint64))
    assert got(op.jaccard_components(docs)) == brute(data)


def test_links_at_the_limit(spark):
    """Pairs exactly at 0.8 and just below, at sizes around the bands' borders."""
    data, n = [], 0
    for size in (4, 5, 8, 9, 20, 63, 64, 80, 127, 128, 160, 319, 320, 400):
        # an appended run of words adds as many shingles; 100 * size >= 80 * (size + more) at the limit
        for more in (size // 4, size // 4 + 1):
            w = [f"a{size}x{more}x{i}" for i in range(size + 4)]
            data += [(n, " ".join(w)), (n + 1, " ".join(w + [f"z{i}" for i in range(more)]))]
            n += 2
    df = spark.createDataFrame(data, "doc_id long, text string")
    assert got(op.jaccard_components(df)) == brute(data)


def test_sketch_distance_bounds_the_symmetric_difference():
    r = np.random.default_rng(0)
    for n in (1, 7, 64, 200, 1000):
        s = np.sort(r.integers(0, 2**63, n, dtype=np.int64).astype(np.uint64))
        t = np.sort(np.concatenate([s[n // 10:], r.integers(0, 2**63, n // 10, dtype=np.int64).astype(np.uint64)]))
        for x, y in zip(op.block_keys(s), op.block_keys(t)):
            assert len(np.setdiff1d(x, y)) <= len(np.setxor1d(s, t))
            assert len(x) > n // 4


def test_one_document_of_each_component_stays(docs, empty_docs):
    ids = {c if n else d for d, n, c in brute(rows(docs)) if d is not None}
    assert {r["doc_id"] for r in op.one_per_component(docs).collect()} - {None} == ids
    assert op.one_per_component(empty_docs).columns == empty_docs.columns


def kept_as_by_brute_force(data, out):
    """Of each component one row stays, with the smallest id if there is one; rows without words all stay."""
    sets = [shingles(t) for _, t in data]
    root = {s: s for s in sets}

    def find(s):
        while root[s] != s:
            s = root[s]
        return s

    for s in list(root):
        for u in list(root):
            if s and u and 100 * len(s & u) >= 80 * len(s | u):
                root[find(s)] = find(u)
    ids = {}
    for (d, _), s in zip(data, sets):
        ids.setdefault(find(s), []).append(d)
    least = lambda c: min((d is None, d or 0, d) for d in ids[c])[2]
    want = [(c, least(c)) for c in ids if c] + [(frozenset(), d) for d in ids.get(frozenset(), [])]
    assert set(out) <= set(data)
    assert sorted([(find(shingles(t)), d) for d, t in out], key=str) == sorted(want, key=str)


def test_rows_without_or_with_repeated_ids_are_kept_by_their_texts(spark, docs):
    kept_as_by_brute_force(rows(docs), rows(op.one_per_component(docs)))
    text = lambda k, edit="": " ".join(f"t{k}w{i}" for i in range(60)) + edit
    data = [(1, text(1)), (None, text(1, " near")), (None, text(2)), (None, text(3)), (None, text(3, " near")),
            (7, text(4)), (7, text(1, " other")), (8, text(5)), (8, text(5, " near")), (8, text(5, "  near")), (9, text(6)),
            (None, text(7)), (None, text(7)), (None, ""), (None, None), (8, ""), (10, text(6, " x"))]
    df = spark.createDataFrame(data, "doc_id long, text string")
    kept_as_by_brute_force(data, rows(op.one_per_component(df)))


def test_empty_table(empty_docs):
    assert op.jaccard_components(empty_docs).count() == 0


def test_components_of_chains_stars_and_repeats(spark):
    edges = [(i, i + 1) for i in range(1, 200)] + [(1000, i) for i in range(1001, 1100)] + [(5, 5), (7, 6), (7, 6)]
    out = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {(r["node"], r["component"]) for r in out} == {(i, 1) for i in range(1, 201)} | {(i, 1000) for i in range(1000, 1100)}


def test_components_of_a_hub_are_found_without_gathering_it(spark):
    """A node with most of the edges: its least neighbour is combined before the shuffle and joined back."""
    from tripspark.llm import components
    from tripspark.plans import inspect

    edges = spark.range(1, 3000).selectExpr("id AS a", "0L AS b").union(spark.range(5000, 5200).selectExpr("id AS a", "id + 1 AS b"))
    plan = inspect.executed_plan(components._large_star(edges))
    assert "MapInArrow" not in plan and "partial_min" in plan
    found = {r["node"]: r["component"] for r in connected_components(edges).collect()}
    assert found == {i: 0 for i in range(3000)} | {i: 5000 for i in range(5000, 5201)}
