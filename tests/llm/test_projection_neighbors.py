from __future__ import annotations

import numpy as np
import pytest

from tripspark.llm import projection_neighbors as op

SCHEMA = "vec_id long, embedding array<float>, label int, node long, component string"


def brute(rows):
    n = len(rows)
    good = [i for i, (_, v) in enumerate(rows) if v and None not in v and np.isfinite(v).all() and np.any(v)]
    x = {i: np.array(rows[i][1], dtype=np.float32).astype(float) for i in good}
    links, root = np.zeros(n, dtype=int), list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in good:
        for j in good:
            if i < j and len(x[i]) == len(x[j]) and x[i] @ x[j] / np.linalg.norm(x[i]) / np.linalg.norm(x[j]) >= 0.9:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, int(links[i]), least.get(find(i)), d == least.get(find(i))) for i, (d, _) in enumerate(rows)), key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("vec_id", "n_links", "component_id", "kept").collect()), key=str)


def made(spark, rows):
    return spark.createDataFrame([(i, v, 0, 5, "x") for i, v in rows], SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def rows():
    r = np.random.default_rng(3)
    out, n = [], 0
    for size, noise in ((40, 0.02), (7, 0.05), (2, 0.04), (2, 0.05), (2, 0.06), (1, 0), (300, 0.035)):
        base = r.standard_normal(32)
        base /= np.linalg.norm(base)
        for _ in range(size):
            out.append((1000 - n, (base + noise * r.standard_normal(32)).astype(np.float32).tolist()))
            n += 1
    out += [(5000 + i, r.standard_normal(32).tolist()) for i in range(100)]
    out += [(2, out[0][1]), (2, out[0][1]), (None, out[0][1]), (3, [float(x) * 7 for x in out[0][1]])]
    out += [(20, None), (21, []), (22, [0.0] * 32), (23, [1.0, None] + [0.0] * 30), (24, [float("nan")] + [1.0] * 31),
            (25, [float("inf")] + [1.0] * 31), (26, [1.0, 0.0]), (27, [2.0, 0.0]), (28, [-1.0, 0.0]), (29, [1e-30] * 32),
            (30, [1e30] * 32), (31, [-0.0, 1.0]), (32, [0.0, 1.0]), (None, None)]
    return out


def test_matches_brute_force(spark, rows):
    assert got(op.near_duplicates(made(spark, rows))) == brute(rows)


def test_small_windows_and_tiles_still_find_dense_groups(spark, rows, monkeypatch):
    monkeypatch.setattr(op, "TILE", 16)
    monkeypatch.setattr(op, "WINDOW", 8)
    want, found = brute(rows), got(op.near_duplicates(made(spark, rows)))
    assert all(f[1] <= w[1] for f, w in zip(found, want)) and sum(f[1] for f in found) >= 0.99 * sum(w[1] for w in want)


def test_table_recall_and_precision(spark, sf_small):
    df = spark.read.parquet(f"{sf_small}/embeddings.parquet")
    data = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    want, found = brute(data), got(op.near_duplicates(df))
    assert all(f[1] <= w[1] for f, w in zip(found, want))
    assert sum(f[1] for f in found) >= 0.95 * sum(w[1] for w in want)


def planted(n, crowd, seed=1, pairs=300, dims=64, cosine=0.91):
    """n vectors with a cosine of about ``crowd`` to each other, the first of them in pairs."""
    r = np.random.default_rng(seed)
    x = r.standard_normal((n, dims))
    x = np.sqrt(1 - crowd) * x / np.linalg.norm(x, axis=1, keepdims=True)
    x[:, 0] += np.sqrt(crowd)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    own, side = x[:pairs], r.standard_normal((pairs, dims))
    side -= (side * own).sum(axis=1, keepdims=True) * own
    x[pairs:2 * pairs] = cosine * own + np.sqrt(1 - cosine**2) * side / np.linalg.norm(side, axis=1, keepdims=True)
    return x


def pairs_that_met(spark, x, pairs=300):
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    of = {r["vec_id"]: r["component_id"] for r in op.near_duplicates(df).collect()}
    return sum(of[i] == of[i + pairs] for i in range(pairs))


def test_crowded_vectors_meet_as_evenly_spread_ones(spark):
    """Pairs just above the threshold, where all vectors lie in a region that is below it."""
    assert pairs_that_met(spark, planted(8000, 0.8)) >= 297


def test_prefix_larger_than_a_tile_is_compared_in_tiles(spark, monkeypatch):
    monkeypatch.setattr(op, "TILE", 256)
    third = planted(2000, 0.7)
    spread = np.random.default_rng(2).standard_normal((4000, 64))
    assert pairs_that_met(spark, np.concatenate([third, spread])) >= 297


def test_more_vectors_take_more_passes():
    assert op.passes_for(10) == 1
    assert op.passes_for(10**4) < op.passes_for(10**6) < op.passes_for(10**8)


def test_empty_table(spark):
    assert op.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
