"""Near-duplicate vectors and top-k search against brute force."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeops.llm import near_vectors, topk

KIND = "vec_id long, embedding array<float>, label int, code string, n int"
NAN, INF = float("nan"), float("inf")


def table(spark, rows):
    return spark.createDataFrame([(*r, "extra", 1) for r in rows], KIND)


def vectors(seed, n=150, dim=16):
    """Vectors of two labels with groups of copies and near copies, as float32 values."""
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        x = rng.normal(size=dim)
        if i % 3 and out:
            x = np.array(out[rng.integers(len(out))][1]) + rng.normal(size=dim) * rng.choice([0, 0.02, 0.08, 0.2])
        out.append((i, [float(v) for v in x.astype(np.float32)], i % 2))
    return out


def unit(x):
    x = np.array(x, float)
    return x / np.linalg.norm(x)


def test_near_duplicates(spark, monkeypatch):
    data = vectors(1)
    for few, block in ((16, 1024), (2, 8)):
        monkeypatch.setattr(near_vectors, "FEW", few)
        how = near_vectors.Hashing(tables=8, functions=1, block=block)
        got = near_vectors.near_duplicates(table(spark, data).repartition(3), 0.98, how=how).collect()
        near = [
            [j for j, y, l in data if j != i and l == k and unit(x) @ unit(y) >= 0.98] for i, x, k in data
        ]
        low = list(range(len(data)))
        for _ in data:
            low = [min([low[i], *(low[j] for j in near[i])]) for i in range(len(data))]
        assert {r.id: (r.n_links, r.component_id, r.kept) for r in got} == {
            i: (len(near[i]), low[i], low[i] == i) for i in range(len(data))
        }


def test_odd_vectors(spark):
    data = [
        (0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], None),
        (4, None, 1), (5, [0.0, 0.0], 1), (6, [NAN, 1.0], 1), (7, [INF, 1.0], 1), (8, [None, 1.0], 1),
        (9, [1.0], 1), (10, [], 1), (None, [1.0, 0.0], 1), (11, [-0.0, 1.0], 1), (12, [0.0, 1.0], 1),
        (13, [1.0, 0.0], 2),
    ]
    got = near_vectors.near_duplicates(table(spark, data)).collect()
    assert len(got) == len(data)
    assert {r.id: (r.n_links, r.component_id) for r in got} == {
        0: (3, 0), 1: (3, 0), 2: (3, 0), 3: (0, 3), 4: (0, 4), 5: (0, 5), 6: (0, 6), 7: (0, 7), 8: (0, 8),
        9: (0, 9), 10: (0, 10), None: (0, None), 11: (1, 11), 12: (1, 11), 13: (0, 13),
    }
    assert near_vectors.near_duplicates(table(spark, data).limit(0)).count() == 0


def test_hadamard():
    x = np.random.default_rng(2).normal(size=(5, 16))
    h = np.array([[1.0]])
    while len(h) < 16:
        h = np.block([[h, h], [h, -h]])
    assert np.allclose(near_vectors.hadamard(x), x @ h / 4)


def test_most_near_pairs_meet():
    rng = np.random.default_rng(3)
    a = rng.normal(size=(2000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.normal(size=a.shape)
    b -= (a * b).sum(1, keepdims=True) * a
    b = 0.98 * a + np.sqrt(1 - 0.98**2) * b / np.linalg.norm(b, axis=1, keepdims=True)
    for rows in (10_000, 10**9):
        how = near_vectors.Hashing.for_rows(rows, 64)
        (ma, pa), (mb, pb) = near_vectors.codes(a, how), near_vectors.codes(b, how)
        met = (ma == mb) | (pa == mb[:, :, None]).any(2) | (pb == ma[:, :, None]).any(2)
        assert met.any(1).mean() > 0.98


def brute_top(data, k):
    use = [(i, [int(np.floor(256 * float(v))) for v in x]) for i, x, _ in data]
    out = {}
    for q, x in use:
        if q % 5 == 0:
            found = [(-sum(a * b for a, b in zip(x, y)), i) for i, y in use if i != q and len(x) == len(y)]
            out[q] = [(i, -s) for s, i in sorted(found)[:k]]
    return out


@pytest.mark.parametrize("block, queries", [(4096, 512), (16, 4)])
def test_top_k(spark, monkeypatch, block, queries):
    monkeypatch.setattr(topk, "VECTOR_BLOCK", block)
    monkeypatch.setattr(topk, "QUERY_STEP", queries)
    monkeypatch.setattr(topk, "RESOLVE", 6)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 7)
    data = vectors(4, 120, 8)
    got = topk.top_k(table(spark, data), F.col("vec_id") % 5 == 0, k=5).collect()
    by = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        by.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert by == brute_top(data, 5)


def test_bounds_hold():
    rng = np.random.default_rng(5)
    x, q = rng.integers(-50, 50, (60, 6)), rng.integers(-50, 50, (9, 6))
    down = np.argsort(-x, axis=0, kind="stable")
    rank = np.empty_like(down)
    np.put_along_axis(rank, down, np.arange(60)[:, None], axis=0)
    lists = np.take_along_axis(x, down, axis=0).astype(float)
    search = topk.Search(np.arange(9), q, 3)
    for depth in (1, 7, 30, 60):
        low, high = search._bounds(np.arange(9), x, lists, rank, depth, True)
        assert (low <= q @ x.T).all() and (high >= q @ x.T).all()


def test_odd_queries(spark):
    big = 3.0e30
    data = [
        (0, [1.0, 1.0], 1), (1, [1.0, 1.0], 1), (2, [1.0, 1.0], 1), (3, None, 1), (4, [NAN, 1.0], 1),
        (5, [None, 1.0], 1), (6, [1.0], 1), (10, [INF, 1.0], 1), (None, [1.0, 1.0], 1), (15, [0.0, 0.0], 1),
        (0, [1.0, 1.0], 1), (20, [], 1),
    ]
    got = topk.top_k(table(spark, data), F.col("vec_id") % 5 == 0, k=5).collect()
    assert [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == 0] == [
        (1, 131072), (2, 131072), (15, 0),
    ]
    assert sorted(r.vec_id for r in got if r.query_id == 15) == [0, 0, 1, 2]
    assert {r.query_id for r in got} == {0, 15}
    assert topk.top_k(table(spark, data).limit(0), F.col("vec_id") % 5 == 0).count() == 0
    large = table(spark, [(0, [big, 1.0], 1), (1, [big, 1.0], 1)])
    assert topk.top_k(large, F.col("vec_id") == 0).count() == 1
