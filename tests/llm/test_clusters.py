"""Centroid clustering beside plain assignment to every centroid."""

import hashlib

import numpy as np
import pytest

from vizquarry.llm import clusters


def brute(ids, x, k, rounds):
    order = sorted(range(len(ids)), key=lambda i: (hashlib.sha256(f"2:{'' if ids[i] is None else ids[i]}".encode()).hexdigest(), x[i].tolist()))
    at = x[order[:k]].copy()

    def assigned():
        d = ((x[:, None, :] - at[None]) ** 2).sum(axis=2)
        return d.argmin(axis=1), d.min(axis=1)

    for _ in range(rounds):
        near, _ = assigned()
        for j in range(len(at)):
            if (near == j).any():
                at[j] = x[near == j].sum(axis=0) // (near == j).sum()
    near, d = assigned()
    name = [hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for row in at.tolist()]
    return sorted(((i, int(c), int(v), int(d[near == c].sum()), int(d.sum()), name[c]) for i, c, v in zip(ids, near, d)), key=str)


def table(spark, ids, vectors):
    rows = [(i, None if v is None else [None if y is None else float(y) for y in v]) for i, v in zip(ids, vectors)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


@pytest.mark.parametrize(("k", "rounds", "spread"), [(7, 5, 40), (40, 3, 2), (1, 2, 10), (5, 0, 10)])
def test_same_as_brute_force(spark, k, rounds, spread):
    draw = np.random.default_rng(k)
    x = draw.integers(-spread, spread, (300, 4))
    x[:60] = x[0]  # a large group of equal vectors, with ties among centroids
    x[60:120] += 500
    ids = list(range(300))
    ids[5] = None
    ids[8] = ids[9]
    vectors = [*(x / 256 + 0.3 / 256).tolist(), None, [1.0], [float("nan")] * 4, [0, 0, 0, None], [float("inf"), 0, 0, 0], []]
    docs = table(spark, [*ids, *range(1000, 1006)], vectors).repartition(6).selectExpr("*", "1 AS cluster", "2 AS x", "3 AS upper")
    got = clusters.cluster(docs, k, rounds, 4)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(ids, x, k, rounds)


def test_empty_and_few(spark):
    assert clusters.cluster(table(spark, [], []), dims=2).count() == 0
    assert clusters.cluster(table(spark, [1], [None]), dims=2).count() == 0
    rows = clusters.cluster(table(spark, [1, 2], [[0.0, 0.0], [1.0, 1.0]]), dims=2).collect()
    assert sorted((r.vec_id, r.distance) for r in rows) == [(1, 0), (2, 0)]


def test_too_large_components_are_refused(spark):
    with pytest.raises(Exception, match="after scaling"):
        clusters.cluster(table(spark, [1, 2], [[1e6, 0.0], [0.0, 0.0]]), dims=2).collect()


def test_bounds_spare_most_searches():
    """Vectors in well separated groups are searched in the first round only."""
    draw = np.random.default_rng(0)
    middle = draw.integers(-5000, 5000, (10, 8))
    x = middle[draw.integers(0, 10, 2000)] + draw.integers(-30, 30, (2000, 8))
    n = len(x)
    state = np.zeros(n, np.int64), np.ones(n, np.int64), np.full(n, np.inf), np.zeros(n)
    *state, first = clusters.assign(x, *state, clusters.Centroids(middle))
    *again, later = clusters.assign(x, *state, clusters.Centroids(middle + 1, middle))
    assert first == n and later == 0
    assert (again[0] == state[0]).all()
