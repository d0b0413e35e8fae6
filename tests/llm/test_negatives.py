"""Hard negatives beside scoring every pair."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from vizquarry.llm import negatives


def brute(rows, every, n_pos=5, n_neg=10):
    clean = sorted({(i, y, tuple(int(np.floor(256 * c)) for c in v)) for i, y, v in rows if i is not None and y is not None and v is not None and all(c is not None and np.isfinite(c) for c in v)})
    found = []
    for a, y, q in (r for r in clean if r[0] % every == 0):
        scored = [(sum(s * t for s, t in zip(q, v)), i, z) for i, z, v in clean]
        for p, pid in sorted(((s, i) for s, i, z in scored if z == y and i != a), key=lambda r: (-r[0], r[1]))[:n_pos]:
            fits = sorted(((s, i) for s, i, z in scored if z != y and 30 * p <= 100 * s <= 90 * p), key=lambda r: (-r[0], r[1]))
            found += [(a, pid, k, i, p, s) for k, (s, i) in enumerate(fits[:n_neg], 1)]
    return sorted(found)


def corpus(seed, n=400, dims=6):
    draw = np.random.default_rng(seed)
    middle = draw.normal(size=(4, dims))
    rows = []
    for i in range(n):
        y = int(draw.integers(0, 4))
        rows.append((i, y, (middle[y] + draw.normal(size=dims)).round(2).tolist()))
    for i in range(n, n + 60):
        rows.append((i, i % 3, [0.5] * dims))  # equal vectors: ties by id
    rows += [rows[20], rows[30], (40, 1, rows[41][2]), (None, 1, [1.0] * dims), (900, None, [1.0] * dims), (901, 1, None)]
    rows += [(910, 2, [float("nan")] * dims), (920, 2, [None, *[0.0] * (dims - 1)]), (930, 1, [0.25] * (dims - 2)), (940, 0, [])]
    return rows


@pytest.mark.parametrize(("seed", "block", "wave"), [(1, 16, 8), (2, 512, 8192)])
def test_same_as_brute_force(spark, monkeypatch, seed, block, wave):
    monkeypatch.setattr(negatives, "BLOCK", block)
    monkeypatch.setattr(negatives, "WAVE", wave)
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").repartition(4)
    docs = docs.selectExpr("*", "1 AS id", "'x' AS key", "2 AS block", "3 AS x", "4 AS place")
    got = negatives.mine(docs, F.col("id") % 10 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    # An id with two unlike rows is two anchors, whose rows may coincide.
    assert sorted(map(tuple, got.collect())) == brute(rows, 10)


def test_empty_and_lonely(spark):
    schema = "vec_id long, label int, embedding array<float>"
    assert negatives.mine(spark.createDataFrame([], schema), F.col("id") % 2 == 0).count() == 0
    alone = [(0, 1, [1.0, 0.0]), (1, 2, [1.0, 0.5]), (2, None, [1.0, 0.0])]
    assert negatives.mine(spark.createDataFrame(alone, schema), F.col("id") % 2 == 0).count() == 0


def test_bounds_hold_and_choose():
    draw = np.random.default_rng(4)
    x, q = draw.integers(-9, 9, (50, 5)), draw.integers(-9, 9, (20, 5)).astype(float)
    least, most = negatives.bounds(q, x.min(axis=0).astype(float), x.max(axis=0).astype(float))
    scores = q @ x.T
    assert (least[:, None] <= scores).all() and (scores <= most[:, None]).all()
    wave = negatives.Wave(np.arange(20), np.zeros(20, np.int64), q)
    search = negatives.Search(wave, np.arange(20), np.full(20, 10**6), np.full(20, 10**7), True, 3)
    assert not len(search.wanted(x.min(axis=0), x.max(axis=0), np.array([0])))
    search = negatives.Search(wave, np.arange(20), np.full(20, -(10**6)), np.full(20, 10**7), True, 3)
    assert len(search.wanted(x.min(axis=0), x.max(axis=0), np.array([0]))) == 20
    assert not len(search.wanted(x.min(axis=0), x.max(axis=0), np.array([1, 2])))


@pytest.mark.parametrize(("dims", "bits"), [(2, 4), (3, 3), (4, 2)])
def test_curve_passes_every_cell_once_in_steps_of_one(dims, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), axis=-1).reshape(-1, dims)
    keys = [k.tobytes() for k in negatives.hilbert_keys(cells, bits)]
    assert len(set(keys)) == len(cells)
    path = cells[sorted(range(len(cells)), key=keys.__getitem__)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()
