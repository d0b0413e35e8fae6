"""Repeated passages beside counting every window."""

import collections
import hashlib
import random

import numpy as np
import pytest

from vizquarry.llm import repeats


def brute(texts, length):
    seen = collections.Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    found = []
    for t in texts:
        gone = np.zeros(len(t), dtype=bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        begins = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        kept = bytes(b for b, g in zip(t, gone) if not g)
        found.append((len(t), int(gone.sum()), begins, hashlib.sha256(kept).hexdigest()))
    return found


def corpus(seed):
    draw = random.Random(seed)
    word = lambda n: "".join(draw.choice("ab") for _ in range(n))
    base = [word(n) for n in (10, 60, 60, 150, 210, 400)]  # some stand in many texts, with other text around them
    texts = []
    for _ in range(100):
        texts.append("".join(draw.choice(base) if draw.random() < 0.5 else word(draw.randrange(0, 40)) for _ in range(draw.randrange(0, 6))))
    texts += ["a" * 300, "ab" * 200, "é" * 90, "€" + base[4] + "é", None, "", "abc" * 500, base[3] * 3, "x" * 100, "x" * 39, "y" * 41]
    texts += [word(20_000) + base[5], "퟿" + base[5][:199], base[5][1:200] + "\n"]
    texts += texts[:15]
    return [(k if k % 9 else None, t) for k, t in enumerate(texts)]


@pytest.mark.parametrize(("length", "gram", "batches", "slice_"), [(40, 12, 5, 4096), (200, 48, 3, 1 << 16), (41, 2, 1, 256)])
def test_same_as_brute_force(spark, monkeypatch, length, gram, batches, slice_):
    monkeypatch.setattr(repeats, "SLICE", slice_)
    rows = corpus(length)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    docs = docs.selectExpr("*", "1 AS doc", "'x' AS id", "2 AS starts", "3 AS key")
    got = repeats.remove_repeats(docs, length, gram, batches)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    found = brute([(t or "").encode() for _, t in rows], length)
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(k, *f) for (k, _), f in zip(rows, found)], key=str)
    assert 0 < sum(f[1] for f in found) < sum(f[0] for f in found)


def test_joined_by_shuffle_beyond_the_bound(spark, monkeypatch):
    rows = corpus(3)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(map(tuple, repeats.remove_repeats(docs, 40, 12).collect()), key=str)
    monkeypatch.setattr(repeats, "SENT", 0)
    assert sorted(map(tuple, repeats.remove_repeats(docs, 40, 12).collect()), key=str) == want


def test_levels_merge_geometrically(spark):
    draw = random.Random(5)
    family = repeats.SuffixFamily(spark, 40, 12)
    for k in range(7):
        rows = [(100 * k + j, "".join(draw.choice("abcd") for _ in range(300))) for j in range(4)]
        family.add(spark.createDataFrame(rows, "doc long, text string"))
    assert [size for size, _, _ in family.levels] == [4, 2, 1]
    assert family.levels[0][1].groupBy("key").count().where("count > 1").isEmpty()
    n = family.spark.read.parquet(*family.folders).count()
    assert sum(level.selectExpr("sum(n)").first()[0] for _, level, _ in family.levels) >= n


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert repeats.remove_repeats(docs).count() == 0
    short = spark.createDataFrame([(1, "short"), (2, "short"), (3, None)], "doc_id long, text string")
    assert {(r.doc_id, r.n_removed, r.n_spans) for r in repeats.remove_repeats(short).collect()} == {(1, 0, 0), (2, 0, 0), (3, 0, 0)}


def test_equal_windows_have_equal_keys():
    draw = np.random.default_rng(2)
    passage = draw.integers(97, 123, 500, dtype=np.uint8)
    found = []
    for n in (0, 37, 611):
        data = np.concatenate([draw.integers(97, 123, n, dtype=np.uint8), passage, draw.integers(97, 123, 300, dtype=np.uint8)])
        start, last, _, key, _, tied = repeats.runs(data, np.array([len(data)]), 200, 48)
        assert not tied.any()
        of_window = np.repeat(key, last - start + 1)
        assert len(of_window) == len(data) - 199
        found.append(of_window[n : n + 301].tolist())
    assert found[0] == found[1] == found[2]


def test_pieces_cover_each_window_once():
    draw = np.random.default_rng(3)
    for size in (1, 16):
        start, lead = draw.integers(0, 1000, 50), draw.integers(0, 153, 50)
        more = np.array([draw.integers(0, x + 1) for x in lead])
        run, begin, after, piece = repeats.cut(start, more, lead, size)
        for k in range(50):
            own = run == k
            windows = sorted(w for a, n in zip(begin[own], after[own]) for w in range(a, a + n + 1))
            assert windows == list(range(start[k], start[k] + more[k] + 1))
        assert (after < size).all() and (piece <= begin).all() and (begin + after < piece + size).all()
        assert ((start + lead)[run] - piece - size + 1).min() >= 0 and not (((start + lead)[run] - piece - size + 1) % size).any()
