"""Near duplicates beside brute force over all pairs."""

import random
import re

import numpy as np
import pytest

from vizquarry.llm import near_dedup, shingles

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, width, percent):
    def words(text):
        return tuple(WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or "")))

    def shingle_set(w):
        return {w[k : k + width] for k in range(len(w) - width + 1)} if len(w) >= width else {w} if w else set()

    sets = [shingle_set(words(t)) for _, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                if a != b:
                    up[max(a, b)] = min(a, b)
    low = {}
    for k, (key, _) in enumerate(rows):
        if key is not None:
            low[find(k)] = min(key, low.get(find(k), key))
    found = []
    for k, (key, _) in enumerate(rows):
        component = low.get(find(k)) if sets[k] else key
        found.append((key, len(sets[k]), component, key == component))
    return sorted(found, key=str)


def corpus(seed, n_groups=12):
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(4))
    passage = [word() for _ in range(60)]  # stands in many documents that are no copies
    rows, key = [], 0
    for _ in range(n_groups):
        base = [word() for _ in range(draw.choice((2, 30, 120, 200)))]
        for _ in range(draw.choice((1, 2, 9, 25))):
            own = list(base)
            for _ in range(draw.randrange(0, 4)):
                own[draw.randrange(len(own))] = word()
            if draw.random() < 0.3:
                own = own + passage
            rows.append((key, "  ".join(own).title() if draw.random() < 0.5 else " ".join(own)))
            key += 1
    for _ in range(40):
        rows.append((key, " ".join(passage + [word() for _ in range(draw.randrange(5, 40))])))
        key += 1
    rows += [(key, None), (key + 1, ""), (key + 2, " \n\t"), (key + 3, "two words"), (key + 4, "Two\nWORDS"), (key + 5, "x " * 20_000)]
    rows += [(None, "two words"), (None, "nobody else has this"), (3, rows[3][1])]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize(("seed", "width", "percent"), [(1, 3, 85), (2, 5, 80)])
def test_same_as_brute_force(spark, seed, width, percent):
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS bucket", "'x' AS rep", "2 AS label")
    got = near_dedup.near_duplicates(docs, width, percent)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, width, percent)


def test_rounds_of_pivots(spark, monkeypatch):
    """A bucket of many unlike members takes several rounds and loses no link."""
    monkeypatch.setattr(near_dedup, "PIVOTS", 1)
    monkeypatch.setattr(near_dedup, "_bands", lambda: np.zeros((near_dedup.BANDS, 1), dtype=int))
    rows = [(k, " ".join(f"w{k // 2}x{j}" for j in range(20)) + " in the end they are all the same") for k in range(12)]
    rows = [(k, t + (" but one" if k % 2 else "")) for k, t in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, near_dedup.near_duplicates(docs, 2, 85).collect()))
    assert got == brute(rows, 2, 85) or sorted(got, key=str) == brute(rows, 2, 85)


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert near_dedup.near_duplicates(docs).count() == 0


def test_signature_estimates_jaccard():
    draw = np.random.default_rng(0)
    for share in (0.5, 0.8, 0.9):
        n = 2000
        both = draw.integers(0, 2**63, int(n * share), dtype=np.int64).view(np.uint64)
        own = [draw.integers(0, 2**63, n - len(both), dtype=np.int64).view(np.uint64) for _ in range(2)]
        a, b = (near_dedup.signature(np.concatenate([both, x])) for x in own)
        want = len(both) / (2 * n - len(both))
        assert abs((a == b).mean() - want) < 4 * (want * (1 - want) / near_dedup.COORDINATES) ** 0.5


def test_sketches_differ_by_distance():
    draw = np.random.default_rng(1)
    both = draw.integers(0, 2**63, 900, dtype=np.int64).view(np.uint64)
    own = [draw.integers(0, 2**63, 100, dtype=np.int64).view(np.uint64) for _ in range(2)]
    a, b = (near_dedup.sketch(np.concatenate([both, x])) for x in own)
    differ = int(np.unpackbits((a ^ b).view(np.uint8)).sum())
    p = (1 - 900 / 1100) / 2
    assert abs(differ - 1024 * p) < 4 * (1024 * p * (1 - p)) ** 0.5
    assert differ <= near_dedup.most_differing(80) < 1024 * (1 - 0.65) / 2


def test_rolling_hash_tells_shingles_apart():
    words = "a b c a b c b a".split()
    hashes = shingles.rolling(shingles.word_hashes(words), 3)
    assert len(set(hashes.tolist())) == len({tuple(words[k : k + 3]) for k in range(6)})
