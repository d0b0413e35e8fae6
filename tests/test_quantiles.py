"""Quantiles by distributed selection beside sorting."""

import random

import pytest

from vizquarry.operators import quantiles as q


def want(values, p):
    x = sorted(v for v in values if v is not None and v == v)
    if not x:
        return None
    at = p * (len(x) - 1)
    low = int(at)
    return x[low] if at == low else x[low] + (at - low) * (x[low + 1] - x[low])


@pytest.mark.parametrize(("few", "bins"), [(10_000, 1024), (5, 4)])
def test_same_as_sorting(spark, monkeypatch, few, bins):
    monkeypatch.setattr(q, "FEW", few)
    monkeypatch.setattr(q, "BINS", bins)
    draw = random.Random(few)
    groups = {
        "wide": [draw.gauss(0, 1) * 10 ** draw.randint(-9, 9) for _ in range(400)],
        "equal": [7.0] * 300,
        "two": [1.0] * 50 + [2.0] * 51,
        "one": [-3.5],
        "far": [-1.7e308, 1.7e308, 0.0, 5e-324, 1.0, 2.0, 3.0, 4.0],
        "none": [None, float("nan")],
        None: [float(k % 17) for k in range(200)] + [None],
    }
    rows = [(g, k % 2, v) for g, values in groups.items() for k, v in enumerate(values)]
    draw.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, half int, v double").selectExpr("g", "v", "half AS rank", "1 AS low", "2 AS n")
    shares = {"a": 0.0, "low": 0.25, "mid": 0.5, "n": 0.9, "z": 1.0}
    got = {r.g: tuple(r[c] for c in shares) for r in q.quantiles(df.select("g", "v", "rank"), ["g"], "v", shares).collect()}
    for g, values in groups.items():
        for found, p in zip(got[g], shares.values()):
            expected = want(values, p)
            assert found == expected or (expected is not None and found == pytest.approx(expected, rel=1e-12)), (g, p)
    pairs = q.quantiles(df, ["g", "rank"], "v", {"mid": 0.5}).collect()
    assert {(r.g, r["rank"]): r.mid for r in pairs} == {
        (g, h): pytest.approx(want(values[h::2], 0.5)) if want(values[h::2], 0.5) is not None else None
        for g, values in groups.items() for h in (0, 1) if values[h::2]
    }


def test_whole_table_and_errors(spark):
    df = spark.range(1001).selectExpr("id * 2.0D AS v")
    assert q.quantiles(df, [], "v", {"mid": 0.5}).collect()[0].mid == 1000.0
    assert q.quantiles(df.where("v < 0"), ["v"], "v", {"mid": 0.5}).isEmpty()
    with pytest.raises(ValueError, match="between 0 and 1"):
        q.quantiles(df, [], "v", {"x": 1.5})
