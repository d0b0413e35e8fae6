"""Stored sketches merge into those of all rows."""

from pyspark.sql import functions as F

from vizquarry.operators.sketches import DISTINCT_ERROR, RANK_ERROR, SketchStore


def test_batches_merge_and_replace(spark, tmp_path):
    df = spark.range(20_000).selectExpr(
        "id % 5000 AS k", "'t' || id % 700 AS t", "id * 0.5D AS x", "CAST(NULL AS double) AS nothing", "array(id % 3) AS xs",
        "CASE WHEN id % 2 = 0 THEN id END AS half", "id % 4 AS quarter",
    )
    store = SketchStore(spark, str(tmp_path / "sketches"))
    for k in (0, 1, 1, 2, 3):  # one batch comes twice
        store.add(df.where(f"quarter = {k}").drop("quarter"), "t", f"b{k}", F.lit("all"))
    rows = {r.column_name: r for r in store.merged(shares=(0.25, 0.5)).collect()}
    exact = {"k": 5000, "t": 700, "x": 20_000, "nothing": 0, "xs": 3, "half": 10_000}
    for name, n in exact.items():
        assert rows[name].row_count == 20_000
        assert abs(rows[name].distinct_count - n) <= DISTINCT_ERROR * n
    assert (rows["half"].non_null_count, rows["nothing"].non_null_count) == (10_000, 0)
    assert rows["t"].quantiles is None and rows["xs"].quantiles is None and rows["nothing"].quantiles is None
    for got, share in zip(rows["x"].quantiles, (0.25, 0.5)):
        assert abs(got / 10_000 - share) <= RANK_ERROR
    by_batch = {r.batch: r.row_count for r in store.merged(by=("batch",)).where("column_name = 'k'").collect()}
    assert by_batch == {f"b{k}": 5000 for k in range(4)}


def test_empty_batch(spark, tmp_path):
    store = SketchStore(spark, str(tmp_path / "s"))
    store.add(spark.range(0), "t", "b", F.lit("all"))
    assert store.merged().isEmpty()
