"""Batches written twice, broken off, grown by columns or emptied leave each row once."""

import uuid

import pytest
from pyspark.sql import functions as F

from vizquarry.sources import sinks


def test_batches(spark, tmp_path):
    name = f"batches_{uuid.uuid4().hex}"
    first = spark.range(10).selectExpr("id", "'a' AS kind")
    sinks.write_batch(first, name, "b1", str(tmp_path / name))
    sinks.write_batch(spark.range(10, 14).selectExpr("id", "'b' AS kind"), name, "b'2")
    sinks.write_batch(first, name, "b1")
    assert {(r.batch_id, r.n) for r in spark.table(name).groupBy("batch_id").agg(F.count("*").alias("n")).collect()} == {("b1", 10), ("b'2", 4)}
    failing = spark.range(0, 100, 1, 4).selectExpr("id", "IF(id = 90, raise_error('broken off'), 'c') AS kind")
    for batch in ("b1", "b3"):
        with pytest.raises(Exception, match="broken off"):
            sinks.write_batch(failing, name, batch)
    assert sorted(r.id for r in spark.table(name).collect()) == list(range(14))
    sinks.write_batch(spark.range(3).selectExpr("id", "'a' AS kind", "id * 2 AS twice"), name, "b1")
    rows = {(r.batch_id, r.id, r.kind, r.twice) for r in spark.table(name).collect()}
    assert rows == {("b1", k, "a", 2 * k) for k in range(3)} | {("b'2", k, "b", None) for k in range(10, 14)}
    sinks.write_batch(first.limit(0), name, "b'2")
    assert {r.batch_id for r in spark.table(name).collect()} == {"b1"}
    with pytest.raises(ValueError, match="names the batch"):
        sinks.write_batch(spark.range(1).withColumn("batch_id", F.lit(1)), name, "b1")
    spark.sql(f"DROP TABLE {name}")
