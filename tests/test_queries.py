"""Every registered query at the smallest scale beside its check in DuckDB."""

import pytest

from compare import compare, duck, spark_entry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", list(spark_entry.queries()))
def test_query(spark, con, name):
    ok, text = compare(spark, con, name, SF)
    assert ok, text


def test_entry(spark):
    df = spark_entry.entry(spark)
    assert df.count() > 0 and "composite_score" in df.columns


def test_checks_belong_to_queries():
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())
