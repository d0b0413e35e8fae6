"""Steps that many queries share: what they read, and how often."""

import pytest
from pyspark.sql import functions as F

from vizquarry.operators import metrics
from vizquarry.operators.depth import nesting_depth
from vizquarry.sources.shred import clustered
from vizquarry.workload import fixtures as fx, ingest


@pytest.fixture(scope="module")
def estate(spark, tmp_path_factory):
    """Two workbooks; one has a line, the other one a line with nulls."""
    path = str(tmp_path_factory.mktemp("estate"))
    rows = {
        "orders": "SELECT * FROM VALUES (1L, 3L, 'O', 1D, '1-URGENT'), (2L, 5L, 'P', 2D, '2-HIGH') "
        "AS t(o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority)",
        "lineitem": "SELECT *, 0D AS l_discount, 0D AS l_tax, 'F' AS l_linestatus, timestamp_ntz '2020-01-01 00:00:00' AS l_shipdate FROM VALUES "
        "(1L, 12L, 3L, 1, 1D, 2D, 'A'), (2L, NULL, NULL, NULL, NULL, NULL, NULL) "
        "AS t(l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag)",
    }
    for name in fx.BASE_TABLES:
        spark.sql(rows.get(name, "SELECT 1 AS k")).write.parquet(f"{path}/{name}.parquet")
    return path


def _tables(df):
    return {part for file in df.inputFiles() for part in file.split("/") if part.endswith(".parquet") and not part.startswith("part-")}


def test_a_metric_reads_the_tables_it_is_about(spark, estate):
    elements = fx.workbook_elements(spark, estate)
    assert _tables(elements.where("tag = 'worksheet'")) == {"orders.parquet"}
    assert _tables(elements) == {"orders.parquet", "lineitem.parquet"}
    # Stanzas of sheets are no sources of the workbook, so the strict count leaves them out before it adds up.
    found = {r.workbook_id: r.num_datasources for r in metrics.data_model(elements).collect()}
    assert found == {1: 2, 2: 3}


def test_archives_are_scanned_without_a_stored_copy(spark, estate):
    assert _tables(ingest._corpus(spark, estate)) == {"orders.parquet", "lineitem.parquet"}


def test_clustering_moves_no_row_to_another_task(spark):
    rows = spark.range(40).selectExpr("id % 2 AS workbook_id", "id AS elem_id", "CAST(id % 3 AS STRING) AS tag").repartition(2, "workbook_id")
    at = clustered(rows).withColumn("task", F.spark_partition_id()).groupBy("workbook_id").agg(F.countDistinct("task").alias("n"))
    assert {r.n for r in at.collect()} == {1}


def test_formulas_are_made_once_for_the_depth(spark):
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def formula(text):
        made.add(1)
        return text

    rows = [(1, "a", "[b]"), (1, "b", "[c] + [a2]"), (1, "c", "1")]
    calcs = spark.createDataFrame(rows, "workbook_id long, calc_name string, text string")
    calcs = calcs.select("workbook_id", "calc_name", formula.asNondeterministic()("text").alias("formula"))
    assert [r.max_calc_nesting_depth for r in nesting_depth(calcs).collect()] == [3]
    assert made.value == len(rows)
