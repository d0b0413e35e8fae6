"""One odd workbook, table or view must not end, drop or double anything."""

import math

import pytest
from pyspark.sql import functions as F

from vizquarry.functions.numbers import round1
from vizquarry.functions.translate import translate
from vizquarry.plans.metric_view import metric_views
from vizquarry.plans.views import build_views, with_slugs
from vizquarry.sources import shred, sinks
from vizquarry.sources.catalog import column_catalog


def test_rounding_of_large_numbers(spark):
    values = [0.05, 0.25, 0.35, 127.95, 128.05, 129.0, 200.25, 12345.65, 2.0**40 + 0.25]
    got = spark.createDataFrame([(v,) for v in values], "v double").select("v", round1(F.col("v")).alias("r")).collect()
    for v, r in got:
        assert r == float(round(v, 1)) or math.isclose(r, round(v, 1), rel_tol=1e-15), (v, r)


def test_undeclared_prefix_is_an_error_row(spark):
    books = spark.createDataFrame([(1, "<a><user:x/></a>"), (2, "<a><b/></a>"), (3, "<a>"), (4, None)], "workbook_id int, xml string")
    rows = shred.shred(books)
    assert {r.workbook_id for r in shred.failures(rows).collect()} == {1, 3, 4}
    assert {r.workbook_id for r in shred.elements(rows).collect()} == {2}


def test_append_never_overwrites(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(5).write.parquet(path)
    spark.sql("DROP TABLE IF EXISTS append_to_folder")
    got = sinks.write_table(spark.range(5, 6), "append_to_folder", "append", path)
    assert sorted(r.id for r in got.collect()) == [0, 1, 2, 3, 4, 5]


def test_views_of_tables_without_columns_are_kept(spark):
    rows = [(0, 0, "a", "c1", "SUM([x])", "SUM([x])", [], "known"), (0, 1, "b", "c2", "SUM([x])", "SUM([x])", [], "unknown")]
    calcs = spark.createDataFrame(
        rows,
        "workbook_id int, ord int, name string, calc_id string, formula string, formula_inlined string,"
        " datasources array<string>, source_set string",
    )
    tables = {"t": spark.range(1).withColumnRenamed("id", "x")}
    catalog = column_catalog(spark, tables).withColumn("source_set", F.lit("known"))
    got = {r.name: r for r in build_views(calcs, catalog).collect()}
    assert set(got) == {"a", "b"}
    assert got["a"].expr and got["b"].status == "unsupported" and got["b"].notes


def test_repeated_join_keys_are_refused(spark):
    fact = spark.createDataFrame([(1, 10), (2, 20)], "part_key int, price int")
    part = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z")], "part_key int, label string")
    formulas = {"m": "SUM(IF [label] = 'x' THEN [price] END)"}
    bad = metric_views(spark, formulas, {"fact": fact, "part": part}, ["fact"])["m"]
    assert bad.joins
    with pytest.raises(ValueError, match="many-to-one"):
        bad.select()
    good = metric_views(spark, formulas, {"fact": fact, "part": part.where("label <> 'y'")}, ["fact"])["m"]
    assert good.select().collect()[0][0] == 10


def test_equal_slugs_become_unique(spark):
    rows = [(1, k, "A", "x123456") for k in range(4)] + [(1, 9, "A_123456", "zz")]
    got = with_slugs(spark.createDataFrame(rows, "workbook_id int, ord int, name string, calc_id string")).collect()
    assert len({r.slug for r in got}) == len(rows)


@pytest.mark.parametrize(
    ("formula", "value"),
    [
        ("[a] / ABS ([z])", None),
        ("[a] / /* none */ [b]", 3.0),
        ("-1.5e3 / [b]", -750.0),
        ("[a] % [z]", None),
        ("[b] ^ 3", 8.0),
        ("-[b] ^ 2", -4.0),
        ("([a] + 1) / [b] ^ 0", 7.0),
        ("'n' + [t] + '!'", "nx!"),
        ("IF [a] > 1 THEN 'n' + [t] ELSE 'o' END", "nx"),
        ("([t] + 'y') = 'xy'", True),
    ],
)
def test_lenient_values(spark, formula, value):
    row = spark.createDataFrame([(6, 2, 0, "x")], "a int, b int, z int, t string")
    assert row.select(F.expr(translate(formula, {})[1])).collect()[0][0] == value
