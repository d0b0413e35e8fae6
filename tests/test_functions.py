import random

import pytest
from pyspark.sql import functions as F

from vizquarry.functions import formulas as fm, names
from vizquarry.functions.numbers import round1
from vizquarry.functions.translate import translate
from vizquarry.operators.score import linear, log_scaled
from vizquarry.sources.tables import clean_columns, unique_names


def column(spark, values, expr):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    return [r[1] for r in rows.select("i", expr("v").alias("r")).orderBy("i").collect()]


def test_sanitize(spark):
    raw = ["Sales Lines", "__Größe (m²)__", "---", "a--b", "日本 x"]
    assert column(spark, raw, names.sanitize) == ["sales_lines", "größe__m²", "unnamed_table", "a__b", "日本_x"]
    once = column(spark, raw, names.sanitize)
    assert column(spark, once, names.sanitize) == once


def test_norm_and_slug(spark):
    assert column(spark, ["Größe (m)", "A--B", "é"], names.norm) == ["gr_e_m", "a_b", ""]
    assert column(spark, ["2 x", "é", "A b"], names.slug) == ["_2_x", "calc", "a_b"]
    assert column(spark, ["ab", "a b", "a`b", "1a"], names.quote_column) == ["ab", "`a b`", "`a``b`", "`1a`"]


def test_strip_comments(spark):
    raw = [
        "a // b",
        "a '//' b // c",
        'x "it\'s // in" // out',
        "don't // stays: the quote is open",
        "a /* b\nc */ d",
        '"/* also in quotes */" + 1',
        "a // one\r\nb // two\n\n",
        "http://x",
        "  1 / 2 / 3  ",
    ]
    assert column(spark, raw, fm.strip_comments) == [
        "a",
        "a '//' b",
        'x "it\'s // in"',
        "don't // stays: the quote is open",
        "a  d",
        '"" + 1',
        "a \nb",
        "http:",
        "1 / 2 / 3",
    ]


def test_strip_comments_survives_long_lines(spark):
    long = "[x] + 'y' " * 20000
    assert column(spark, [long + "// tail"], fm.strip_comments) == [long.strip()]


def test_field_refs(spark):
    raw = ["[A  b] + '[not]' + [c] + [A b]", "1", '"[x]"[y]']
    assert column(spark, raw, fm.field_refs) == [["A b", "c"], [], ["y"]]


@pytest.mark.parametrize(
    "formula,label",
    [
        ("{FIXED [a]: SUM([b])}", "LOD expression (FIXED/INCLUDE/EXCLUDE)"),
        ("RANK_PERCENTILE(SUM([b]))", "table calculation"),
        ("size ( )", "table calculation"),
        ("SCRIPT_REAL('x')", "external / raw SQL function"),
        ("[Parameters].[p]", "Tableau parameter reference"),
        ("DATEPARSE('y', [d])", "DATEPARSE (format strings differ)"),
        ("'{' + [a]", None),
    ],
)
def test_refusals_agree_on_both_sides(spark, formula, label):
    assert column(spark, [formula], fm.refusal) == [label]
    expr, _, notes = translate(formula, {})
    assert (expr is None) == (label is not None)
    if label:
        assert notes == [f"unsupported: {label}"]


def test_scorer_list_differs_from_translator_list(spark):
    raw = ["RANK_PERCENTILE(x)", "SIZE()", "RANK(x)", "RANK_DENSE(x)", "WINDOW_SUM(x)", "WINDOW_CORR(x)"]
    assert column(spark, raw, fm.has_table_calc) == [False, False, True, True, True, False]


@pytest.mark.parametrize(
    "formula,sql",
    [
        ("ZN(SUM([a b]))", "COALESCE(SUM(`a b`), 0)"),
        ("zn ( IFNULL([x],[y]) )", "COALESCE(COALESCE(x, y), 0)"),
        ("IIF(ISNULL([x]), 1, 2, 3)", "IF((x IS NULL), 1, 2)"),
        ('IF [x] == "a,b)" THEN 1 ELSEIF [x] = \'IF\' THEN 2 END', "CASE WHEN x = 'a,b)' THEN 1 WHEN x = 'IF' THEN 2 END"),
        ("MAX([x])", "MAX(x)"),
        ("MAX([x], MIN([y], 2))", "GREATEST(x, LEAST(y, 2))"),
        ("DATEDIFF('day', [a], DATEADD(\"month\", 1, [b]))", "DATEDIFF(DAY, a, DATEADD(MONTH, 1, b))"),
        ("DATEPART('week', TODAY())", "EXTRACT(WEEK FROM CURRENT_DATE())"),
        ("DATETRUNC('year', NOW(), 'monday')", "DATE_TRUNC('YEAR', CURRENT_TIMESTAMP())"),
        ("ROUND([x], 2) + LEN('it''s')", "ROUND(x, 2) + LENGTH('it''s')"),
        ("COUNTD([x])/STDEVP([y])", "COUNT(DISTINCT x)/STDDEV_POP(y)"),
        ('"it\'s"', "'it\\'s'"),
        ("[Sales (Orders)]", "`Sales (Orders)`"),
    ],
)
def test_translate(formula, sql):
    assert translate(formula, {})[0] == sql


def test_translate_uses_the_column_map_and_keeps_literals():
    expr, _, _ = translate("SUM([Extended  Price]) + LEN(' [x]  y ')", {"Extended Price": "o.price"})
    assert expr == "SUM(o.price) + LENGTH(' [x]  y ')"


@pytest.mark.parametrize(
    "formula,sql",
    [
        ("SUM([a]) / SUM([b])", "SUM(a) / NULLIF(SUM(b), 0)"),
        ("[a]/[b]/[c] * 2", "a/ NULLIF(b, 0)/ NULLIF(c, 0) * 2"),
        ("1 / -([a] / [b])", "1 / NULLIF(-(a / NULLIF(b, 0)), 0)"),
        ("[a] / IF [b] > 0 THEN 1 ELSE [c] / [d] END", "a / NULLIF(CASE WHEN b > 0 THEN 1 ELSE c / NULLIF(d, 0) END, 0)"),
        ("FLOAT([a])", "TRY_CAST(a AS DOUBLE)"),
        ("'a/b'", "'a/b'"),
    ],
)
def test_lenient_form(formula, sql):
    assert translate(formula, {})[1] == sql


@pytest.mark.parametrize("formula", ["LEN()", "IFNULL([x])", "DATETRUNC('eon', [x])", "ZN([x]", "DATEADD('day', 1)"])
def test_bad_calls_are_refused(formula):
    expr, _, notes = translate(formula, {})
    assert expr is None and notes[0].startswith("unsupported: could not translate function call (")


def test_notes():
    assert translate("ATTR([x])", {})[2] == ["ATTR() approximated with MIN()"]
    assert translate("'a' + [x]", {})[2] == ["string concatenation with '+' - consider CONCAT()"]
    assert len(translate("[x] ^ 2 + 'a'", {})[2]) == 2
    assert translate("'^'", {})[2] == []


def test_round1_decides_ties_like_python(spark):
    rng = random.Random(1)
    values = [k / 20 for k in range(0, 2001)] + [rng.random() * 100 for _ in range(2000)]
    values += [0.05, 0.15, 28.25, 28.35, 99.95, 0.1 + 0.2]
    rows = spark.createDataFrame([(v,) for v in values], "x double")
    got = rows.select("x", round1(F.col("x")).alias("r")).collect()
    assert [(r.x, r.r) for r in got if r.r != round(r.x, 1)] == []


def test_score_curves(spark):
    row = spark.range(1).select(
        round1(log_scaled(F.lit(1.0))), round1(log_scaled(F.lit(2.0))), log_scaled(F.lit(10.0)),
        linear(F.lit(30.0), "calculations"), linear(F.lit(31.0), "interactivity"),
    ).first()
    assert tuple(row) == (28.9, 45.8, 100.0, 50.0, 100.0)


def test_unique_names_avoid_natural_ones(spark):
    listed = spark.createDataFrame(
        [(1, i, n) for i, n in enumerate(["a", "A ", "a_1", "a", "a_3", "a_1", "b"])], "t int, o int, n string"
    )
    rows = unique_names(listed, "t", "o", "n").orderBy("o").collect()
    assert [r.clean_name for r in rows] == ["a", "a_2", "a_1", "a_4", "a_3", "a_1_1", "b"]


def test_clean_columns(spark):
    df = spark.range(1).selectExpr("id AS `Sales Amt`", "id AS `sales-amt`", "id AS `%`")
    assert clean_columns(df).columns == ["sales_amt", "sales_amt_1", "unnamed_table"]
