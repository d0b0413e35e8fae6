import pytest
from pyspark.sql import functions as F

from vizquarry.functions.register import register_functions
from vizquarry.plans import dashboards as dash, views as vw
from vizquarry.plans.metric_view import MetricView, duplicate_keys, metric_views, plan_formulas, resolve_measures
from vizquarry.plans.publish import publish


@pytest.fixture(scope="module")
def tables(spark):
    return {
        "main.s.lines": spark.sql("SELECT id AS order_id, id % 3 AS part_id, id * 1.0D AS price, id % 2 AS qty FROM range(12)"),
        "main.s.orders": spark.sql("SELECT id AS order_id, id % 4 AS customer_id, 'o' || id % 2 AS status FROM range(10)"),
        "main.t.parts": spark.sql("SELECT id AS part_id, 'p' || id AS `Part Name`, id AS size FROM range(3)"),
        "main.u.parts": spark.sql("SELECT id AS order_id, id AS weight FROM range(3)"),
        "main.s.customers": spark.sql("SELECT id AS customer_id, 'seg' || id AS segment, id AS size FROM range(4)"),
    }


FORMULAS = {
    "plain": "SUM([Price]) / SUM([Qty])",
    "one join": "SUM([Price]) + COUNTD([Status])",
    "two joins": 'SUM(IIF([Part Name] = "p1", [Price], 0)) + COUNT([Weight]) + COUNT([Status])',
    "no keys": "SUM([Price]) + COUNTD([Status]) + COUNT([Segment]) + COUNT([Nope])",
    "tagged": "COUNT([Part Name (T Parts)])",
    "tagged like a call": "MAX([Size (Customers)])",
    "nothing": "1 + [Nope]",
    "refused": "INDEX()",
}


@pytest.fixture(scope="module")
def planned(spark, tables):
    return {r.name: r for r in plan_formulas(spark, FORMULAS, tables, ["Lines"]).collect()}


def test_base_and_single_join(planned):
    assert planned["plain"].source_table == "main.s.lines" and planned["plain"].status == "ok"
    row = planned["one join"]
    assert [j["on"] for j in row.joins] == ["source.order_id = orders.order_id"]
    assert row.status == "needs_review" and "verify it is many-to-one" in row.notes[0]
    assert row.view_name == "main.s.mv_one_join" and row.kind == "measure"


def test_aliases_of_equal_short_names_differ(planned):
    assert [(j["name"], j["source"], j["on"]) for j in planned["two joins"].joins] == [
        ("parts", "main.t.parts", "source.part_id = parts.part_id"),
        ("parts_j", "main.u.parts", "source.order_id = parts_j.order_id"),
        ("orders", "main.s.orders", "source.order_id = orders.order_id"),
    ]


def test_fatal_keeps_earlier_notes_only(planned):
    row = planned["no keys"]
    assert row.status == "unsupported" and row.joins == [] and row.expr is None
    assert len(row.notes) == 2 and row.notes[0].startswith("joined main.s.orders")
    assert row.notes[1] == (
        "unsupported: [Segment] is in main.s.customers, which shares no column with main.s.lines to join on"
    )


def test_tagged_and_unknown(planned):
    assert planned["tagged"].source_table == "main.t.parts" and planned["tagged"].expr == "COUNT(`Part Name`)"
    # The detectors look at the whole text, so a field named like a refused call is refused as well.
    assert planned["tagged like a call"].source_table == "main.s.customers"
    assert planned["tagged like a call"].status == "unsupported"
    # Nothing is covered, so the hint decides before the number of columns does.
    assert planned["nothing"].source_table == "main.s.lines"
    assert planned["nothing"].notes == ["column [Nope] not found in any source table"]
    assert planned["refused"].notes == ["unsupported: table calculation"]


def test_every_unsupported_formula_has_a_note(planned):
    assert all(r.notes for r in planned.values() if r.status == "unsupported")


def test_definition_text(planned):
    lines = planned["one join"].definition.split("\n")
    assert lines[0] == "version: 1.1" and lines[2] == 'source: "main.s.lines"' and "joins:" in lines
    assert planned["nothing"].definition.split("\n")[-3:] == [
        '  - name: "record_count"', '    expr: "COUNT(1)"', '    display_name: "Record Count"',
    ]
    assert planned["plain"].sql.startswith("CREATE OR REPLACE VIEW `main`.`s`.`mv_plain` WITH METRICS LANGUAGE YAML AS\n$$\n")


def test_view_over_two_joins(spark, tables):
    view = metric_views(spark, {"v": FORMULAS["two joins"]}, tables)["v"]
    got = view.select("qty", F.col("orders.status").alias("status")).collect()
    want = {}
    for i in range(12):
        key = (i % 2, f"o{i % 2}" if i < 10 else None)
        want[key] = want.get(key, 0) + (float(i) if i % 3 == 1 else 0) + (1 if i < 3 else 0) + (1 if i < 10 else 0)
    assert {(r.qty, r.status): r.v for r in got} == want


def test_dimension_view_and_division_by_zero(spark, tables):
    view = metric_views(spark, {"ratio": "[Price] / [Qty]"}, tables)["ratio"]
    assert view.kind == "dimension"
    assert sum(r.record_count for r in view.select().collect()) == 12
    assert {r.ratio is None for r in view.rows("qty").where("qty = 0").collect()} == {True}


def test_duplicate_keys(spark, tables):
    assert duplicate_keys(tables["main.s.orders"], ["order_id"]).isEmpty()
    assert duplicate_keys(tables["main.s.orders"], ["customer_id"]).count() == 4
    view = metric_views(spark, {"v": FORMULAS["one join"]}, tables)["v"]
    assert view.duplicate_keys()["orders"].isEmpty()


def test_measure_reference():
    assert resolve_measures("MEASURE(a) / measure( `b` ) + MEASURE(c)", {"a": "SUM(x)", "b": "COUNT(1)"}) == (
        "(SUM(x)) / (COUNT(1)) + MEASURE(c)"
    )


def test_refused_view_raises(planned, tables):
    with pytest.raises(ValueError, match="table calculation"):
        MetricView.of(planned["refused"], tables)


def test_slugs(spark):
    rows = [(1, 0, "Sales", "Calc_111111"), (1, 1, "sales", "Calc_222222"), (1, 2, "Sales 222222", "Calc_333333"),
            (2, 0, "Sales", "x"), (1, 3, "%", "y"), (1, 4, "2 x", "z"), (1, 5, "Sales 222222 333333", "Calc_444444")]
    got = vw.with_slugs(spark.createDataFrame(rows, "workbook_id int, ord int, name string, calc_id string"))
    assert {(r.workbook_id, r.ord): r.slug for r in got.collect()} == {
        (1, 0): "sales", (1, 1): "sales_222222", (1, 2): "sales_222222_333333", (2, 0): "sales",
        (1, 3): "calc", (1, 4): "_2_x", (1, 5): "sales_222222_333333_444444",
    }


def test_publish_goes_on_after_a_failure(spark, tables, tmp_path):
    formulas = {"good": "SUM([Price])", "same": "SUM([Price])", "bad": "NO_SUCH_FUNCTION([Price])", "skipped": "INDEX()",
                "size": 'IF [Qty] > 0 THEN "big" ELSE "small" END', "text": 'INT("x" + STR([Qty]))', "lists": "COLLECT_SET([Qty])"}
    views = plan_formulas(spark, formulas, tables)
    for per_job in (1, 128):
        done = publish(views, tables, str(tmp_path / str(per_job)), per_job=per_job)
        got = {r.view_name.split("_", 1)[1]: (r.status, r.error) for r in done.statuses(views).collect()}
        assert got["good"] == got["same"] == got["size"] == got["lists"] == ("created", None)
        assert {got[n][0] for n in ("bad", "text")} <= {"failed", "created"} and got["bad"][0] == "failed" and got["bad"][1]
        assert got["skipped"][0] == "skipped" and "table calculation" in got["skipped"][1]
        values = {(r.view_name.split("_", 1)[1], r.member): r.value for r in done.results(views).collect()}
        assert values["good", None] == values["same", None] == "66.0" and values["lists", None].startswith("[")
        assert done.values().where("kind = 'measure'").select("definition").distinct().count() == 2  # equal views are one definition
        few = done.results(views, most_members=1).where("view_name LIKE '%size'").collect()
        assert [(r.dims, r.member, r.value) for r in few] == [(None, None, "12")]
    asked = publish(views, tables, str(tmp_path / "all"), skip_unsupported=False)
    got = {r.view_name.split("_", 1)[1]: r.status for r in asked.statuses(views, skip_unsupported=False).collect()}
    assert got["skipped"] == "skipped"  # there is no text to run at all


def test_publish_by_columns(spark, tables, tmp_path):
    views = plan_formulas(spark, {"good": "SUM([Price])", "size": "[Qty] > 2"}, tables)
    done = publish(views, tables, str(tmp_path / "x"), lambda base: ["order_id"])
    rows = done.results(views).collect()
    assert sum(float(r.value) for r in rows if r.kind == "measure") == 66.0
    assert {tuple(r.dims) for r in rows} == {("order_id",)} and len({r.dims["order_id"] for r in rows}) > 1


def test_publish_nothing(spark, tables, tmp_path):
    views = plan_formulas(spark, {"skipped": "INDEX()"}, tables)
    done = publish(views, tables, str(tmp_path / "x"))
    assert [r.status for r in done.statuses(views).collect()] == ["skipped"] and done.values().isEmpty()


def test_sql_functions(spark):
    register_functions(spark)
    row = spark.sql(
        "SELECT formula_to_sql('ZN([x])') a, formula_refusal('\"{\" + [x]') b, formula_refusal('{[x]}') c,"
        " formula_kind('SUM(x)') d, formula_kind('\\'SUM(\\'') e"
    ).first()
    assert tuple(row) == ("COALESCE(x, 0)", None, "LOD expression (FIXED/INCLUDE/EXCLUDE)", "measure", "dimension")


def test_sql_functions_read_formulas_without_comments(spark):
    register_functions(spark)
    rows = [("SUM([a b]) /* {x} */",), ("SUM([a b]) // LOOKUP(",), ("'// [x]' + [a b]",), (None,), ("/* SUM( */ [`SUM(`]",)]
    spark.createDataFrame(rows, "f string").createOrReplaceTempView("commented")
    got = spark.sql(
        "SELECT formula_text(f), formula_refusal(f), formula_to_sql(f), formula_to_sql(f, map('a b', 'c')),"
        " formula_kind(formula_to_sql(f)) FROM commented"
    ).collect()
    assert [tuple(r) for r in got] == [
        ("SUM([a b])", None, "SUM(`a b`)", "SUM(c)", "measure"),
        ("SUM([a b])", None, "SUM(`a b`)", "SUM(c)", "measure"),
        ("'// [x]' + [a b]", None, "'// [x]' + `a b`", "'// [x]' + c", "dimension"),
        (None, None, None, None, None),
        ("[`SUM(`]", None, "```SUM(```", "```SUM(```", "dimension"),
    ]


def test_translation_ignores_comments():
    from vizquarry.functions.translate import translate

    assert translate("SUM([a]) /* {x} */", {})[0] == "SUM(a)"
    assert translate("SUM([a]) // LOOKUP(", {})[0] == "SUM(a)"
    assert translate("'/* {x} */' + [a]", {})[0] == "'/* {x} */' + a"


def test_profile_and_widgets(spark):
    df = spark.sql(
        "SELECT id, 'c' || id % 3 AS cat, CAST(NULL AS string) AS nothing, DATE'2024-01-01' + CAST(id AS int) AS d,"
        " array(id) AS xs FROM range(100)"
    )
    for mode in ("exact", "approx"):
        rows = {r.column_name: r for r in dash.profile_columns(df, "t", mode).collect()}
        assert (rows["cat"].distinct_count, rows["cat"].min_text, rows["cat"].max_text) == (3, "c0", "c2")
        assert (rows["nothing"].non_null_count, rows["nothing"].distinct_count) == (0, 0)
        assert (rows["id"].min_number, rows["id"].max_number) == (0.0, 99.0)
    plan = {r.column_name: (r.widget, r.is_filter) for r in dash.widget_plan(dash.profile_columns(df, "t")).collect()}
    assert plan == {"id": ("kpi", False), "cat": ("category", True), "nothing": ("category", True),
                    "d": ("series", False), "xs": ("detail", False)}
