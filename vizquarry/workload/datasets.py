"""Queries for dashboard datasets."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from vizquarry.operators.sketches import DISTINCT_ERROR, RANK_ERROR, SketchStore
from vizquarry.plans import dashboards as dash
from vizquarry.session import scratch_dir
from vizquarry.workload import fixtures as fx
from vizquarry.workload.checks import check
from vizquarry.workload.ingest import manifest


def _lines(spark, sf):
    return fx.view(spark, sf, "sales_lines")


def profile_columns(spark, sf):
    return dash.profile_columns(_lines(spark, sf), "sales_lines", "exact").withColumn(
        "column_ord", F.col("column_ord").cast("bigint")
    )


def profile_columns_approx(spark, sf):
    return dash.profile_columns(_lines(spark, sf), "sales_lines").select("column_name", "shape", "non_null_count")


def sketch_profile(spark, sf):
    """Profiles merged from the sketches of batches, beside what the rows say: their errors are within the bounds."""
    lines = _lines(spark, sf)
    store = SketchStore(spark, os.path.join(scratch_dir(spark), f"sketches-{uuid.uuid4().hex}"))
    flags = sorted(r.return_flag for r in lines.select("return_flag").distinct().collect())  # a batch for each of a few flags
    for flag in [*flags, flags[0]]:  # the first comes a second time
        store.add(lines.where(F.col("return_flag") == flag), "sales_lines", flag, F.date_trunc("month", "ship_date"))
    merged = store.merged()
    found = {r.column_name: r for r in merged.collect()}  # a row for each column
    exact = dash.profile_columns(lines, "sales_lines", "exact").select("column_name", F.col("distinct_count").alias("exact_count"))
    numbers = [c for c, r in found.items() if r.quantiles]
    below = lines.agg(*[F.avg((F.col(c) < found[c].quantiles[0]).cast("int")).alias(f"l_{c}") for c in numbers],
                      *[F.avg((F.col(c) <= found[c].quantiles[0]).cast("int")).alias(f"h_{c}") for c in numbers])
    ranks = below.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"l_{c}").alias("low"), F.col(f"h_{c}").alias("high")) for c in numbers])))
    middle = (F.col("low") <= 0.5 + RANK_ERROR) & (F.col("high") >= 0.5 - RANK_ERROR)
    return merged.join(exact, "column_name").join(ranks, "column_name", "left").select(
        "column_name", "row_count", "non_null_count", "exact_count",
        (F.abs(F.col("distinct_count") - F.col("exact_count")) <= F.greatest(F.lit(1.0), DISTINCT_ERROR * F.col("exact_count"))).alias("distinct_close"),
        middle.alias("middle_close"),
    )


def dash_kpi(spark, sf):
    return dash.kpi(
        _lines(spark, sf),
        {"lines": "count(*)", "total": "round(sum(extended_price), 2)", "largest": "max(quantity)"},
    )


def dash_categories(spark, sf):
    return dash.categories(
        _lines(spark, sf), "part_id", {"lines": "count(*)", "units": "sum(quantity)"}, "units", 20
    )


def dash_timeseries(spark, sf):
    return dash.series(
        _lines(spark, sf), "ship_date", "month", {"lines": "count(*)", "total": "round(sum(extended_price), 2)"}
    )


def dash_detail(spark, sf):
    return dash.detail(
        _lines(spark, sf), ["order_id", "line_number", "part_id", "supplier_id", "quantity", "extended_price"],
        ["extended_price", "order_id", "line_number", "part_id", "supplier_id", "quantity"], 100,
    ).withColumn("line_number", F.col("line_number").cast("bigint"))


def dash_filter_values(spark, sf):
    return dash.filter_values(_lines(spark, sf), ["return_flag", "line_status", "line_number"])


def dash_empty_tables(spark, sf):
    return dash.empty_tables(manifest(spark, sf)).select("table_name", "row_count", "reason")


def dash_widget_plan(spark, sf):
    found = fx.tables(spark, sf)
    profiles = [dash.profile_columns(found[t], t, "exact") for t in ("sales_orders", "sales_customers")]
    return dash.union_all([dash.widget_plan(p, category_limit=10) for p in profiles])


USED = """SELECT DISTINCT workbook_id, lower(replace(replace(trim(table_name, '_'), ' ', '_'), '-', '_')) AS table_name
    FROM wb_extract_tables"""


def dash_scope_check(spark, sf):
    used = fx.query(spark, sf, USED.replace("trim(table_name, '_')", "btrim(table_name, '_')"))
    listed = fx.tables(spark, sf)
    names = spark.createDataFrame([(n,) for n in listed], "table_name string")
    return dash.out_of_scope(used, names).select("workbook_id", "table_name")


QUERIES = {
    f.__name__: f
    for f in (
        profile_columns, profile_columns_approx, sketch_profile, dash_kpi, dash_categories, dash_timeseries, dash_detail,
        dash_filter_values, dash_empty_tables, dash_widget_plan, dash_scope_check,
    )
}

_LINE_COLUMNS = {
    "order_id": ("bigint", "numeric"), "part_id": ("bigint", "numeric"), "supplier_id": ("bigint", "numeric"),
    "line_number": ("int", "numeric"), "quantity": ("double", "numeric"), "extended_price": ("double", "numeric"),
    "discount": ("double", "numeric"), "tax": ("double", "numeric"), "return_flag": ("string", "text"),
    "line_status": ("string", "text"), "ship_date": ("timestamp_ntz", "temporal"),
}


def _profile_row(i: int, c: str) -> str:
    kind, shape = _LINE_COLUMNS[c]
    number = [f"CAST({f}({c}) AS DOUBLE)" if shape == "numeric" else "CAST(NULL AS DOUBLE)" for f in ("min", "max")]
    text = {"numeric": "CAST(NULL AS VARCHAR)", "text": "{f}({c})", "temporal": "strftime({f}({c}), '%Y-%m-%d %H:%M:%S')"}
    low, high = (text[shape].format(f=f, c=c) for f in ("min", "max"))
    return (
        f"SELECT 'sales_lines' AS table_name, CAST({i} AS BIGINT) AS column_ord, '{c}' AS column_name,"
        f" '{kind}' AS column_type, '{shape}' AS shape, count({c}) AS non_null_count,"
        f" count(DISTINCT {c}) AS distinct_count, {number[0]} AS min_number, {number[1]} AS max_number,"
        f" {low} AS min_text, {high} AS max_text FROM sales_lines"
    )


def _widget(table: str, column: str, shape: str) -> str:
    low = f"(SELECT count(DISTINCT {column}) <= 10 FROM {table})"
    widget = {"numeric": "'kpi'", "temporal": "'series'"}.get(
        shape, f"CASE WHEN {low} THEN 'category' ELSE 'detail' END"
    )
    is_filter = low if shape == "text" else "false"
    return f"SELECT '{table}' AS table_name, '{column}' AS column_name, {widget} AS widget, {is_filter} AS is_filter"


_WIDGETS = {
    "sales_orders": "order_id:numeric customer_id:numeric order_status:text total_price:numeric"
    " order_date:temporal order_priority:text",
    "sales_customers": "customer_id:numeric customer_name:text nation_id:numeric account_balance:numeric segment:text",
}

CHECKS = {
    "profile_columns": " UNION ALL ".join(_profile_row(i, c) for i, c in enumerate(_LINE_COLUMNS, 1)),
    "profile_columns_approx": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{s}' AS shape, count({c}) AS non_null_count FROM sales_lines"
        for c, (_, s) in _LINE_COLUMNS.items()
    ),
    "sketch_profile": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS row_count, count({c}) AS non_null_count, count(DISTINCT {c}) AS exact_count,"
        f" true AS distinct_close, {'true' if s == 'numeric' else 'CAST(NULL AS BOOLEAN)'} AS middle_close FROM sales_lines"
        for c, (_, s) in _LINE_COLUMNS.items()
    ),
    "dash_kpi": """SELECT count(*) AS lines, round(sum(extended_price), 2) AS total, max(quantity) AS largest
        FROM sales_lines""",
    "dash_categories": """SELECT part_id, count(*) AS lines, sum(quantity) AS units FROM sales_lines GROUP BY part_id
        ORDER BY units DESC, part_id LIMIT 20""",
    "dash_timeseries": """SELECT date_trunc('month', ship_date)::TIMESTAMP AS period, count(*) AS lines,
        round(sum(extended_price), 2) AS total FROM sales_lines GROUP BY 1""",
    "dash_detail": """SELECT order_id, CAST(line_number AS BIGINT) AS line_number, part_id, supplier_id, quantity,
        extended_price FROM sales_lines ORDER BY extended_price, order_id, sales_lines.line_number, part_id, supplier_id,
        quantity LIMIT 100""",
    "dash_filter_values": " UNION ALL ".join(
        f"SELECT DISTINCT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM sales_lines"
        for c in ("return_flag", "line_status", "line_number")
    ),
    "dash_empty_tables": """SELECT 'main.sales.rejected_orders' AS table_name, n AS row_count,
        'table has no rows' AS reason FROM (SELECT count(*) AS n FROM sales_orders WHERE total_price < 0) WHERE n = 0""",
    "dash_widget_plan": " UNION ALL ".join(
        _widget(t, *c.split(":")) for t, cols in _WIDGETS.items() for c in cols.split()
    ),
    "dash_scope_check": f"""SELECT workbook_id, table_name FROM ({USED}) u
        WHERE table_name NOT IN ('sales_lines', 'sales_orders')""",
}
CHECKS = {k: check(v) for k, v in CHECKS.items()}
