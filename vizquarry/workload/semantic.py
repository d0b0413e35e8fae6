"""Queries over the semantic layer: matching, planning, translation, views."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from vizquarry import fixed
from vizquarry.functions.formulas import kind as sql_kind
from vizquarry.functions.register import register_functions
from vizquarry.functions.translate import translated
from vizquarry.operators import inline
from vizquarry.plans import publish as pub, sources as src, views as vw
from vizquarry.plans.metric_view import MetricView, duplicate_keys, metric_views
from vizquarry.session import scratch_dir
from vizquarry.sources.catalog import column_catalog
from vizquarry.workload import fixtures as fx
from vizquarry.workload.checks import check
from vizquarry.workload.estate import stored_inlined

SOURCE_SET = "all"


def _catalog(spark, sf):
    return column_catalog(spark, fx.tables(spark, sf), SOURCE_SET)


# Formulas that need one table, two tables, a table named in the field, or cannot be joined.
PLAN_CASES = """SELECT l_orderkey AS workbook_id, CAST(l_linenumber AS BIGINT) AS line, l_partkey AS part_id,
    CAST(l_suppkey % 6 AS INT) AS plan_case, CASE CAST(l_suppkey % 6 AS INT)
      WHEN 0 THEN 'SUM([Extended Price]) / ' || CAST(l_partkey % 5 AS VARCHAR(20))
      WHEN 1 THEN '[Extended Price] + [Order Date]'
      WHEN 2 THEN 'SUM([extended price]) + COUNT([Segment])'
      WHEN 3 THEN 'SUM([Account Balance (Sales Suppliers)])'
      WHEN 4 THEN 'MAX([Retail  Price]) - MIN([Size (Parts)])'
      ELSE 'COUNT([Missing ' || CAST(l_partkey % 3 AS VARCHAR(20)) || '])' END AS formula FROM lineitem"""


def _cases(spark, sf):
    return src.with_plan_key(
        fx.query(spark, sf, PLAN_CASES).select(
            "*", F.lit(SOURCE_SET).alias("source_set"), F.array(F.lit("Nations of the world: sales_nations")).alias("hints")
        )
    )


def _case_plans(spark, sf):
    """Plans of the cases, each once, with the number of calculations that share it."""
    def build():
        keyed = _cases(spark, sf)
        counts = keyed.groupBy("plan_key").agg(F.count(F.lit(1)).alias("calc_count"))
        return src.plan_sources(src.plan_units(keyed), _catalog(spark, sf)).join(counts, "plan_key")

    return fx.stored(spark, sf, "case-plans", build)


def column_match(spark, sf):
    keyed = _cases(spark, sf)
    refs = src.references(src.plan_units(keyed))
    used = (
        keyed.select("plan_key").join(refs, "plan_key").groupBy("ref").agg(F.count(F.lit(1)).alias("calc_count"))
    )
    return src.match_columns(refs, _catalog(spark, sf)).join(used, "ref").select(
        "ref", "table_name", "column_name", "calc_count"
    )


def column_match_tagged(spark, sf):
    refs = src.references(src.plan_units(_cases(spark, sf)))
    catalog = _catalog(spark, sf)
    unmatched = refs.join(src.match_columns(refs, catalog), ["source_set", "ref"], "left_anti")
    return src.match_tagged(unmatched, catalog).select("ref", "table_name", "column_name")


def choose_base_table(spark, sf):
    plans = _case_plans(spark, sf).select("plan_key", "base")
    return _cases(spark, sf).join(plans, "plan_key").groupBy("plan_case", "base").agg(
        F.count(F.lit(1)).alias("calc_count")
    )


def infer_joins(spark, sf):
    return _case_plans(spark, sf).select(
        "formula",
        "base",
        F.array_join(F.transform("joins", lambda j: j["source"]), ",").alias("joined"),
        F.array_join(F.transform("joins", lambda j: j["on"]), ";").alias("condition"),
        F.array_join("notes", ";").alias("notes"),
        F.coalesce("fatal", F.lit("")).alias("fatal"),
        "calc_count",
    )


def column_map(spark, sf):
    return _case_plans(spark, sf).select("formula", F.inline("colmap"))


def _raw_plans(spark, sf):
    """Every calculation as written (references not inlined), planned and translated."""
    def build():
        keyed = src.with_plan_key(
            fx.view(spark, sf, "wb_calcs")
            .withColumn("formula", F.replace("formula", F.lit("/* c */"), F.lit("")))
            .select("workbook_id", F.col("calc_ord").cast("bigint").alias("calc_ord"), "formula",
                    F.lit(SOURCE_SET).alias("source_set"), F.array("datasource").alias("hints"))
        )
        plans = vw.translate_plans(src.plan_sources(src.plan_units(keyed), _catalog(spark, sf)))
        return keyed.select("workbook_id", "calc_ord", "plan_key").join(plans, "plan_key")

    return build()


def translate_corpus(spark, sf):
    return _raw_plans(spark, sf).select("workbook_id", "calc_ord", "expr")


def classify_kind(spark, sf):
    plans = fx.stored(spark, sf, "raw-plans", lambda: _raw_plans(spark, sf))
    return plans.select(
        "workbook_id", "calc_ord", F.when(F.col("expr").isNotNull(), sql_kind("expr")).alias("kind")
    )


def _views(spark, sf):
    calcs = inline.dedupe_calcs(stored_inlined(spark, sf)).withColumn("source_set", F.lit(SOURCE_SET))
    return vw.build_views(calcs, _catalog(spark, sf))


def planned_views(spark, sf):
    """The views of the estate, planned once per application.

    Calculations and plans are stored by then; texts of definitions are long and follow from them, so they aren't, and a
    query works out the columns that it looks at.
    """
    return fx.once(spark, sf, "views", lambda: _views(spark, sf))


def build_views(spark, sf):
    return _views(spark, sf).select(
        "workbook_id", "name", "calc_id", "view_name", "kind", "status", "source_table",
        F.size("joins").cast("bigint").alias("n_joins"),
    )


def calc_status(spark, sf):
    return planned_views(spark, sf).select("workbook_id", "calc_id", "status")


def definition_text(spark, sf):
    return planned_views(spark, sf).where("definition IS NOT NULL").select(
        "workbook_id", "calc_id", "kind", F.get(F.split("definition", "\n"), F.lit(2)).alias("source_line"),
        F.element_at(F.split("definition", "\n"), -1).alias("last_line"),
        F.size(F.split("definition", "\n")).cast("bigint").alias("n_lines"),
        F.get(F.split("sql", "\n"), F.lit(0)).alias("ddl_line"),
    )


SAME_NAMES = """SELECT workbook_id, calc_ord AS ord, calc_id,
    CASE WHEN template = 0 THEN '%' WHEN template = 1 THEN '2nd: ' ELSE 'Calc #' END
    || CASE WHEN template = 0 THEN '' ELSE right(caption, 1) END AS name FROM wb_calcs"""


def view_slugs(spark, sf):
    return vw.with_slugs(fx.query(spark, sf, SAME_NAMES)).select(
        "workbook_id", F.col("ord").cast("bigint").alias("ord"), "slug"
    )


def publish_dry_run(spark, sf):
    return pub.publish_dry_run(planned_views(spark, sf)).select(
        "workbook_id", "view_name", "status",
        F.regexp_extract(F.coalesce("error", F.lit("")), "unsupported: (.*)$", 1).alias("refused"),
    )


MOST_MEMBERS = 9
_PUBLICATIONS: dict[tuple, pub.Publication] = {}


def _publication(spark, sf):
    """All views of the estate, evaluated by return flag, once per application."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _PUBLICATIONS:
        path = os.path.join(scratch_dir(spark), f"published-{uuid.uuid4().hex}")
        _PUBLICATIONS[key] = pub.publish(planned_views(spark, sf), fx.tables(spark, sf), path, lambda base: ["return_flag"])
    return _PUBLICATIONS[key]


def publish_live(spark, sf):
    status = _publication(spark, sf).statuses(planned_views(spark, sf))
    return status.select(
        "workbook_id", "view_name", "status",
        F.when(F.col("status") == "skipped", F.regexp_extract("error", "unsupported: (.*)$", 1)).otherwise("").alias("refused"),
        F.coalesce(F.length("error") > 0, F.lit(False)).alias("has_error"),
    )


def publish_values(spark, sf):
    rows = _publication(spark, sf).results(planned_views(spark, sf), MOST_MEMBERS)
    value = F.round(F.col("value").cast("double"), 2)
    return rows.select("workbook_id", "view_name", F.col("dims")["return_flag"].alias("return_flag"), "member", value.alias("value"))


# ---- evaluated views -------------------------------------------------------------------------------------

EVALUATED = {
    "unit_price": "SUM([Extended Price]) / SUM([Quantity])",
    "size_class": 'IF [Quantity] > 40 THEN "big" ELSEIF [Quantity] > 20 THEN "mid" ELSE "small" END',
    "sales_per_customer": "SUM([Extended Price]) / COUNTD([Customer Id])",
    "urgent_sales": 'SUM(IIF([Order Priority] = "1-URGENT", [Extended Price], 0))',
}
_VIEWS: dict[tuple, dict[str, MetricView]] = {}


def views_for(spark, sf, formulas: dict[str, str]) -> dict[str, MetricView]:
    """Plans of a fixed list of formulas, made once per application."""
    key = (spark.sparkContext.applicationId, sf, tuple(formulas))
    if key not in _VIEWS:
        _VIEWS[key] = metric_views(spark, formulas, fx.tables(spark, sf))
    return _VIEWS[key]


def mv_measure(spark, sf):
    view = views_for(spark, sf, EVALUATED)["unit_price"]
    return view.select("return_flag").select("return_flag", F.round("unit_price", 6).alias("unit_price"))


def mv_dimension(spark, sf):
    return views_for(spark, sf, EVALUATED)["size_class"].select()


def mv_source_fields(spark, sf):
    view = views_for(spark, sf, EVALUATED)["unit_price"]
    return view.select("supplier_id", "line_status").select(
        "supplier_id", "line_status", F.round("unit_price", 6).alias("unit_price")
    )


def mv_join_measure(spark, sf):
    view = views_for(spark, sf, EVALUATED)["sales_per_customer"]
    return view.select("return_flag").select(
        "return_flag", F.round("sales_per_customer", 4).alias("sales_per_customer")
    )


def mv_star_join(spark, sf):
    view = views_for(spark, sf, EVALUATED)["urgent_sales"]
    return view.select(F.col("sales_orders.order_priority").alias("order_priority"), "line_status").select(
        "order_priority", "line_status", F.round("urgent_sales", 2).alias("urgent_sales")
    )


def join_key_check(spark, sf):
    found = fx.tables(spark, sf)
    checked = [("sales_orders", ["order_id"]), ("sales_lines", ["order_id", "line_number"])]
    return duplicate_keys(found["sales_lines"], checked[1][1]).select(
        F.lit("sales_lines").alias("table_name"), "order_id", F.col("line_number").cast("bigint").alias("line_number"),
        "row_count",
    ).unionByName(
        duplicate_keys(found["sales_orders"], checked[0][1]).select(
            F.lit("sales_orders").alias("table_name"), "order_id", F.lit(0).cast("bigint").alias("line_number"),
            "row_count",
        )
    )


_COLUMNS = {n: n.lower().replace(" ", "_") for n in ("Extended Price", "Discount", "Quantity", "Order Id", "Ship Date")}
_COLUMN_MAP = ", ".join(f"'{k}', '{v}'" for k, v in _COLUMNS.items())


def sql_udf_translate(spark, sf):
    fx.load(spark, sf)
    register_functions(spark)
    fx.view(spark, sf, "wb_calcs").createOrReplaceTempView("estate_calcs")
    return spark.sql(f"""SELECT workbook_id, calc_ord, formula_to_sql(raw) AS expr, formula_to_sql(raw, columns) AS mapped,
        formula_kind(formula_to_sql(raw, columns)) AS kind, coalesce(formula_refusal(raw), '') AS reason
        FROM (SELECT workbook_id, CAST(calc_ord AS BIGINT) AS calc_ord, formula || ' // {{x}} LOOKUP(' AS raw,
        map({_COLUMN_MAP}) AS columns FROM estate_calcs)""")


PLUS = """SELECT workbook_id, CAST(calc_ord AS BIGINT) AS calc_ord,
    CASE WHEN template % 2 = 0 THEN '[Return Flag] + "' || caption || '"' ELSE '"a + b" = [Return Flag]' END
    AS formula FROM wb_calcs"""
CARET = """SELECT workbook_id, CAST(calc_ord AS BIGINT) AS calc_ord,
    CASE WHEN template % 2 = 0 THEN '[Quantity] ^ ' || CAST(template AS VARCHAR(20)) ELSE '"a^b" = [Return Flag]' END
    AS formula FROM wb_calcs"""


def _notes(spark, sf, sql):
    t = translated("formula", F.lit("{}"))
    return fx.query(spark, sf, sql).withColumn("t", t).select(
        "workbook_id", "calc_ord", "t.expr", F.array_join("t.notes", ";").alias("notes")
    )


def note_string_plus(spark, sf):
    return _notes(spark, sf, PLUS)


def note_caret(spark, sf):
    return _notes(spark, sf, CARET)


QUERIES = {
    f.__name__: f
    for f in (
        column_match, column_match_tagged, choose_base_table, infer_joins, column_map, translate_corpus,
        classify_kind, build_views, calc_status, definition_text, view_slugs, publish_dry_run, publish_live, publish_values,
        mv_measure, mv_dimension, mv_source_fields, mv_join_measure, mv_star_join, join_key_check,
        sql_udf_translate, note_string_plus, note_caret,
    )
}

_NORM = "trim(regexp_replace(lower({c}), '[^0-9a-z]+', '_', 'g'), '_')"
_CASE_REFS = f"""SELECT ref, count(*) AS calc_count FROM ({PLAN_CASES}) p JOIN (VALUES (0, 'Extended Price'),
    (1, 'Extended Price'), (1, 'Order Date'), (2, 'extended price'), (2, 'Segment'),
    (3, 'Account Balance (Sales Suppliers)'), (4, 'Retail Price'), (4, 'Size (Parts)')) AS r(c, ref)
    ON r.c = p.plan_case GROUP BY ref"""
_BASES = "(VALUES (0, 'sales_lines'), (1, 'sales_lines'), (2, 'sales_lines'), (3, 'sales_suppliers')," \
    " (4, 'sales_parts'), (5, 'sales_nations')) AS b(c, base)"
_ON = "source.order_id = sales_orders.order_id"
_NO_KEYS = fixed.FATAL_NO_KEYS % ("Segment", "sales_customers", "sales_lines")
_JOIN_NOTE = (fixed.NOTE_JOINED % ("sales_orders", "sales_orders", "order_id")).replace("'", "''")
_MISSING = "(regexp_extract(formula, 'Missing [0-9]'))"
_LINK = "CASE WHEN ref_ord IS NULL THEN '' ELSE ' + Calculation_' || ref_ord END"
_EXPR = """CASE template WHEN 0 THEN 'SUM({ep})' WHEN 1 THEN 'COALESCE({d}, 0) * {ep}'
    WHEN 5 THEN 'CASE WHEN {q} > 10 THEN ''big'' WHEN {q} > 5 THEN ''mid'' ELSE ''small'' END'
    WHEN 6 THEN 'COUNT(DISTINCT {o})' WHEN 7 THEN 'DATE_TRUNC(''MONTH'', {s})'
    WHEN 9 THEN '{div}' END"""
_MAPPED = _EXPR.format(ep="extended_price", d="discount", q="quantity", o="order_id", s="ship_date",
                       div="SUM(extended_price) / SUM(quantity)")
_QUOTED = _EXPR.format(ep="`Extended Price`", d="Discount", q="Quantity", o="`Order Id`", s="`Ship Date`",
                       div="SUM(`Extended Price`) / SUM(Quantity)")
# What a chain of calculations is made of. Sums of sums and sums of numbers can be evaluated, and any single one.
_STATES = """(SELECT c.*, 'sales_lines.mv_' || c.slug AS view_name, t.templates, t.n_chain FROM calc_states c JOIN
    (SELECT workbook_id, start_ord, list_sort(list_distinct(list(template))) AS templates, count(*) AS n_chain
     FROM calc_chain GROUP BY workbook_id, start_ord) t ON t.workbook_id = c.workbook_id AND t.start_ord = c.calc_ord)"""
_CREATED = "(status = 'ok' AND (list_has_all([0, 6, 9], templates) OR templates = [1] OR n_chain = 1))"
_JOINED = "sales_lines l LEFT JOIN sales_orders o ON o.order_id = l.order_id"

CHECKS = {
    "column_match": f"""SELECT ref, table_name, column_name, calc_count FROM ({_CASE_REFS}) r
        JOIN table_columns c ON {_NORM.format(c='ref')} = {_NORM.format(c='column_name')}""",
    "column_match_tagged": f"""SELECT DISTINCT ref, t.table_name, t.column_name FROM ({_CASE_REFS}) r JOIN (VALUES
        ('Account Balance (Sales Suppliers)', 'sales_suppliers', 'account_balance'),
        ('Size (Parts)', 'sales_parts', 'size')) AS t(name, table_name, column_name) ON t.name = r.ref""",
    "choose_base_table": f"""SELECT plan_case, base, count(*) AS calc_count FROM ({PLAN_CASES}) p
        JOIN {_BASES} ON b.c = p.plan_case GROUP BY plan_case, base""",
    "infer_joins": f"""SELECT formula, base, CASE plan_case WHEN 1 THEN 'sales_orders' ELSE '' END AS joined,
        CASE plan_case WHEN 1 THEN '{_ON}' ELSE '' END AS condition,
        CASE plan_case WHEN 1 THEN '{_JOIN_NOTE}'
          WHEN 5 THEN 'column [' || {_MISSING} || '] not found in any source table' ELSE '' END AS notes,
        CASE plan_case WHEN 2 THEN '{_NO_KEYS}' ELSE '' END AS fatal, count(*) AS calc_count
        FROM ({PLAN_CASES}) p JOIN {_BASES} ON b.c = p.plan_case GROUP BY formula, base, plan_case""",
    "column_map": f"""SELECT DISTINCT formula, ref, "sql" FROM ({PLAN_CASES}) p JOIN (VALUES
        (0, 'Extended Price', 'extended_price'), (1, 'Extended Price', 'extended_price'),
        (1, 'Order Date', 'sales_orders.order_date'),
        (3, 'Account Balance (Sales Suppliers)', 'account_balance'), (4, 'Retail Price', 'retail_price'),
        (4, 'Size (Parts)', 'size')) AS m(c, ref, "sql") ON m.c = p.plan_case
        UNION ALL SELECT DISTINCT formula, {_MISSING}, '`' || {_MISSING} || '`'
        FROM ({PLAN_CASES}) p WHERE plan_case = 5""",
    "translate_corpus": f"""SELECT workbook_id, CAST(calc_ord AS BIGINT) AS calc_ord, {_MAPPED} || {_LINK} AS expr
        FROM wb_calcs""",
    "classify_kind": """SELECT workbook_id, CAST(calc_ord AS BIGINT) AS calc_ord, CASE WHEN template IN (0, 6, 9)
        THEN 'measure' WHEN template IN (1, 5, 7) THEN 'dimension' END AS kind FROM wb_calcs""",
    "build_views": """SELECT workbook_id, caption AS name, calc_id, 'sales_lines.mv_' || slug AS view_name, kind,
        status, 'sales_lines' AS source_table, CAST(0 AS BIGINT) AS n_joins FROM calc_states""",
    "calc_status": "SELECT workbook_id, calc_id, status FROM calc_states",
    "definition_text": """SELECT workbook_id, calc_id, kind, 'source: "sales_lines"' AS source_line,
        '    display_name: "' || CASE kind WHEN 'measure' THEN caption ELSE 'Record Count' END || '"' AS last_line,
        CAST(CASE kind WHEN 'measure' THEN 7 ELSE 11 END AS BIGINT) AS n_lines,
        'CREATE OR REPLACE VIEW `sales_lines`.`mv_' || slug || '` WITH METRICS LANGUAGE YAML AS' AS ddl_line
        FROM calc_states WHERE status <> 'unsupported'""",
    "view_slugs": f"""SELECT workbook_id, CAST(ord AS BIGINT) AS ord, slug || CASE WHEN n = 1 THEN ''
        ELSE '_' || right(regexp_replace(lower(calc_id), '[^0-9a-z]+', '', 'g'), 6) END AS slug
        FROM (SELECT *, row_number() OVER (PARTITION BY workbook_id, slug ORDER BY ord) AS n FROM
        (SELECT *, CASE WHEN name = '%' THEN 'calc' WHEN name LIKE '2nd%' THEN '_2nd_' || lower(right(name, 1))
          ELSE 'calc_' || lower(right(name, 1)) END AS slug FROM ({SAME_NAMES})))""",
    "publish_dry_run": """SELECT workbook_id, 'sales_lines.mv_' || slug AS view_name,
        CASE status WHEN 'unsupported' THEN 'skipped' ELSE 'dry_run' END AS status, coalesce(label, '') AS refused
        FROM calc_states""",
    "publish_live": f"""SELECT workbook_id, view_name,
        CASE WHEN status = 'unsupported' THEN 'skipped' WHEN {_CREATED} THEN 'created' ELSE 'failed' END AS status,
        coalesce(label, '') AS refused, status = 'unsupported' OR NOT {_CREATED} AS has_error FROM {_STATES}""",
    "publish_values": f"""SELECT workbook_id, view_name, return_flag, NULL::VARCHAR AS member, round(sum(value), 2) AS value FROM
        (SELECT s.workbook_id, s.view_name, v.return_flag, CASE c.template WHEN 0 THEN v.total
          WHEN 6 THEN v.n_orders ELSE v.ratio END AS value
          FROM {_STATES} s JOIN calc_chain c ON c.workbook_id = s.workbook_id AND c.start_ord = s.calc_ord
          CROSS JOIN (SELECT return_flag, sum(extended_price) AS total, count(DISTINCT order_id)::DOUBLE AS n_orders,
            sum(extended_price) / sum(quantity) AS ratio FROM sales_lines GROUP BY return_flag) v
          WHERE {_CREATED} AND s.kind = 'measure') GROUP BY ALL
        UNION ALL SELECT s.workbook_id, s.view_name, v.return_flag, v.member, v.n FROM {_STATES} s,
          (SELECT return_flag, CASE WHEN quantity > 10 THEN 'big' WHEN quantity > 5 THEN 'mid' ELSE 'small' END AS member,
            count(*)::DOUBLE AS n FROM sales_lines GROUP BY 1, 2) v
          WHERE {_CREATED} AND s.templates = [5]
        UNION ALL SELECT s.workbook_id, s.view_name, NULL, NULL, v.n FROM {_STATES} s,
          (SELECT count(*)::DOUBLE AS n FROM sales_lines) v
          WHERE {_CREATED} AND s.kind = 'dimension' AND s.templates <> [5]""",
    "mv_measure": """SELECT return_flag, round(sum(extended_price) / sum(quantity), 6) AS unit_price
        FROM sales_lines GROUP BY return_flag""",
    "mv_dimension": """SELECT CASE WHEN quantity > 40 THEN 'big' WHEN quantity > 20 THEN 'mid' ELSE 'small' END
        AS size_class, count(*) AS record_count FROM sales_lines GROUP BY 1""",
    "mv_source_fields": """SELECT supplier_id, line_status, round(sum(extended_price) / sum(quantity), 6) AS unit_price
        FROM sales_lines GROUP BY supplier_id, line_status""",
    "mv_join_measure": f"""SELECT return_flag, round(sum(extended_price) / count(DISTINCT customer_id), 4)
        AS sales_per_customer FROM {_JOINED} GROUP BY return_flag""",
    "mv_star_join": f"""SELECT order_priority, line_status, round(sum(CASE WHEN order_priority = '1-URGENT'
        THEN extended_price ELSE 0 END), 2) AS urgent_sales FROM {_JOINED} GROUP BY order_priority, line_status""",
    "join_key_check": """SELECT 'sales_lines' AS table_name, order_id, CAST(line_number AS BIGINT) AS line_number,
        count(*) AS row_count FROM sales_lines GROUP BY order_id, line_number HAVING count(*) > 1
        UNION ALL SELECT 'sales_orders', order_id, 0, count(*) FROM sales_orders GROUP BY order_id
        HAVING count(*) > 1""",
    "sql_udf_translate": f"""SELECT workbook_id, CAST(calc_ord AS BIGINT) AS calc_ord, {_QUOTED} || {_LINK} AS expr,
        {_MAPPED} || {_LINK} AS mapped,
        CASE WHEN template IN (0, 6, 9) THEN 'measure' WHEN template IN (1, 5, 7) THEN 'dimension' END AS kind,
        CASE template WHEN 2 THEN 'LOD expression (FIXED/INCLUDE/EXCLUDE)' WHEN 8 THEN 'Tableau parameter reference'
        WHEN 11 THEN 'DATEPARSE (format strings differ)' WHEN 3 THEN 'table calculation'
        WHEN 4 THEN 'table calculation' WHEN 10 THEN 'table calculation' ELSE '' END AS reason FROM wb_calcs""",
    "note_string_plus": f"""SELECT workbook_id, CAST(calc_ord AS BIGINT) AS calc_ord,
        CASE WHEN template % 2 = 0 THEN '`Return Flag` + ''' || caption || ''''
             ELSE '''a + b'' = `Return Flag`' END AS expr,
        CASE WHEN template % 2 = 0 THEN '{fixed.NOTE_STRING_PLUS.replace("'", "''")}' ELSE '' END AS notes
        FROM wb_calcs""",
    "note_caret": f"""SELECT workbook_id, CAST(calc_ord AS BIGINT) AS calc_ord,
        CASE WHEN template % 2 = 0 THEN 'Quantity ^ ' || template ELSE '''a^b'' = `Return Flag`' END AS expr,
        CASE WHEN template % 2 = 0 THEN '{fixed.NOTE_CARET.replace("'", "''")}' ELSE '' END AS notes FROM wb_calcs""",
}
CHECKS = {k: check(v) for k, v in CHECKS.items()}
