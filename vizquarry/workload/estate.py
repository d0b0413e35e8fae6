"""Queries over workbook facts, formula text and scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from vizquarry import fixed
from vizquarry.functions import formulas as fm
from vizquarry.functions.numbers import round1
from vizquarry.operators import elements as el, inline, metrics, score
from vizquarry.operators.depth import nesting_depth
from vizquarry.workload import fixtures as fx
from vizquarry.workload.checks import METRIC_COLUMNS, check, r1
from vizquarry.workload.ingest import workbook_scorecard, workbook_scorecard_legacy


def _keys():
    return ["workbook_id", F.col("calc_ord").cast("bigint").alias("calc_ord")]


def _calcs(spark, sf):
    return fx.view(spark, sf, "wb_calcs")


def _fields(spark, sf, variant="strict"):
    return el.calc_fields(fx.workbook_elements(spark, sf), variant)


def _depths(spark, sf):
    return fx.stored(spark, sf, "depths", lambda: nesting_depth(_fields(spark, sf)))


def calc_fields(spark, sf):
    return _fields(spark, sf).select("workbook_id", "calc_name", "formula")


def calc_records(spark, sf):
    return el.calc_records(fx.workbook_elements(spark, sf)).select(
        "workbook_id", "datasource", "calc_id", "name", "formula", "datatype", "tableau_role"
    )


def workbook_parameters(spark, sf):
    return el.parameters(fx.workbook_elements(spark, sf))


# Each formula with a line comment behind it and a quoted address on a second line.
COMMENTED = """SELECT workbook_id, calc_ord, formula,
    formula || ' // "' || caption || ''' http://c' || chr(10) || '+ "http://x" // y' AS raw FROM wb_calcs"""
SPACED = """SELECT workbook_id, calc_ord, formula,
    ' ' || replace(formula, ' ', chr(9) || '  ' || chr(10)) || chr(13) AS raw FROM wb_calcs"""


def strip_comments(spark, sf):
    return fx.query(spark, sf, COMMENTED).select(*_keys(), fm.strip_comments("raw").alias("stripped"))


def formula_key(spark, sf):
    return fx.query(spark, sf, SPACED).select(*_keys(), fm.formula_key("raw").alias("formula_key"))


def field_refs(spark, sf):
    return (
        _calcs(spark, sf)
        .select(*_keys(), F.posexplode(fm.field_refs("formula")).alias("ref_ord", "ref"))
        .withColumn("ref_ord", F.col("ref_ord").cast("bigint"))
    )


def detect_lod(spark, sf):
    return _calcs(spark, sf).select(*_keys(), fm.has_lod("formula").alias("is_lod"))


def detect_table_calc(spark, sf):
    return _calcs(spark, sf).select(*_keys(), fm.has_table_calc("formula").alias("is_table_calc"))


def classify_unsupported(spark, sf):
    return _calcs(spark, sf).select(*_keys(), F.coalesce(fm.refusal("formula"), F.lit("")).alias("reason"))


def no_equivalent_features(spark, sf):
    return metrics.no_equivalent(fx.workbook_elements(spark, sf))


def no_equivalent_legacy(spark, sf):
    return metrics.no_equivalent(fx.workbook_elements(spark, sf), "broad")


def authoring_line(spark, sf):
    return workbook_scorecard(spark, sf).select("workbook_id", "authoring_line")


def agg_data_model(spark, sf):
    return metrics.data_model(fx.workbook_elements(spark, sf))


def agg_data_model_broad(spark, sf):
    return metrics.data_model(fx.workbook_elements(spark, sf), "broad")


def agg_calculations(spark, sf):
    rows = fx.workbook_elements(spark, sf)
    return metrics.calculations(_fields(spark, sf), _depths(spark, sf), metrics.workbooks(rows))


def agg_structure(spark, sf):
    return metrics.structure(fx.workbook_elements(spark, sf))


def agg_interactivity(spark, sf):
    return metrics.interactivity(fx.workbook_elements(spark, sf), _fields(spark, sf))


def param_actions_feeding_calc(spark, sf):
    return metrics.feeding_actions(fx.workbook_elements(spark, sf), _fields(spark, sf))


def calc_nesting_depth(spark, sf):
    return nesting_depth(_fields(spark, sf)).withColumn(
        "max_calc_nesting_depth", F.col("max_calc_nesting_depth").cast("bigint")
    )


def _inlined(spark, sf):
    return inline.inline_references(el.calc_records(fx.workbook_elements(spark, sf)))


def stored_inlined(spark, sf):
    return fx.stored(spark, sf, "inlined", lambda: _inlined(spark, sf))


def inline_refs(spark, sf):
    return _inlined(spark, sf).select("workbook_id", "calc_id", "formula_inlined")


# The same calculation under one name in two sources, so that there is something to merge.
REPEATED = """SELECT workbook_id, 'ds' || CAST(calc_ord % 2 AS VARCHAR(20)) AS datasource, 11 AS source_ord,
    calc_ord, calc_id, 'Calc' AS name, formula, formula AS formula_inlined,
    CASE WHEN calc_ord > 1 THEN 'real' END AS datatype, 'measure' AS tableau_role FROM wb_calcs"""


def dedupe_calcs(spark, sf):
    return inline.dedupe_calcs(fx.query(spark, sf, REPEATED)).select(
        "workbook_id", "name", "calc_id", "formula", "formula_inlined",
        F.coalesce("datatype", F.lit("")).alias("datatype"), "tableau_role",
        F.array_join("datasources", ",").alias("datasources"), F.col("ord.calc_ord").cast("bigint").alias("ord"),
    )


def ordered_distinct(spark, sf):
    kinds = _calcs(spark, sf).select("workbook_id", "template", F.col("calc_ord").cast("bigint").alias("ord"))
    return inline.ordered_distinct(kinds, ["workbook_id", "template"], "ord")


def _metrics(spark, sf, variant="strict"):
    return fx.stored(
        spark, sf, f"metrics-{variant}",
        lambda: metrics.estate_facts(fx.workbook_elements(spark, sf), variant),
    )


CATEGORY_COLUMNS = [f"score_{c}" for c in fixed.CATEGORIES]


def score_linear(spark, sf):
    scored = score.category_scores(_metrics(spark, sf), "linear")
    return scored.select("workbook_id", *[F.round(c, 6).alias(c) for c in CATEGORY_COLUMNS])


def score_log(spark, sf):
    scored = score.category_scores(_metrics(spark, sf, "broad"), "log")
    return scored.select("workbook_id", *[F.round(c, 6).alias(c) for c in CATEGORY_COLUMNS])


def _tiered(spark, sf):
    return score.with_tiers(score.category_scores(_metrics(spark, sf), "linear"))


def composite_score(spark, sf):
    return _tiered(spark, sf).select("workbook_id", round1(F.col("composite")).alias("composite_score"))


def complexity_tier(spark, sf):
    return _tiered(spark, sf).select("workbook_id", "base_tier")


def tier_overrides(spark, sf):
    return _tiered(spark, sf).select("workbook_id", "complexity_tier", "override_flags")


def proceed_decision(spark, sf):
    return score.with_decision(_tiered(spark, sf)).select("workbook_id", "proceed", "proceed_reason")


QUERIES = {
    f.__name__: f
    for f in (
        calc_fields, calc_records, workbook_parameters, strip_comments, formula_key, field_refs, detect_lod,
        detect_table_calc, classify_unsupported, no_equivalent_features, no_equivalent_legacy, authoring_line,
        agg_data_model, agg_data_model_broad, agg_calculations, agg_structure, agg_interactivity,
        param_actions_feeding_calc, calc_nesting_depth, inline_refs, dedupe_calcs, ordered_distinct,
        score_linear, score_log, composite_score, complexity_tier, tier_overrides, proceed_decision,
        workbook_scorecard, workbook_scorecard_legacy,
    )
}

_ID = "workbook_id, CAST(calc_ord AS BIGINT) AS calc_ord"
_DATA_MODEL = "workbook_id, num_datasources, num_joins, num_custom_sql"
_REASONS = """CASE template WHEN 2 THEN 'LOD expression (FIXED/INCLUDE/EXCLUDE)' WHEN 3 THEN 'table calculation'
    WHEN 4 THEN 'table calculation' WHEN 10 THEN 'table calculation' WHEN 8 THEN 'Tableau parameter reference'
    WHEN 11 THEN 'DATEPARSE (format strings differ)' ELSE '' END"""


def _card(source: str, decision: str) -> str:
    scores = ", ".join(f"{r1(f'score_{c}')} AS score_{c}" for c in fixed.CATEGORIES)
    return f"""SELECT workbook_id, workbook_name || '.twb' AS twb_file, workbook_name,
        {r1('composite')} AS composite_score, complexity_tier, override_flags, no_equivalent_features, {decision}
        table_paths, authoring_line, {scores}, {', '.join(METRIC_COLUMNS)} FROM {source}"""


CHECKS = {
    "calc_fields": "SELECT workbook_id, calc_id AS calc_name, formula FROM wb_calcs",
    "calc_records": """SELECT workbook_id, datasource, calc_id, caption AS name, formula, 'real' AS datatype,
        'measure' AS tableau_role FROM wb_calcs""",
    "workbook_parameters": "SELECT workbook_id, param_name AS parameter_name FROM wb_params",
    "strip_comments": f"""SELECT {_ID}, replace(formula, '/* c */', '') || ' ' || chr(10) || '+ "http://x"'
        AS stripped FROM wb_calcs""",
    "formula_key": f"SELECT {_ID}, trim(formula) AS formula_key FROM wb_calcs",
    "field_refs": """SELECT workbook_id, CAST(calc_ord AS BIGINT) AS calc_ord, CAST(row_number() OVER
        (PARTITION BY workbook_id, calc_ord ORDER BY pos) - 1 AS BIGINT) AS ref_ord, ref
        FROM (SELECT workbook_id, calc_ord, ref, min(pos) AS pos FROM (SELECT workbook_id, calc_ord,
          unnest(refs) AS ref, generate_subscripts(refs, 1) AS pos FROM (SELECT workbook_id, calc_ord,
            regexp_extract_all(regexp_replace(formula, '"[^"]*"', '', 'g'), '\\[([^\\]]+)\\]', 1) AS refs
            FROM wb_calcs)) GROUP BY workbook_id, calc_ord, ref)""",
    "detect_lod": f"""SELECT {_ID}, regexp_matches(formula, '\\{{\\s*(FIXED|INCLUDE|EXCLUDE)\\b', 'i') AS is_lod
        FROM wb_calcs""",
    "detect_table_calc": f"SELECT {_ID}, template IN (3, 4) AS is_table_calc FROM wb_calcs",
    "classify_unsupported": f"SELECT {_ID}, {_REASONS} AS reason FROM wb_calcs",
    "no_equivalent_features": "SELECT * FROM features",
    "no_equivalent_legacy": "SELECT * FROM broad_features",
    "authoring_line": "SELECT workbook_id, authoring_line FROM carded",
    "agg_data_model": f"SELECT {_DATA_MODEL} FROM m_data_model",
    "agg_data_model_broad": f"SELECT {_DATA_MODEL} FROM m_data_model_broad",
    "agg_calculations": "SELECT * FROM m_calculations",
    "agg_structure": "SELECT * FROM m_structure",
    "agg_interactivity": "SELECT * FROM m_interactivity",
    "param_actions_feeding_calc": "SELECT * FROM fed_actions",
    "calc_nesting_depth": "SELECT * FROM m_depth WHERE max_calc_nesting_depth > 0",
    "inline_refs": """SELECT workbook_id, 'Calculation_' || calc_ord AS calc_id, formula_inlined FROM inlined""",
    "dedupe_calcs": f"""SELECT workbook_id, name, arg_min(calc_id, calc_ord) AS calc_id,
        arg_min(formula, calc_ord) AS formula, arg_min(formula, calc_ord) AS formula_inlined,
        coalesce(arg_min(datatype, calc_ord) FILTER (WHERE datatype IS NOT NULL), '') AS datatype,
        min(tableau_role) AS tableau_role, array_to_string(list_sort(list_distinct(list(datasource))), ',')
        AS datasources, CAST(min(calc_ord) AS BIGINT) AS ord FROM ({REPEATED})
        GROUP BY workbook_id, name, trim(regexp_replace(formula, '\\s+', ' ', 'g'))""",
    "ordered_distinct": """SELECT workbook_id, template, CAST(min(calc_ord) AS BIGINT) AS ord FROM wb_calcs
        GROUP BY workbook_id, template""",
    "score_linear": "SELECT workbook_id, "
    + ", ".join(f"round({c}, 6) AS {c}" for c in CATEGORY_COLUMNS) + " FROM scored",
    "score_log": "SELECT workbook_id, "
    + ", ".join(f"round({c}, 6) AS {c}" for c in CATEGORY_COLUMNS) + " FROM log_scored",
    "composite_score": f"SELECT workbook_id, {r1('composite')} AS composite_score FROM scored",
    "complexity_tier": "SELECT workbook_id, base_tier FROM scored",
    "tier_overrides": "SELECT workbook_id, complexity_tier, override_flags FROM scored",
    "proceed_decision": "SELECT workbook_id, proceed, proceed_reason FROM decided",
    "workbook_scorecard": _card("carded", "proceed, proceed_reason,"),
    "workbook_scorecard_legacy": _card("broad_carded", ""),
}
CHECKS = {k: check(v) for k, v in CHECKS.items()}
