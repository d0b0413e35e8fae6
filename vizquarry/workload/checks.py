"""Facts about the derived estate, stated in SQL from the tables alone; the checks select from them."""

from __future__ import annotations

from vizquarry import fixed
from vizquarry.workload.fixtures import with_views

_TWO56 = "72057594037927936"


def r1(x: str) -> str:
    """One decimal, half to even on the exact double."""
    m = f"(CAST(trunc(({x}) * {_TWO56}.0::DOUBLE) AS HUGEINT) * 10)"
    f, rest = f"({m} // {_TWO56}::HUGEINT)", f"(({m} % {_TWO56}::HUGEINT) * 2)"
    up = f"(CASE WHEN {rest} > {_TWO56}::HUGEINT THEN 1 WHEN {rest} < {_TWO56}::HUGEINT THEN 0 ELSE {f} % 2 END)"
    return f"(CAST({f} + {up} AS DOUBLE) / 10.0::DOUBLE)"


def _per_book(view: str, columns: dict[str, str]) -> str:
    listed = ", ".join(f"coalesce(x.{n}, 0) AS {n}" for n in columns)
    inner = ", ".join(f"{e} AS {n}" for n, e in columns.items())
    return (
        f"SELECT w.workbook_id, {listed} FROM wb_workbooks w LEFT JOIN"
        f" (SELECT workbook_id, {inner} FROM {view} GROUP BY workbook_id) x ON x.workbook_id = w.workbook_id"
    )


def _count(condition: str) -> str:
    return f"CAST(count(*) FILTER (WHERE {condition}) AS BIGINT)"


def _scores(curve: str, prefix: str) -> str:
    parts = []
    for category, inputs in fixed.CATEGORY_INPUTS.items():
        v = "CAST(" + " + ".join(f"{w} * {m}" for m, w in inputs.items()) + " AS DOUBLE)"
        if curve == "linear":
            score = f"100.0::DOUBLE * {v} / {float(fixed.CATEGORY_CEILINGS[category])}::DOUBLE"
        else:
            score = f"100.0::DOUBLE * ln(1.0::DOUBLE + {v}) / ln(11.0::DOUBLE)"
        parts.append(f"least(100.0::DOUBLE, {score}) AS score_{category}")
    composite = " + ".join(f"score_{c} * {w}::DOUBLE" for c, w in fixed.CATEGORY_WEIGHTS.items())
    tier = "CASE WHEN composite < 25 THEN 0 WHEN composite < 50 THEN 1 WHEN composite < 75 THEN 2 ELSE 3 END"
    names = " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(fixed.TIERS))
    forced = "greatest({t}, CASE WHEN max_calc_nesting_depth > 5 THEN 3 ELSE 0 END, CASE WHEN num_param_actions_feeding_calc > 0 THEN 2 ELSE 0 END)"
    return f"""SELECT *, CASE rank0 {names} END AS base_tier, CASE rank1 {names} END AS complexity_tier,
        concat_ws(', ', CASE WHEN max_calc_nesting_depth > 5 THEN 'calc nesting depth > 5' END,
          CASE WHEN num_param_actions_feeding_calc > 0 THEN 'parameter action feeds a calculated field' END)
          AS override_flags
      FROM (SELECT *, {tier} AS rank0, {forced.format(t=tier)} AS rank1 FROM
        (SELECT *, {composite} AS composite FROM (SELECT *, {", ".join(parts)} FROM {prefix}metrics)))"""


def _features(broad: bool) -> str:
    dynamic = (
        f"CASE WHEN z.dyn THEN '{fixed.FEATURE_DYNAMIC_ZONE}' END, " if broad else ""
    )
    return f"""SELECT w.workbook_id, concat_ws(', ', CASE WHEN has_story = 1 THEN '{fixed.FEATURE_STORY}' END,
        CASE WHEN z.ext THEN '{fixed.FEATURE_EXTENSION}' END, {dynamic}
        CASE WHEN a.sets THEN '{fixed.FEATURE_SET_ACTION}' END) AS no_equivalent_features
      FROM wb_workbooks w
      LEFT JOIN (SELECT workbook_id, bool_or(zone_type = 'extension') AS ext, bool_or(param <> '') AS dyn
                 FROM wb_zones GROUP BY workbook_id) z ON z.workbook_id = w.workbook_id
      LEFT JOIN (SELECT workbook_id, bool_or(tag = 'set') AS sets FROM wb_actions GROUP BY workbook_id) a
        ON a.workbook_id = w.workbook_id"""


def _metrics(data_model: str) -> str:
    return (
        f"SELECT * FROM {data_model} JOIN m_calculations USING (workbook_id)"
        " JOIN m_structure USING (workbook_id) JOIN m_interactivity USING (workbook_id)"
    )


METRIC_COLUMNS = [
    "num_datasources", "num_joins", "num_custom_sql", "num_calc_fields", "num_lod_expressions",
    "num_table_calcs", "max_calc_nesting_depth", "num_sheets", "num_dashboards",
    "max_container_nesting_depth", "avg_objects_per_dashboard", "num_filters", "num_sets",
    "num_actions_filter", "num_actions_highlight", "num_actions_url", "num_actions_parameter",
    "num_parameters", "num_param_actions_feeding_calc",
]

PRODUCT, VENDOR = "Spark BI", "Spark"
NO_PATHS = fixed.NO_TABLE_PATHS % ("main", "sales")


def _line() -> str:
    text = fixed.AUTHORING_LINE.format(product=PRODUCT, vendor=VENDOR).replace("'", "''")
    slots = iter(
        ["workbook_name", "complexity_tier", "table_paths", "num_sheets", "num_dashboards", "num_filters",
         "num_parameters", "coalesce(calc_names, 'none')",
         "CASE WHEN no_equivalent_features = '' THEN 'none' ELSE no_equivalent_features END"]
    )
    parts = text.replace("%d", "%s").split("%s")
    out = f"'{parts[0]}'"
    for p in parts[1:]:
        out += f" || {next(slots)} || '{p}'"
    return out


FACTS = {
    # One row per step of a reference chain; a calculation refers to one other at most.
    "calc_chain": """SELECT workbook_id, calc_ord AS start_ord, calc_ord AS at_ord, ref_ord, template,
        [calc_ord] AS path, 1 AS len FROM wb_calcs
        UNION ALL /* recursive */
        SELECT c.workbook_id, c.start_ord, n.calc_ord, n.ref_ord, n.template, list_append(c.path, n.calc_ord),
        c.len + 1 FROM calc_chain c JOIN wb_calcs n ON n.workbook_id = c.workbook_id
        AND n.calc_ord = c.ref_ord WHERE NOT list_contains(c.path, n.calc_ord)""",
    "chain_facts": """SELECT workbook_id, start_ord AS calc_ord, max(len) AS len,
        min(CASE template WHEN 2 THEN 1 WHEN 3 THEN 2 WHEN 4 THEN 2 WHEN 10 THEN 2 WHEN 8 THEN 4
            WHEN 11 THEN 5 END) AS refused,
        max(CASE WHEN template IN (0, 6, 9) THEN 1 ELSE 0 END) AS aggregates
        FROM calc_chain GROUP BY workbook_id, start_ord""",
    "chain_end": """SELECT workbook_id, start_ord AS calc_ord, ref_ord AS open_ref FROM calc_chain
        QUALIFY row_number() OVER (PARTITION BY workbook_id, start_ord ORDER BY len DESC) = 1""",
    "m_data_model": "SELECT x.*, 1 + workbook_id % 3 AS num_datasources FROM ("
    + _per_book("wb_relations", {"num_joins": _count("relation_type = 'join'"),
                                 "num_custom_sql": _count("relation_type = 'text'")}) + ") x",
    "m_data_model_broad": "SELECT m.workbook_id, m.num_joins, m.num_custom_sql,"
    " m.num_datasources * (1 + n_sheets) AS num_datasources FROM m_data_model m"
    " JOIN wb_workbooks w ON w.workbook_id = m.workbook_id",
    "m_depth": _per_book("calc_chain", {"max_calc_nesting_depth": "CAST(max(len) AS BIGINT)"}),
    "m_calculations": "SELECT c.*, max_calc_nesting_depth FROM ("
    + _per_book("wb_calcs", {"num_calc_fields": "count(*)", "num_lod_expressions": _count("template = 2"),
                             "num_table_calcs": _count("template IN (3, 4)")})
    + ") c JOIN m_depth d ON d.workbook_id = c.workbook_id",
    "m_structure": """SELECT w.workbook_id, n_sheets AS num_sheets, n_dashboards AS num_dashboards,
        coalesce(z.deepest, 0) AS max_container_nesting_depth,
        CASE WHEN n_dashboards > 0 THEN """ + r1("coalesce(z.leaves, 0)::DOUBLE / n_dashboards") + """
        ELSE 0.0::DOUBLE END AS avg_objects_per_dashboard
        FROM wb_workbooks w LEFT JOIN (SELECT workbook_id, CAST(max(zone_depth) AS BIGINT) AS deepest,
          CAST(sum(is_leaf) AS BIGINT) AS leaves FROM wb_zones GROUP BY workbook_id) z
        ON z.workbook_id = w.workbook_id""",
    "fed_actions": """SELECT a.workbook_id, count(*) AS num_param_actions_feeding_calc FROM wb_actions a
        WHERE tag = 'parameter' AND EXISTS (SELECT 1 FROM wb_calcs c WHERE c.workbook_id = a.workbook_id
        AND contains(c.formula, a.target_parameter)) GROUP BY a.workbook_id""",
    "m_interactivity": """SELECT a.*, coalesce(f.n, 0) AS num_filters, coalesce(p.n, 0) AS num_parameters,
        coalesce(s.n, 0) AS num_sets,
        coalesce(t.num_param_actions_feeding_calc, 0) AS num_param_actions_feeding_calc FROM ("""
    + _per_book("wb_actions", {f"num_actions_{t}": _count(f"tag = '{t}'")
                               for t in ("filter", "highlight", "url", "parameter")}) + """) a
        LEFT JOIN (SELECT workbook_id, count(*) AS n FROM wb_filters GROUP BY workbook_id) f
          ON f.workbook_id = a.workbook_id
        LEFT JOIN (SELECT workbook_id, count(*) AS n FROM wb_params GROUP BY workbook_id) p
          ON p.workbook_id = a.workbook_id
        LEFT JOIN (SELECT workbook_id, count(*) AS n FROM wb_sets GROUP BY workbook_id) s
          ON s.workbook_id = a.workbook_id
        LEFT JOIN fed_actions t ON t.workbook_id = a.workbook_id""",
    "metrics": _metrics("m_data_model"),
    "broad_metrics": _metrics("m_data_model_broad"),
    "scored": _scores("linear", ""),
    "log_scored": _scores("log", "broad_"),
    "features": _features(False),
    "broad_features": _features(True),
    "book_paths": f"""SELECT w.workbook_id, coalesce(p.table_paths, '{NO_PATHS}') AS table_paths
        FROM wb_workbooks w LEFT JOIN (SELECT workbook_id,
          array_to_string(list_sort(list_distinct(list('`main`.`sales`.`' || clean || '`'))), ', ')
          AS table_paths FROM (SELECT workbook_id,
            lower(trim(regexp_replace(table_name, '[^\\p{{L}}\\p{{N}}_]', '_', 'g'), '_')) AS clean
            FROM wb_extract_tables) GROUP BY workbook_id) p ON p.workbook_id = w.workbook_id""",
    "book_calcs": """SELECT workbook_id, string_agg(calc_id, '; ' ORDER BY calc_ord) AS calc_names
        FROM wb_calcs GROUP BY workbook_id""",
    "decided": """SELECT *, reasons = '' AS proceed,
        CASE WHEN reasons = '' THEN 'no overrides, no no-equivalent features, tier <= Complex' ELSE reasons END
        AS proceed_reason FROM (SELECT s.*, no_equivalent_features, concat_ws('; ',
          CASE WHEN no_equivalent_features <> ''
               THEN 'no-equivalent feature(s) detected: ' || no_equivalent_features END,
          CASE WHEN override_flags <> '' THEN 'override flag(s) triggered: ' || override_flags END,
          CASE WHEN complexity_tier = 'Very Complex' THEN 'complexity tier is Very Complex' END) AS reasons
        FROM scored s JOIN features f ON f.workbook_id = s.workbook_id)""",
    "carded": "SELECT d.*, workbook_name, table_paths, " + _line() + """ AS authoring_line FROM decided d
        JOIN wb_workbooks w ON w.workbook_id = d.workbook_id
        JOIN book_paths p ON p.workbook_id = d.workbook_id
        LEFT JOIN book_calcs c ON c.workbook_id = d.workbook_id""",
    "broad_carded": "SELECT d.*, workbook_name, table_paths, no_equivalent_features, " + _line()
    + """ AS authoring_line FROM log_scored d
        JOIN broad_features f ON f.workbook_id = d.workbook_id
        JOIN wb_workbooks w ON w.workbook_id = d.workbook_id
        JOIN book_paths p ON p.workbook_id = d.workbook_id
        LEFT JOIN book_calcs c ON c.workbook_id = d.workbook_id""",
    # Formula without the reference at its end, comments gone.
    "calc_bodies": """SELECT *, CASE WHEN ref_ord IS NULL THEN clean
        ELSE left(clean, length(clean) - length(' + [Calculation_' || ref_ord || ']')) END AS body
        FROM (SELECT *, replace(formula, '/* c */', '') AS clean FROM wb_calcs)""",
    "inlined": """SELECT b.workbook_id, b.calc_ord, b.template, t.txt
        || CASE WHEN e.open_ref IS NULL THEN '' ELSE ' + [Calculation_' || e.open_ref || ']' END
        || repeat(')', CAST(t.len - 1 AS BIGINT)) AS formula_inlined
        FROM calc_bodies b JOIN (SELECT c.workbook_id, c.start_ord, max(c.len) AS len,
            string_agg(n.body, ' + (' ORDER BY c.len) AS txt FROM calc_chain c
            JOIN calc_bodies n ON n.workbook_id = c.workbook_id AND n.calc_ord = c.at_ord
            GROUP BY c.workbook_id, c.start_ord) t
          ON t.workbook_id = b.workbook_id AND t.start_ord = b.calc_ord
        JOIN chain_end e ON e.workbook_id = b.workbook_id AND e.calc_ord = b.calc_ord""",
    # Status, kind and refusal of each calculation after inlining.
    "calc_states": """SELECT b.workbook_id, b.calc_ord, b.caption, b.calc_id,
        CASE f.refused WHEN 1 THEN 'LOD expression (FIXED/INCLUDE/EXCLUDE)' WHEN 2 THEN 'table calculation'
          WHEN 4 THEN 'Tableau parameter reference' WHEN 5 THEN 'DATEPARSE (format strings differ)' END AS label,
        CASE WHEN f.refused IS NOT NULL THEN 'unsupported' WHEN e.open_ref IS NOT NULL THEN 'needs_review'
          ELSE 'ok' END AS status,
        CASE WHEN f.refused IS NULL THEN CASE f.aggregates WHEN 1 THEN 'measure' ELSE 'dimension' END END AS kind,
        replace(replace(lower(b.caption), ' ', '_'), '-', '_') AS slug
        FROM wb_calcs b JOIN chain_facts f ON f.workbook_id = b.workbook_id AND f.calc_ord = b.calc_ord
        JOIN chain_end e ON e.workbook_id = b.workbook_id AND e.calc_ord = b.calc_ord""",
    "table_columns": "SELECT table_ord, table_name, column_ord, column_name, column_type FROM (VALUES "
    + ", ".join(
        f"({t}, '{name}', {c}, '{col}', '{kind}')"
        for t, (name, cols) in enumerate(
            {
                "sales_lines": "order_id:bigint part_id:bigint supplier_id:bigint line_number:int"
                " quantity:double extended_price:double discount:double tax:double return_flag:string"
                " line_status:string ship_date:timestamp_ntz",
                "sales_orders": "order_id:bigint customer_id:bigint order_status:string total_price:double"
                " order_date:timestamp_ntz order_priority:string",
                "sales_customers": "customer_id:bigint customer_name:string nation_id:int"
                " account_balance:double segment:string",
                "sales_parts": "part_id:bigint part_name:string brand:string part_type:string size:int"
                " retail_price:double",
                "sales_suppliers": "supplier_id:bigint supplier_name:string nation_id:int"
                " account_balance:double",
                "sales_nations": "nation_id:int nation_name:string region_id:int",
            }.items(),
            1,
        )
        for c, (col, kind) in enumerate((x.split(":") for x in cols.split()), 1)
    )
    + ") AS t(table_ord, table_name, column_ord, column_name, column_type)",
}


def check(sql: str) -> str:
    return with_views(sql, FACTS)
