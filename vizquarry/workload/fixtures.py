"""A workbook estate derived from the star-schema tables.

Orders stand for workbooks and their lines for calculated fields. Every view is SQL in the overlap of Spark
and DuckDB, so that a query and its check start from identical rows.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from vizquarry.session import cut_lineage, ship_package

BASE_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]

# What a line stands for: a calculated field, a relation and, some of them, an action.
_CALC = """l_orderkey AS workbook_id,
        'ds' || CAST(l_orderkey % 3 AS VARCHAR(20)) AS datasource, ord AS calc_ord,
        'Calculation_' || CAST(ord AS VARCHAR(20)) AS calc_id,
        'Calc ' || CAST(ord AS VARCHAR(20)) || ' ' || l_returnflag AS caption,
        CAST(l_partkey % 12 AS INT) AS template,
        CASE WHEN ord > 1 AND l_suppkey % 3 <> 0 THEN ord - 1
             WHEN ord = 1 AND l_suppkey % 7 = 0 THEN 2 END AS ref_ord,
        CASE CAST(l_partkey % 12 AS INT)
          WHEN 0 THEN 'SUM([Extended Price])'
          WHEN 1 THEN 'ZN([Discount]) * [Extended Price]'
          WHEN 2 THEN '{FIXED [Order Id] : SUM([Quantity])}'
          WHEN 3 THEN 'WINDOW_SUM(SUM([Quantity]))'
          WHEN 4 THEN 'RUNNING_SUM(SUM([Tax]))'
          WHEN 5 THEN 'IF [Quantity] > 10 THEN "big" ELSEIF [Quantity] > 5 THEN "mid" ELSE "small" END'
          WHEN 6 THEN 'COUNTD([Order Id])'
          WHEN 7 THEN 'DATETRUNC("month", [Ship Date])'
          WHEN 8 THEN '[Parameters].[P1] + [Tax]'
          WHEN 9 THEN 'SUM([Extended Price]) / /* c */ SUM([Quantity])'
          WHEN 10 THEN 'RANK_PERCENTILE(SUM([Tax]))'
          ELSE 'DATEPARSE("yyyy", [Return Flag])' END
        || CASE WHEN ord > 1 AND l_suppkey % 3 <> 0
                THEN ' + [Calculation_' || CAST(ord - 1 AS VARCHAR(20)) || ']'
                WHEN ord = 1 AND l_suppkey % 7 = 0 THEN ' + [Calculation_2]' ELSE '' END AS formula"""
_NUMBERED_LINES = """(SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey,
              l_suppkey, l_extendedprice, l_shipdate, l_quantity) AS ord FROM lineitem) AS n"""
_RELATION = """CASE l_linenumber % 4 WHEN 0 THEN 'join'
        WHEN 1 THEN 'text' WHEN 2 THEN 'table' ELSE 'collection' END"""
_ACTION = """CASE CAST(l_suppkey % 10 AS INT)
        WHEN 0 THEN 'filter' WHEN 1 THEN 'highlight' WHEN 2 THEN 'url' WHEN 3 THEN 'parameter'
        WHEN 4 THEN 'set' ELSE 'other' END"""
_TARGET = """CASE WHEN l_suppkey % 10 = 3
             THEN '[P' || CAST(1 + l_partkey % 3 AS VARCHAR(20)) || ']' END"""

VIEWS = {
    # ---- tables an ingest would have written --------------------------------------------------------
    "sales_lines": """SELECT l_orderkey AS order_id, l_partkey AS part_id, l_suppkey AS supplier_id,
        l_linenumber AS line_number, l_quantity AS quantity, l_extendedprice AS extended_price,
        l_discount AS discount, l_tax AS tax, l_returnflag AS return_flag, l_linestatus AS line_status,
        l_shipdate AS ship_date FROM lineitem""",
    "sales_orders": """SELECT o_orderkey AS order_id, o_custkey AS customer_id,
        o_orderstatus AS order_status, o_totalprice AS total_price, o_orderdate AS order_date,
        o_orderpriority AS order_priority FROM orders""",
    "sales_customers": """SELECT c_custkey AS customer_id, c_name AS customer_name,
        c_nationkey AS nation_id, c_acctbal AS account_balance, c_mktsegment AS segment FROM customer""",
    "sales_parts": """SELECT p_partkey AS part_id, p_name AS part_name, p_brand AS brand,
        p_type AS part_type, p_size AS size, p_retailprice AS retail_price FROM part""",
    "sales_suppliers": """SELECT s_suppkey AS supplier_id, s_name AS supplier_name,
        s_nationkey AS nation_id, s_acctbal AS account_balance FROM supplier""",
    "sales_nations": """SELECT n_nationkey AS nation_id, n_name AS nation_name,
        n_regionkey AS region_id FROM nation""",
    # ---- the estate ------------------------------------------------------------------------------------
    "numbers": "SELECT k FROM (VALUES (1),(2),(3),(4),(5),(6),(7),(8)) AS t(k)",
    "wb_workbooks": """SELECT o_orderkey AS workbook_id,
        'Workbook ' || CAST(o_orderkey AS VARCHAR(20)) AS workbook_name,
        CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 1 END AS has_extract,
        1 + o_custkey % 8 AS n_sheets, o_custkey % 4 AS n_dashboards,
        CASE WHEN o_custkey % 11 = 0 THEN 1 ELSE 0 END AS has_story FROM orders""",
    "wb_datasources": """SELECT w.workbook_id, k AS source_ord,
        'ds' || CAST(k - 1 AS VARCHAR(20)) AS datasource
        FROM wb_workbooks w JOIN numbers ON k <= 1 + w.workbook_id % 3""",
    "wb_calcs": f"""SELECT {_CALC}
        FROM {_NUMBERED_LINES}""",
    "wb_relations": f"""SELECT l_orderkey AS workbook_id, {_RELATION} AS relation_type FROM lineitem""",
    "wb_filters": """SELECT w.workbook_id, s.k AS sheet_ord, f.k AS filter_ord FROM wb_workbooks w
        JOIN numbers s ON s.k <= w.n_sheets JOIN numbers f ON f.k <= (w.workbook_id + s.k) % 3""",
    "wb_zones": """SELECT w.workbook_id, d.k AS dashboard_ord, z.k AS zone_depth,
        CASE WHEN z.k = 1 + (w.workbook_id + d.k) % 6 THEN 1 ELSE 0 END AS is_leaf,
        CASE WHEN z.k = 3 AND w.workbook_id % 17 = 0 THEN 'extension' ELSE 'layout' END AS zone_type,
        CASE WHEN z.k = 2 AND w.workbook_id % 5 = 0 THEN 'vert' ELSE '' END AS param
        FROM wb_workbooks w JOIN numbers d ON d.k <= w.n_dashboards
        JOIN numbers z ON z.k <= 1 + (w.workbook_id + d.k) % 6""",
    "wb_params": """SELECT w.workbook_id, p.k AS param_ord, 'P' || CAST(p.k AS VARCHAR(20)) AS param_name
        FROM wb_workbooks w JOIN numbers p ON p.k <= w.workbook_id % 4""",
    "wb_sets": """SELECT w.workbook_id, s.k AS set_ord FROM wb_workbooks w
        JOIN numbers s ON s.k <= w.workbook_id % 3""",
    "wb_actions": f"""SELECT l_orderkey AS workbook_id, {_ACTION} AS tag,
        {_TARGET} AS target_parameter
        FROM lineitem WHERE l_suppkey % 10 < 6""",
    "wb_extract_tables": """SELECT l_orderkey AS workbook_id,
        CASE CAST(l_linenumber % 4 AS INT) WHEN 0 THEN 'Sales Lines' WHEN 1 THEN 'Sales-Orders'
        WHEN 2 THEN '_Sales Lines_' ELSE 'Größe ' || l_returnflag END AS table_name
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus <> 'P'""",
}

TABLE_NAMES = ["sales_lines", "sales_orders", "sales_customers", "sales_parts", "sales_suppliers", "sales_nations"]


def with_views(sql: str, extra: dict[str, str] | None = None) -> str:
    """``sql`` preceded by the views it needs, dependencies first, as one statement."""
    known = {**VIEWS, **(extra or {})}
    order: list[str] = []

    def visit(text: str):
        for name in dict.fromkeys(re.findall(r"\b\w+\b", text)):
            if name in known and name not in order and known[name] is not text:
                visit(known[name])
                if name not in order:
                    order.append(name)

    visit(sql)
    if not order:
        return sql
    recursive = "RECURSIVE " if any("UNION ALL /* recursive */" in known[n] for n in order) else ""
    return "WITH " + recursive + ",\n".join(f"{n} AS ({known[n]})" for n in order) + "\n" + sql


def load(spark: SparkSession, sf_dir: str) -> None:
    """Register the given tables as temporary views."""
    ship_package(spark)
    for name in BASE_TABLES:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(name)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return query(spark, sf_dir, f"SELECT * FROM {name}")


def query(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    load(spark, sf_dir)
    return spark.sql(with_views(sql))


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    load(spark, sf_dir)
    return {name: spark.sql(with_views(f"SELECT * FROM {name}")) for name in TABLE_NAMES}


# ---- element rows -----------------------------------------------------------------------------------------

_NO_MAP = "CAST(map() AS map<string,string>)"
_NO_TAGS = "CAST(array() AS array<string>)"
_NO_SCOPE = "CAST(array() AS array<struct<elem_id:bigint,tag:string,path:string,name:string,caption:string>>)"


def _scope(*levels: tuple[str, str, str, str]) -> str:
    """(id, tag, path, name) per enclosing level."""
    return "array(" + ", ".join(
        f"named_struct('elem_id', CAST({i} AS BIGINT), 'tag', '{tag}', 'path', '{path}', 'name', {name},"
        " 'caption', CAST(NULL AS STRING))"
        for i, tag, path, name in levels
    ) + ")"


def _rows(source: str, elem_id, parent_id, path: str, tag=None, sib="1", tag_ord="1", attrs=_NO_MAP,
          parent_attrs=_NO_MAP, children=_NO_TAGS, scopes=_NO_SCOPE, path_sql=None) -> str:
    depth = path.count("/") + 1 if path else 0
    path_sql = path_sql or f"'{path}'"
    tag = tag or f"'{path.rsplit('/', 1)[-1]}'"
    return f"""SELECT workbook_id, CAST({elem_id} AS BIGINT) AS elem_id,
        CAST({parent_id} AS BIGINT) AS parent_id, {path_sql} AS path, {depth} AS depth, {tag} AS tag,
        CAST({sib} AS INT) AS sib_ord, CAST({tag_ord} AS INT) AS tag_ord, {attrs} AS attrs,
        {parent_attrs} AS parent_attrs, {children} AS child_tags, {scopes} AS scopes FROM {source}"""


def _element_branches() -> list[str]:
    """Document order: sources, sheets, dashboards, stories, actions."""
    own = _scope(("11 + pmod(workbook_id, 3)", "datasource", "datasources/datasource",
                  "concat('ds', pmod(workbook_id, 3))"))
    params = _scope(("10", "datasource", "datasources/datasource", "'Parameters'"))
    sheet = ("2000000 + sheet_ord * 1000", "worksheet", "worksheets/worksheet",
             "concat('Sheet ', sheet_ord)")
    board = ("3000000 + dashboard_ord * 1000", "dashboard", "dashboards/dashboard",
             "concat('Dashboard ', dashboard_ord)")
    calc_attrs = ("map('name', concat('[', calc_id, ']'), 'caption', caption, 'datatype', 'real',"
                  " 'role', 'measure')")
    set_attrs = ("CASE WHEN set_ord % 2 = 1 THEN map('name', concat('[Set ', set_ord, ']'), 'type', 'set')"
                 " ELSE map('name', concat('[Set ', set_ord, ']')) END")
    zone_attrs = ("CASE WHEN param = '' THEN map('type', zone_type)"
                  " ELSE map('type', zone_type, 'param', param) END")
    sheets = "(SELECT w.*, s.k AS sheet_ord FROM wb_workbooks w JOIN numbers s ON s.k <= w.n_sheets)"
    boards = "(SELECT w.*, d.k AS dashboard_ord FROM wb_workbooks w JOIN numbers d ON d.k <= w.n_dashboards)"
    stanzas = ("(SELECT w.workbook_id, s.k AS sheet_ord, d.source_ord, d.datasource FROM wb_workbooks w"
               " JOIN numbers s ON s.k <= w.n_sheets JOIN wb_datasources d ON d.workbook_id = w.workbook_id)")
    return [
        _rows("wb_workbooks", "0", "NULL", "", tag="'workbook'"),
        _rows("wb_datasources", "10 + source_ord", "1", "datasources/datasource",
              attrs="map('name', datasource)"),
        _rows("(SELECT DISTINCT workbook_id FROM wb_params)", "10", "1", "datasources/datasource",
              attrs="map('name', 'Parameters')"),
        _rows("wb_params", "100 + param_ord", "10", "datasources/datasource/column",
              attrs="map('name', concat('[Parameter ', param_ord, ']'), 'caption', param_name)",
              parent_attrs="map('name', 'Parameters')", scopes=params),
        _rows("wb_relations", "1000", "11", "datasources/datasource/connection/relation",
              attrs="map('type', relation_type)", scopes=own),
        _rows("wb_calcs", "1000000 + calc_ord * 10", "11", "datasources/datasource/column",
              attrs=calc_attrs, children="array('calculation')", scopes=own),
        _rows("wb_calcs", "1000001 + calc_ord * 10", "1000000 + calc_ord * 10",
              "datasources/datasource/column/calculation",
              attrs="map('class', 'tableau', 'formula', formula)", parent_attrs=calc_attrs, scopes=own),
        _rows("wb_sets", "1900000 + set_ord", "11", "datasources/datasource/column", attrs=set_attrs,
              children=f"CASE WHEN set_ord % 2 = 1 THEN {_NO_TAGS} ELSE array('groupfilter') END",
              scopes=own),
        _rows(sheets, "2000000 + sheet_ord * 1000", "2", "worksheets/worksheet",
              attrs="map('name', concat('Sheet ', sheet_ord))", children="array('table')"),
        _rows(stanzas, "2000010 + sheet_ord * 1000 + source_ord", "2000003 + sheet_ord * 1000",
              "worksheets/worksheet/table/view/datasources/datasource", attrs="map('name', datasource)",
              scopes=_scope(sheet)),
        _rows("wb_filters", "2000100 + sheet_ord * 1000 + filter_ord", "2000002 + sheet_ord * 1000",
              "worksheets/worksheet/table/view/filter", attrs="map('class', 'categorical')",
              scopes=_scope(sheet)),
        _rows(boards, "3000000 + dashboard_ord * 1000", "3", "dashboards/dashboard",
              attrs="map('name', concat('Dashboard ', dashboard_ord))", children="array('zones')"),
        _rows("wb_zones", "3000001 + dashboard_ord * 1000 + zone_depth",
              "3000000 + dashboard_ord * 1000 + zone_depth",
              "dashboards/dashboard/zones/zone",
              path_sql="concat('dashboards/dashboard/zones', repeat('/zone', CAST(zone_depth AS INT)))",
              attrs=zone_attrs,
              children=f"CASE WHEN is_leaf = 1 THEN {_NO_TAGS} ELSE array('zone') END",
              scopes=_scope(board)),
        _rows("wb_workbooks WHERE has_story = 1", "4000000", "4", "storyboards/storyboard"),
        _rows("wb_actions", "5000000", "5", "actions/action",
              children=f"CASE WHEN tag = 'other' THEN {_NO_TAGS} ELSE array(tag) END", tag="'action'"),
        _rows("wb_actions WHERE tag <> 'other'", "5000001", "5000000", "actions/action/tag",
              path_sql="concat('actions/action/', tag)", tag="tag", attrs="CASE WHEN target_parameter IS NULL THEN " + _NO_MAP
              + " ELSE map('parameter', target_parameter) END"),
    ]


_STORED: dict[tuple, DataFrame] = {}


def once(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """A frame of the estate, made once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STORED:
        _STORED[key] = build()
    return _STORED[key]


def stored(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """A table of the estate, derived and written once per application, as the shred step would leave it."""
    return once(spark, sf_dir, name, lambda: cut_lineage(build()))


def workbook_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Element rows of the whole estate, straight from the tables (no XML in between).

    Not stored: tag and depth are constants of a branch, so a metric's filter leaves the tables it is about, and a
    query costs what it looks at instead of a shuffle and a copy of every element.
    """
    return once(spark, sf_dir, "elements", lambda: query(spark, sf_dir, "\nUNION ALL\n".join(_element_branches())))


def _repeated(last: str, text: str, copies: str = "size(copies)") -> str:
    """The sorted texts of k = 1, 2 ... ``last``, each as often as there are ``copies``; null without any."""
    return (f"CASE WHEN {last} >= 1 THEN array_join(array_sort(flatten(transform(sequence(1, CAST(least(8, {last}) AS INT)),"
            f" k -> array_repeat({text}, {copies})))), '') END")


def workbook_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(workbook_id, has_extract, xml): the same estate as documents.

    The lines of a workbook are collected in one pass; what follows from its orders alone (parameters, sets, sheets, dashboards)
    is written out from them in place. An order that comes twice has all parts twice, in each of its documents.
    """
    esc = lambda c: f"replace(replace(replace({c}, '&', '&amp;'), '<', '&lt;'), '\"', '&quot;')"
    listed = lambda text: f"array_join(array_sort(collect_list({text})), '')"

    calc = ("concat('<column name=\"[', calc_id, ']\" caption=\"', caption, '\" datatype=\"real\""
            " role=\"measure\"><calculation class=\"tableau\" formula=\"', " + esc("formula")
            + ", '\"/></column>')")
    relation = "concat('<relation type=\"', relation_type, '\"/>')"
    action = """CASE WHEN tag = 'other' THEN '<action/>' ELSE concat('<action><', tag, CASE WHEN target_parameter IS NULL
        THEN '' ELSE concat(' parameter="', target_parameter, '"') END, '/></action>') END"""
    param = "concat('<column name=\"[Parameter ', k, ']\" caption=\"P', k, '\"/>')"
    a_set = "CASE WHEN k % 2 = 1 THEN '<column name=\"[Set]\" type=\"set\"/>' ELSE '<column name=\"[Set]\"><groupfilter/></column>' END"
    sheet = """concat('<worksheet name="', k, '"><table><view><datasources>',
        array_join(transform(sequence(1, 1 + pmod(workbook_id, 3)),
        s -> concat('<datasource name="ds', s - 1, '"/>')), ''), '</datasources>',
        repeat('<filter class="categorical"/>', pmod(workbook_id + k, 3)), '</view></table></worksheet>')"""
    # Zones of a dashboard nest in each other; its orders' zones of one depth follow each other.
    boards = "size(filter(copies, c -> c.n_dashboards >= k))"
    zone = """concat('<zone type="', CASE WHEN z = 3 AND workbook_id % 17 = 0 THEN 'extension' ELSE 'layout' END, '"',
        CASE WHEN z = 2 AND workbook_id % 5 = 0 THEN ' param="vert"' ELSE '' END, '>')"""
    depth = "(1 + (workbook_id + k) % 6)"
    board = f"""CASE WHEN {depth} >= 1 THEN concat('<dashboard name="', k, '"><zones>',
        array_join(transform(sequence(1, CAST({depth} AS INT)), z -> repeat({zone}, {boards})), ''),
        repeat('</zone>', CAST({depth} * {boards} AS INT)), '</zones></dashboard>') ELSE '' END"""
    books = """(SELECT workbook_id, collect_list(struct(has_extract, has_story, n_sheets, n_dashboards)) AS copies,
        max(n_sheets) AS most_sheets, max(n_dashboards) AS most_boards
        FROM wb_workbooks WHERE workbook_id IS NOT NULL GROUP BY workbook_id)"""
    lines = f"""(SELECT workbook_id, {listed(calc)} AS calcs, {listed(relation)} AS relations, {listed(action)} AS actions
        FROM (SELECT {_CALC}, {_RELATION} AS relation_type, CASE WHEN l_suppkey % 10 < 6 THEN {_ACTION} END AS tag,
          {_TARGET} AS target_parameter FROM {_NUMBERED_LINES}) GROUP BY workbook_id)"""
    parts = f"""SELECT workbook_id, copies, coalesce(calcs, '') AS calcs, coalesce(relations, '') AS relations,
        coalesce(actions, '') AS actions, {_repeated("workbook_id % 4", param)} AS params,
        coalesce({_repeated("workbook_id % 3", a_set)}, '') AS sets,
        {_repeated("most_sheets", sheet, "size(filter(copies, c -> c.n_sheets >= k))")} AS sheets,
        coalesce({_repeated("most_boards", board, "1")}, '') AS boards
        FROM {books} LEFT JOIN {lines} USING (workbook_id)"""
    sql = f"""SELECT workbook_id, copy.has_extract, concat('<?xml version="1.0"?><workbook><datasources>',
        coalesce(concat('<datasource name="Parameters">', params, '</datasource>'), ''),
        array_join(transform(sequence(0, pmod(workbook_id, 3)), k -> concat('<datasource name="ds', k, '">',
          CASE WHEN k = pmod(workbook_id, 3) THEN concat('<connection>', relations, '</connection>', calcs, sets) ELSE '' END,
          '</datasource>')), ''),
        '</datasources><worksheets>', sheets, '</worksheets><dashboards>', boards, '</dashboards>',
        CASE WHEN copy.has_story = 1 THEN '<storyboards><storyboard/></storyboards>' ELSE '' END,
        '<actions>', actions, '</actions></workbook>') AS xml
      FROM (SELECT * FROM ({parts}) LATERAL VIEW explode(copies) AS copy)
      UNION ALL SELECT workbook_id, has_extract, CAST(NULL AS STRING) FROM wb_workbooks WHERE workbook_id IS NULL"""
    return query(spark, sf_dir, sql)
