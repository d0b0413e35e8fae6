"""What a query costs and where it holds for odd rows: plans, batches, documents, tables left behind."""

from xml.etree import ElementTree

import pyarrow as pa
import pytest

from vizquarry.plans import publish as pub, views as vw
from vizquarry.plans.metric_view import plan_formulas
from vizquarry.session import cut_lineage
from vizquarry.sources import archives, shred
from vizquarry.workload import calc_functions, fixtures as fx, ingest, semantic

SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double,"
    " l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz",
}
# Orders that come twice, have no customer or no key, and keys below zero.
ORDERS = (
    "SELECT CASE WHEN id = 40 THEN NULL ELSE id - 5 END AS o_orderkey, CASE WHEN id % 13 = 5 THEN NULL ELSE id * 7 - 20 END AS o_custkey,"
    " CASE WHEN id % 3 = 0 THEN 'P' ELSE 'O' END AS o_orderstatus, id * 1.5D AS o_totalprice, TIMESTAMP_NTZ '2024-01-05' AS o_orderdate,"
    " '1-URGENT' AS o_orderpriority FROM range(42) UNION ALL SELECT id, id + 3, NULL, 1D, NULL, NULL FROM range(6)"
)
LINES = (
    "SELECT CASE WHEN id % 50 = 49 THEN NULL ELSE id % 37 - 5 END AS l_orderkey, CASE WHEN id % 31 = 7 THEN NULL ELSE id * 5 END AS l_partkey,"
    " CASE WHEN id % 29 = 3 THEN NULL ELSE id * 3 - 40 END AS l_suppkey, CAST(id / 37 AS INT) AS l_linenumber, id % 50 * 1D AS l_quantity,"
    " id * 10D AS l_extendedprice, id % 10 / 100D AS l_discount, 0.02D AS l_tax,"
    " CASE id % 4 WHEN 0 THEN NULL WHEN 1 THEN 'A&\"<' ELSE 'N' END AS l_returnflag, 'O' AS l_linestatus,"
    " CASE WHEN id % 11 > 0 THEN TIMESTAMP_NTZ '2024-02-01' END AS l_shipdate FROM range(150)"
)


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("odd"))
    rows = {"orders": spark.sql(ORDERS), "lineitem": spark.sql(LINES)}
    for name, schema in SCHEMAS.items():
        df = rows.get(name) or spark.createDataFrame([], schema)
        df.to(spark.createDataFrame([], schema).schema).write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_a_distinct_count_takes_no_other_aggregate_along(spark, odd):
    found = calc_functions.fn_approx(spark, odd)
    plan = found._jdf.queryExecution().executedPlan().toString()
    by_part = [line for line in plan.splitlines() if "Aggregate(keys=" in line and "part_id" in line.split("functions=")[0]]
    assert by_part and not any("percentile" in line or "approx" in line for line in by_part)
    rows = {r.return_flag: r.exact_parts for r in found.collect()}
    want = {r.f: r.n for r in spark.read.parquet(f"{odd}/lineitem.parquet").groupBy("l_returnflag").agg({"l_partkey": "count"}).toDF("f", "n").collect()}
    assert rows == want and None in rows


def view_by_view() -> str:
    """Documents as the views of the estate give them, each joined to the workbooks."""
    esc = lambda c: f"replace(replace(replace({c}, '&', '&amp;'), '<', '&lt;'), '\"', '&quot;')"

    def listed(view: str, text: str) -> str:
        return (f"(SELECT workbook_id, array_join(array_sort(collect_list({text})), '') AS t FROM {view}"
                " GROUP BY workbook_id)")

    calc = ("concat('<column name=\"[', calc_id, ']\" caption=\"', caption, '\" datatype=\"real\""
            " role=\"measure\"><calculation class=\"tableau\" formula=\"', " + esc("formula")
            + ", '\"/></column>')")
    zones = """concat('<dashboard name="', dashboard_ord, '"><zones>', array_join(transform(array_sort(
        collect_list(struct(zone_depth, zone_type, param))), z -> concat('<zone type="', z.zone_type, '"',
        CASE WHEN z.param = '' THEN '' ELSE concat(' param="', z.param, '"') END, '>')), ''),
        repeat('</zone>', count(*)), '</zones></dashboard>')"""
    filters = """concat('<worksheet name="', sheet_ord, '"><table><view><datasources>',
        array_join(transform(sequence(1, 1 + pmod(workbook_id, 3)),
        k -> concat('<datasource name="ds', k - 1, '"/>')), ''), '</datasources>',
        repeat('<filter class="categorical"/>', n), '</view></table></worksheet>')"""
    sql = f"""SELECT w.workbook_id, w.has_extract, concat('<?xml version="1.0"?><workbook><datasources>',
        coalesce(concat('<datasource name="Parameters">', p.t, '</datasource>'), ''),
        array_join(transform(sequence(0, pmod(w.workbook_id, 3)), k -> concat('<datasource name="ds', k, '">',
          CASE WHEN k = pmod(w.workbook_id, 3) THEN concat('<connection>', coalesce(r.t, ''), '</connection>',
            coalesce(c.t, ''), coalesce(s.t, '')) ELSE '' END, '</datasource>')), ''),
        '</datasources><worksheets>', f.t, '</worksheets><dashboards>', coalesce(z.t, ''), '</dashboards>',
        CASE WHEN w.has_story = 1 THEN '<storyboards><storyboard/></storyboards>' ELSE '' END,
        '<actions>', coalesce(a.t, ''), '</actions></workbook>') AS xml
      FROM wb_workbooks w
      LEFT JOIN {listed("wb_params", "concat('<column name=\"[Parameter ', param_ord, ']\" caption=\"', param_name, '\"/>')")} p ON p.workbook_id = w.workbook_id
      LEFT JOIN {listed("wb_relations", "concat('<relation type=\"', relation_type, '\"/>')")} r ON r.workbook_id = w.workbook_id
      LEFT JOIN {listed("wb_calcs", calc)} c ON c.workbook_id = w.workbook_id
      LEFT JOIN {listed("wb_sets", "CASE WHEN set_ord % 2 = 1 THEN '<column name=\"[Set]\" type=\"set\"/>' ELSE '<column name=\"[Set]\"><groupfilter/></column>' END")} s ON s.workbook_id = w.workbook_id
      LEFT JOIN (SELECT workbook_id, array_join(array_sort(collect_list({filters})), '') AS t FROM
        (SELECT w.workbook_id, s.k AS sheet_ord, pmod(w.workbook_id + s.k, 3) AS n FROM wb_workbooks w
         JOIN numbers s ON s.k <= w.n_sheets) GROUP BY workbook_id) f ON f.workbook_id = w.workbook_id
      LEFT JOIN (SELECT workbook_id, array_join(array_sort(collect_list(t)), '') AS t FROM
        (SELECT workbook_id, {zones} AS t FROM wb_zones GROUP BY workbook_id, dashboard_ord)
        GROUP BY workbook_id) z ON z.workbook_id = w.workbook_id
      LEFT JOIN {listed("wb_actions", "CASE WHEN tag = 'other' THEN '<action/>' ELSE concat('<action><', tag, CASE WHEN target_parameter IS NULL THEN '' ELSE concat(' parameter=\"', target_parameter, '\"') END, '/></action>') END")} a ON a.workbook_id = w.workbook_id"""
    return fx.with_views(sql)


def test_documents_are_those_of_the_views_from_one_pass_over_lines(spark, odd):
    found = fx.workbook_xml(spark, odd)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lineitem.parquet") == 1 and plan.count("orders.parquet") <= 2
    got = sorted((-99 if r.workbook_id is None else r.workbook_id, r.has_extract, r.xml or "") for r in found.collect())
    want = sorted((-99 if r.workbook_id is None else r.workbook_id, r.has_extract, r.xml or "") for r in spark.sql(view_by_view()).collect())
    assert got == want and len(got) == 48
    assert len({w for w, _, _ in got}) == 42 and any(not x for _, _, x in got) and any("&quot;" in x for _, _, x in got)


def test_small_archives_leave_a_task_together_and_a_large_one_alone():
    sizes = [10, 20, archives._BATCH_BYTES + 1, 30, archives._BATCH_BYTES - 30, 1]
    rows = [dict.fromkeys(archives._ARROW.names) | {"path": str(n), "xml": b"x" * n} for n in sizes]
    assert [b.column("path").to_pylist() for b in archives._batches(iter(rows))] == [
        ["10", "20"], [str(sizes[2])], ["30", str(sizes[4])], ["1"]
    ]
    many = [dict.fromkeys(archives._ARROW.names) | {"path": "p"}] * (archives._BATCH_ROWS + 1)
    assert [b.num_rows for b in archives._batches(iter(many))] == [archives._BATCH_ROWS, 1]
    files = pa.record_batch({"path": [f"{n}.twb" for n in range(50)], "content": [b"<workbook/>"] * 50})
    assert [b.num_rows for b in archives._open_batches([files])] == [50]


def plain_rows(key, text):
    """Rows of one document by its element tree."""
    out = []

    def walk(e, up, path, depth, sib, nth, scopes):
        row = [key, len(out), up and up[1], path, depth, e.tag, sib, nth, dict(e.attrib), dict(up[8]) if up else {}]
        out.append(row)
        tags = []
        inner = scopes
        if e.tag in shred.SCOPE_TAGS:
            inner = [*scopes, {"elem_id": row[1], "tag": e.tag, "path": path, "name": e.get("name"), "caption": e.get("caption")}]
        for n, child in enumerate(e, 1):
            tags.append(child.tag)
            walk(child, row, f"{path}/{child.tag}" if path else child.tag, depth + 1, n, tags.count(child.tag), inner)
        row += [list(dict.fromkeys(tags)), scopes, None]

    walk(ElementTree.fromstring(text), None, "", 0, 1, 1, [])
    return out


def test_shredded_columns_are_the_element_tree(monkeypatch):
    long = "<workbook>" + "".join(f"<zone id='{n}'><zone/></zone>" for n in range(9000)) + "</workbook>"
    texts = [
        "<workbook v='1'><datasources><datasource name='a' caption='A'><column name='[x]'><calculation formula='1'/></column><column/>"
        "<connection><datasource><relation type='join'/></datasource></connection></datasource></datasources></workbook>",
        "<datasource name='a'><column></datasource>", None, "", "<workbook/>",
        "<w:workbook xmlns:w='urn:w' xmlns='urn:d' w:a='1' b='2'><w:zone/><zone w:a='3'/><dashboard name='d'><zone/></dashboard></w:workbook>",
        long, "<worksheet><worksheet name='s'><filter class='c'/></worksheet><broken", "<dashboard><zone/></dashboard>",
    ]
    batch = pa.record_batch({"id": range(len(texts)), "xml": texts})
    made, build = [], shred._Elements.batch
    monkeypatch.setattr(shred._Elements, "batch", lambda rows, field: (made.append(len(rows.paths)), build(rows, field))[1])
    batches = list(shred._shred_batches([batch]))
    assert max(b.num_rows for b in batches) <= shred._ROWS_PER_BATCH and len(made) == 2 and max(made) < 30
    rows = [[dict(v) if name.endswith("attrs") else v for name, v in r.items()] for b in batches for r in b.to_pylist()]
    failed = {r[0]: r[-1] for r in rows if r[-1]}
    assert failed.keys() == {1, 2, 3, 7} and failed[2] == "no workbook XML" and failed[1].startswith("mismatched tag")
    assert [r[1:-1] for r in rows if r[-1]] == [[None] * 7 + [{}, {}, [], []]] * 4
    want = [r for n, text in enumerate(texts) if n not in failed for r in plain_rows(n, text)]
    assert sorted((r for r in rows if not r[-1]), key=lambda r: r[:2]) == want


def test_calculations_of_shredded_documents_are_made_once(spark, odd, monkeypatch):
    stored = []
    monkeypatch.setattr(ingest, "cut_lineage", lambda df: (stored.append(df.columns), cut_lineage(df))[1], raising=False)
    plan = ingest.xml_shred(spark, odd)._jdf.queryExecution().optimizedPlan().toString()
    assert stored == [["workbook_id", "calc_name", "formula", "ord"]] and "max_by" not in plan


def test_slugs_of_a_workbook_without_repeats_need_a_count_only(spark, monkeypatch):
    stored = []
    monkeypatch.setattr(vw, "cut_lineage", lambda df: (stored.append(df.columns), cut_lineage(df))[1])
    rows = [(1, 1, "a b", "x1"), (1, 2, "c", "x2"), (2, 1, "a b", "x3"), (None, 1, "n", "x4"), (3, None, "n", "x5"), (3, 1, None, "x6")]
    schema = "workbook_id int, ord int, name string, calc_id string"
    plain = vw.with_slugs(spark.createDataFrame(rows, schema))
    assert "Join" not in plain._jdf.queryExecution().optimizedPlan().toString() and stored == [["workbook_id"]]
    assert sorted((r.workbook_id, r.ord, r.slug) for r in plain.collect()) == [(1, 1, "a_b"), (1, 2, "c"), (2, 1, "a_b")]
    crowded = vw.with_slugs(spark.createDataFrame([*rows, (1, 3, "A-B", "x7")], schema))
    assert sorted((r.workbook_id, r.ord, r.slug) for r in crowded.collect()) == [(1, 1, "a_b"), (1, 2, "c"), (1, 3, "a_b_x7"), (2, 1, "a_b")]


def test_views_of_the_estate_are_not_stored(spark, odd):
    views = semantic.planned_views(spark, odd)
    assert semantic.planned_views(spark, odd) is views
    tables = [set(spark.read.parquet(path).columns) for path in {f.rsplit("/", 1)[0] for f in views.inputFiles()}]
    assert tables and not any({"definition", "sql"} & columns for columns in tables)


def test_a_stored_table_leaves_no_shuffle_behind(spark):
    keep = cut_lineage(spark.range(1000).repartition(5, "id"))
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    before = blocks.shuffleStatuses().size()
    assert cut_lineage(keep.groupBy("id").count()).count() == 1000
    after = blocks.shuffleStatuses().size()
    spark.range(1000).repartition(5, "id").write.format("noop").mode("overwrite").save()
    assert blocks.shuffleStatuses().size() > after  # a write by itself keeps its shuffle
    assert after - before <= 1  # that of the count


def test_what_fails_is_told_without_an_analysis_each_and_few_rows_are_read_once(spark, tmp_path, monkeypatch):
    lines = spark.sql("SELECT id AS qty, id * 1.0D AS price FROM range(6)")
    bad = {f"bad {n}": f"SUM([Price]) + {n} + [Qty]" for n in range(6)} | {"odd": "SUM([Price]) + [Nothing]", "one": "LEN([Price], [Qty], 3) + SUM([Qty])"}
    views = plan_formulas(spark, bad | {f"good {n}": f"SUM([Price]) + {n}" for n in range(6)}, {"main.s.lines": lines})
    wide, read, run = [], [], pub._wide
    monkeypatch.setattr(pub, "_wide", lambda source, rows, dims: (wide.append(len(rows)), run(source, rows, dims))[1])
    monkeypatch.setattr(pub, "TRIED_SET", 5)
    limit = type(lines).limit
    monkeypatch.setattr(type(lines), "limit", lambda df, n: (read.append(n), limit(df, n))[1])
    done = pub.publish(views, {"main.s.lines": lines}, str(tmp_path / "x"), lambda base: ["qty"])
    got = {r.view_name.split("mv_")[1]: (r.status, r.error) for r in done.statuses(views).collect()}
    assert {k: s for k, (s, _) in got.items()} == {n.replace(" ", "_"): "failed" for n in bad if not n.startswith("bad")} | {
        f"{kind}_{n}": "created" for n in range(6) for kind in ("good", "bad")  # quantity is a key
    }
    assert len(read) == 1 and wide.count(1) <= 2
    done = pub.publish(views, {"main.s.lines": lines}, str(tmp_path / "y"))
    got = {r.view_name.split("mv_")[1]: (r.status, r.error) for r in done.statuses(views).collect()}
    assert {s for k, (s, _) in got.items() if k.startswith("bad")} == {"failed"}
    plain = {}
    for r in done.states().where("state = 'failed'").collect():
        plain[r.definition] = r.why
    for r in views.withColumn("definition", pub.definition_id()).where("definition IN ('" + "','".join(plain) + "')").collect():
        why = {}
        assert pub._usable([r], lambda rows: run(lines.limit(0), rows, []).schema, why) == []
        assert why == {r.definition: plain[r.definition]}
