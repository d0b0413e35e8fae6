import itertools
import random
import re
import zipfile

import pytest
from pyspark.sql import functions as F

from vizquarry.operators import elements as el, graphs, inline, metrics, score
from vizquarry.operators.depth import nesting_depth
from vizquarry.sources import archives, shred, sinks

BOOK = """<workbook>
 <datasources>
  <datasource name="Parameters"><column name="[P 1]" caption="P1"/><column name="[Q]"/></datasource>
  <datasource name="ds" caption="Sales">
   <connection><relation type="join"><relation type="text"/><relation type="table"/></relation></connection>
   <column name="[Calc_1]" caption="One"><calculation class="tableau" formula="SUM([x]) + [Parameters].[P 1]"/></column>
   <column name="[Calc_2]"><calculation class="bin" formula="[Calc_1] * 2"/></column>
   <column name="[Calc_2]"><calculation class="tableau" formula="{fixed [a]: [Calc_1]}"/></column>
   <column name="[Set]" type="set"/><column name="[Set 2]"><groupfilter/></column>
   <column name="[Empty]"><calculation class="tableau" formula=""/></column>
  </datasource>
 </datasources>
 <worksheets>
  <worksheet name="s1"><table><view><datasources><datasource name="ds"><column name="[Calc_1]">
    <calculation class="tableau" formula="nested"/></column></datasource></datasources>
    <filter/><x><filter/></x></view></table></worksheet>
  <worksheet name="s2"/>
 </worksheets>
 <dashboards>
  <dashboard name="d1"><zones><zone><zone param="vert"><zone/><zone/></zone></zone><zone/></zones>
   <devicelayouts><devicelayout><zones><zone><zone><zone><zone/></zone></zone></zone></zones></devicelayout></devicelayouts>
  </dashboard>
  <dashboard name="d2"><zone/></dashboard>
 </dashboards>
 <actions>
  <action><parameter parameter="[Parameters].[P 1]"/></action>
  <action><parameter parameter="[Nowhere]"/></action>
  <action><set/><parameter parameter="[Parameters].[P 1]"/></action>
  <action/><action><brand-new/></action>
 </actions>
</workbook>"""


@pytest.fixture(scope="module")
def rows(spark):
    docs = [("a", BOOK), ("b", "<workbook/>"), ("broken", "<workbook><x></workbook>"), ("none", None)]
    return shred.shred(spark.createDataFrame(docs, "workbook_id string, xml string")).cache()


@pytest.fixture(scope="module")
def book(rows):
    return shred.elements(rows)


def one(df, key="a"):
    return df.where(F.col("workbook_id") == key).first().asDict()


def test_broken_documents_become_rows(rows):
    assert {r.workbook_id for r in shred.failures(rows).collect()} == {"broken", "none"}
    assert shred.elements(rows).where("workbook_id = 'broken'").isEmpty()


def test_element_context(book):
    calc = book.where("tag = 'calculation' AND attrs['formula'] = 'nested'").first()
    assert calc.path == "worksheets/worksheet/table/view/datasources/datasource/column/calculation"
    assert [s.tag for s in calc.scopes] == ["worksheet", "datasource"]
    assert calc.parent_attrs == {"name": "[Calc_1]"} and (calc.sib_ord, calc.tag_ord, calc.depth) == (1, 1, 8)
    root = book.where("workbook_id = 'a' AND depth = 0").first()
    assert root.child_tags == ["datasources", "worksheets", "dashboards", "actions"]
    assert book.groupBy("workbook_id", "elem_id").count().where("count > 1").isEmpty()


def test_strict_and_broad_sources(book):
    strict, broad = one(metrics.data_model(book)), one(metrics.data_model(book, "broad"))
    assert (strict["num_datasources"], strict["num_joins"], strict["num_custom_sql"]) == (1, 1, 1)
    assert broad["num_datasources"] == 2


def test_calc_fields_keep_the_last_formula(book):
    calcs = {r.calc_name: r.formula for r in el.calc_fields(book).collect()}
    assert calcs == {"Calc_1": "SUM([x]) + [Parameters].[P 1]", "Calc_2": "{fixed [a]: [Calc_1]}"}
    assert {r.formula for r in el.calc_fields(book, "broad").collect()} == {"nested", "{fixed [a]: [Calc_1]}"}


def test_calc_records(book):
    found = [(r.datasource, r.name, r.formula) for r in el.calc_records(book).orderBy("source_ord", "calc_ord").collect()]
    assert found == [
        ("Sales", "One", "SUM([x]) + [Parameters].[P 1]"), ("Sales", "Calc_2", "{fixed [a]: [Calc_1]}"),
        ("ds", "Calc_1", "nested"),
    ]


def test_structure(book):
    s = one(metrics.structure(book))
    assert (s["num_sheets"], s["num_dashboards"], s["max_container_nesting_depth"]) == (2, 2, 3)
    # Four leaves in d1 (one of them in a device layout); d2 has no zone list.
    assert s["avg_objects_per_dashboard"] == 2.0
    empty = one(metrics.structure(book), "b")
    assert (empty["num_dashboards"], empty["avg_objects_per_dashboard"]) == (0, 0.0)


def test_interactivity(book):
    i = one(metrics.interactivity(book, el.calc_fields(book)))
    assert (i["num_filters"], i["num_parameters"], i["num_sets"]) == (2, 2, 2)
    assert (i["num_actions_parameter"], i["num_param_actions_feeding_calc"]) == (2, 1)
    assert (i["num_actions_filter"], i["num_actions_url"]) == (0, 0)


def test_features(book):
    assert one(metrics.no_equivalent(book))["no_equivalent_features"] == "Set Actions"
    assert one(metrics.no_equivalent(book, "broad"))["no_equivalent_features"] == (
        "Dynamic Zone Visibility (DZV), Set Actions"
    )


def test_scorecard_properties(spark, book):
    books = spark.createDataFrame(
        [("a", "a.twb", "A", ["t"]), ("b", "b.twb", "B", ["t"])],
        "workbook_id string, twb_file string, workbook_name string, table_paths array<string>",
    )
    for scorer in score.SCORERS:
        cards = score.scorecard(book, books, scorer).collect()
        assert len(cards) == 2
        for c in cards:
            assert all(0 <= c[f"score_{k}"] <= 100 for k in ("data_model", "calculations", "structure", "interactivity"))
    a, b = sorted(score.scorecard(book, books).collect(), key=lambda c: c.workbook_id)
    assert a.complexity_tier == "Complex" and a.override_flags == "parameter action feeds a calculated field"
    assert not a.proceed and "Set Actions" in a.proceed_reason and "Calc_1; Calc_2" in a.authoring_line
    assert b.proceed and b.complexity_tier == "Simple" and b.max_calc_nesting_depth == 0


def brute_depth(edges, nodes):
    longest = 1
    for n in range(2, len(nodes) + 1):
        for walk in itertools.permutations(nodes, n):
            if all((a, b) in edges for a, b in itertools.pairwise(walk)):
                longest = n
                break
    return longest


def test_depth_of_random_graphs_all_ways(spark):
    rng = random.Random(7)
    calcs, want = [], {}
    for wb in range(60):
        nodes = [f"n{i}" for i in range(rng.randint(1, 6))]
        edges = {(a, b) for a in nodes for b in nodes if a != b and rng.random() < 0.3}
        want[wb] = brute_depth(edges, nodes)
        pairs = sorted(edges)
        for i, a in enumerate(nodes):
            text = " + ".join([f"[{b}]" for x, b in pairs if x == a] + [f"[{a}]", "[elsewhere]"])
            calcs.append((wb, a, text, i))
    df = spark.createDataFrame(calcs, "workbook_id int, calc_name string, formula string, ord int")
    got = {r.workbook_id: r.max_calc_nesting_depth for r in nesting_depth(df).collect()}
    assert got == want


RECORDS = "workbook_id int, source_ord int, calc_ord int, datasource string, calc_id string, name string, formula string, datatype string, tableau_role string"


def record(wb, order, key, name, formula, ds="ds"):
    return (wb, 1, order, ds, key, name, formula, None, None)


def test_inlining_by_hand(spark):
    df = spark.createDataFrame(
        [
            record(1, 1, "a", "A", "[b] + 1 // c"),
            record(1, 2, "b", "B", "[C] * [x]"),
            record(1, 3, "c", "C", "2"),
            record(2, 1, "a", "A", "[B]"),
            record(2, 2, "b", "B", "[a] + [A]"),
            record(3, 1, "a", "Same", "1"),
            record(3, 2, "b", "Same", "2 + [Same]"),
            record(3, 3, "c", "C", "[Same]"),
            record(4, 1, "a", "A", "[b]", "other"),
        ],
        RECORDS,
    )
    got = {(r.workbook_id, r.calc_id): r.formula_inlined for r in inline.inline_references(df).collect()}
    assert got == {
        (1, "a"): "((2) * [x]) + 1", (1, "b"): "(2) * [x]", (1, "c"): "2",
        (2, "a"): "([a] + [A])", (2, "b"): "([B]) + ([B])",
        (3, "a"): "1", (3, "b"): "2 + [Same]", (3, "c"): "(2 + [Same])",
        (4, "a"): "[b]",
    }


def brute_inline(rows):
    found = {}
    for wb in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == wb), key=lambda r: r[1:3])
        defined = {}
        for _, _, _, _, key, name, formula, _, _ in own:
            defined[key] = formula.strip()
            defined[name] = formula.strip()

        def expand(text, seen):
            def one(m):
                token = m.group()[1:-1]
                if token not in defined or token in seen:  # noqa: B023
                    return m.group()
                return "(" + expand(defined[token], seen | {token}) + ")"  # noqa: B023

            return re.sub(r"\[[^\]]+\]", one, text)

        found |= {(wb, r[2]): expand(r[6].strip(), {r[4], r[5]}) for r in own}
    return found


def test_inlining_of_random_sources(spark):
    rng = random.Random(3)
    rows = []
    for wb in range(40):
        n = rng.randint(1, 5)
        ids = [f"c{i}" for i in range(n)]
        caps = [rng.choice(["K", "L", f"N{i}"]) for i in range(n)]
        for i in range(n):
            parts = [rng.choice(["[" + rng.choice(ids + caps + ["zz"]) + "]", "x", "[q] "]) for _ in range(3)]
            rows.append(record(wb, i, ids[i], caps[i], "".join(parts)))
    got = inline.inline_references(spark.createDataFrame(rows, RECORDS)).collect()
    assert {(r.workbook_id, r.calc_ord): r.formula_inlined for r in got} == brute_inline(rows)


def test_depth_of_a_long_chain(spark):
    rows = [(1, f"n{i}", f"[n{i + 1}] + [n{min(i + 2, 24)}]", i) for i in range(24)] + [(1, "n24", "1", 24)]
    df = spark.createDataFrame(rows, "workbook_id int, calc_name string, formula string, ord int")
    assert [r.max_calc_nesting_depth for r in nesting_depth(df).collect()] == [25]


def test_dedupe_takes_first_non_null(spark):
    df = spark.createDataFrame(
        [
            (1, 1, 1, "s2", "a", "N", "x  y", None, "r1", "x  y"),
            (1, 2, 1, "s1", "b", "N", "x y", "real", None, " x y"),
            (1, 3, 1, "s1", "c", "N", "other", "int", None, "other"),
        ],
        RECORDS + ", formula_inlined string",
    )
    got = inline.dedupe_calcs(df).orderBy("ord").collect()
    assert [(r.calc_id, r.datatype, r.tableau_role, r.datasources) for r in got] == [
        ("a", "real", "r1", ["s1", "s2"]), ("c", "int", None, ["s1"]),
    ]


def test_corpus_from_files(spark, tmp_path):
    def pack(name, members):
        with zipfile.ZipFile(tmp_path / name, "w", zipfile.ZIP_DEFLATED) as z:
            for member, text in members.items():
                z.writestr(member, text)

    pack("good.twbx", {"Book.TWB": BOOK, "Data/x.hyper": "", "Data/Y.HYPER": ""})
    pack("two.twbx", {"z.twb": "<workbook/>", "a.twb": "<other/>"})
    pack("none.twbx", {"readme.txt": ""})
    (tmp_path / "bad.twbx").write_bytes(b"no zip")
    (tmp_path / "bare.twb").write_text("<workbook/>")
    broken = bytearray((tmp_path / "good.twbx").read_bytes())
    at = broken.index(b"Book.TWB") + len("Book.TWB")
    broken[at : at + 8] = b"\xff" * 8  # the member's data, in a sound archive
    (tmp_path / "damaged.twbx").write_bytes(bytes(broken))
    (tmp_path / "notes.txt").write_text("no workbook")
    corpus = archives.read_corpus(spark, str(tmp_path))
    got = {r.path.rsplit("/", 1)[-1]: r for r in corpus.collect()}
    assert set(got) == {"good.twbx", "two.twbx", "none.twbx", "bad.twbx", "bare.twb", "damaged.twbx"}
    assert got["good.twbx"].member == "Book.TWB" and len(got["good.twbx"].extracts) == 2
    assert got["two.twbx"].member == "z.twb" and got["two.twbx"].n_workbook_members == 2
    assert got["none.twbx"].error and got["bad.twbx"].error and got["damaged.twbx"].error
    assert bytes(got["bare.twb"].xml) == b"<workbook/>"
    live = {r.path.rsplit("/", 1)[-1] for r in archives.without_extract(corpus).collect()}
    assert live == {"two.twbx", "bare.twb"}
    books = corpus.where("xml IS NOT NULL").withColumn("workbook_id", F.col("path"))
    assert shred.elements(shred.shred(books)).where("depth = 0").count() == 3


def test_append_adds_columns_and_keeps_types(spark, tmp_path):
    name, path = "append_test", str(tmp_path / "t")
    first = spark.range(2).selectExpr("id", "'a' AS x")
    sinks.write_table(first, name, "overwrite", path)
    second = spark.range(2, 4).selectExpr("id * 1.5D AS y", "id")
    got = sinks.write_table(second, name, "append").orderBy("id").collect()
    assert [tuple(r) for r in got] == [(0, "a", None), (1, "a", None), (2, None, 3.0), (3, None, 4.5)]
    with pytest.raises(ValueError):
        sinks.write_table(spark.range(1).selectExpr("'t' AS id"), name, "append")
    with pytest.raises(ValueError):
        sinks.write_table(first, name, "merge")
    spark.sql(f"DROP TABLE {name}")


def test_depth_of_a_very_long_chain_and_a_dense_cycle(spark):
    """500 fields in a row take nine rounds; twelve fields that all refer to each other are searched alone."""
    rows = [(1, f"c{i}", f"[c{i + 1}]", i) for i in range(499)] + [(1, "c499", "1", 499)]
    ring = [f"r{i}" for i in range(12)]
    rows += [(2, r, " + ".join(f"[{x}]" for x in ring if x != r) + (" + [tail]" if r == "r5" else ""), i) for i, r in enumerate(ring)]
    rows += [(2, f"t{i}", f"[t{i + 1}]", 100 + i) for i in range(40)] + [(2, "t40", "[r3] + [r4]", 200)]
    rows += [(2, "tail", "[end]", 201), (2, "end", "1", 202), (2, "aside", "[r0]", 203)]
    rows += [(3, "x", "[y]", 0), (3, "y", "[x] + [p]", 1), (3, "p", "[q] + [z]", 2), (3, "q", "[p]", 3), (3, "z", "1", 4)]
    df = spark.createDataFrame(rows, "workbook_id int, calc_name string, formula string, ord int")
    got = {r.workbook_id: r.max_calc_nesting_depth for r in nesting_depth(df).collect()}
    assert got == {1: 500, 2: 41 + 12 + 2, 3: 4}


def test_longest_paths_of_every_node(spark):
    rng = random.Random(11)
    edges, want = [], {}

    def longest(adjacent, node, seen):
        return 1 + max((longest(adjacent, x, seen | {x}) for x in adjacent[node] - seen), default=0)

    for g in range(50):
        nodes = [f"n{i}" for i in range(rng.randint(2, 8))]
        own = {(rng.choice(nodes), rng.choice(nodes)) for _ in range(rng.randint(1, 14))}
        own = {(a, b) for a, b in own if a != b}
        adjacent = {n: {b for a, b in own if a == n} for e in own for n in e}
        want.update({(g, n): longest(adjacent, n, {n}) for n in adjacent})
        edges += [(g, a, b) for a, b in own] * 2
    df = spark.createDataFrame(edges, "g int, src string, dst string")
    got = {(r.g, r.src): r.value for r in graphs.longest_paths(df, ["g"]).collect()}
    assert got == {k: v for k, v in want.items() if v > 1}  # fields that refer to nothing are 1
    assert graphs.longest_paths(df.where("g < 0"), ["g"]).isEmpty()


def test_shared_definitions_are_expanded_once(spark):
    """A chain of 40 whose every field is used twice by the one above would be 2^40 rows path by path; here 12 are."""
    n = 12
    rows = [record(1, i, f"c{i}", f"Name {i}", f"[c{i + 1}]-[Name {i + 1}]" if i < n else "x") for i in range(n + 1)]
    rows += [record(2, 0, "a", "A", "[b] + [q]"), record(2, 1, "b", "B", "[a] + [q]"), record(2, 2, "q", "Q", "[r] * [R]"), record(2, 3, "r", "R", "1")]
    rows += [record(3, 0, "a", "Same", "[b]"), record(3, 1, "b", "Same", "[a] + [Same]"), record(3, 2, "c", "C", "[Same]")]
    got = inline.inline_references(spark.createDataFrame(rows, RECORDS)).collect()
    assert {(r.workbook_id, r.calc_ord): r.formula_inlined for r in got} == brute_inline(rows)
    assert {len(r.formula_inlined) for r in got if r.workbook_id == 1 and r.calc_ord == 0} == {6 * 2**n - 5}
