"""One aggregation for all counts of a workbook: same results as the parts, nothing joined, sorted or rendered for it."""

import random
from decimal import ROUND_HALF_EVEN, Decimal

import pytest
from pyspark.sql import functions as F

from vizquarry.functions.numbers import round1
from vizquarry.operators import elements as el, graphs, metrics
from vizquarry.operators.depth import nesting_depth
from vizquarry.sources import shred

BOOK = """<workbook><datasources>
  <datasource name="Parameters"><column name="[P]" caption="P 1"/></datasource>
  <datasource name="s"><connection><relation type="join"/><relation type="text"/></connection>
   <column name="[A]"><calculation class="tableau" formula="[Parameters].[P 1] + [[B]"/></column>
   <column name="[B]"><calculation class="tableau" formula="{fixed [x]: WINDOW_SUM([A])}"/></column></datasource></datasources>
 <worksheets><worksheet name="s1"><table><view><filter/><datasources><datasource name="s"/></datasources></view></table></worksheet></worksheets>
 <dashboards><dashboard name="d"><zones><zone type="extension"><zone/><zone/></zone></zones></dashboard><dashboard name="e"/></dashboards>
 <actions>%s</actions><storyboards><storyboard/></storyboards></workbook>"""
# One target by its token, one behind a second bracket, one that holds brackets itself, two that no formula names.
TARGETS = ["[P 1]", "[P 1]", "[B]", "[Parameters].[P 1]", "[no].[P 1]", "[P]"]


@pytest.fixture(scope="module")
def book(spark):
    actions = "".join(f'<action><parameter parameter="{t}"/></action>' for t in TARGETS)
    docs = [("a", BOOK % actions), ("b", "<workbook/>"), ("c", BOOK % "<action><set/></action>")]
    rows = shred.elements(shred.shred(spark.createDataFrame(docs, "workbook_id string, xml string"))).cache()
    # A root that comes twice, a workbook without a root, rows without a workbook.
    again = rows.where("workbook_id = 'c' AND depth = 0")
    rootless = rows.where("workbook_id = 'a' AND depth > 0")
    return rows.unionByName(again).unionByName(rootless.withColumn("workbook_id", F.lit("d"))).unionByName(
        rows.where("workbook_id = 'a'").withColumn("workbook_id", F.lit(None).cast("string"))
    )


def _plain(book):
    """Without actions whose target holds brackets."""
    return book.where("attrs['parameter'] IN ('[P 1]', '[B]', '[P]') OR attrs['parameter'] IS NULL")


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("variant", el.VARIANTS)
def test_facts_are_the_joined_parts(book, variant):
    calcs = metrics.stored_calcs(book, variant)
    parts = metrics.data_model(book, variant)
    for part in (
        metrics.calculations(calcs, nesting_depth(calcs), metrics.workbooks(book)), metrics.structure(book),
        metrics.interactivity(book, calcs, variant), metrics.no_equivalent(book, variant),
    ):
        parts = parts.join(part, "workbook_id")
    facts = metrics.estate_facts(book, variant, calcs)
    assert facts.columns == parts.columns
    assert facts.dtypes == parts.dtypes
    rows = sorted(map(tuple, facts.collect()))
    assert rows == sorted(map(tuple, parts.collect())) and [r[0] for r in rows] == ["a", "b", "c", "c"]
    plan = _plan(metrics.estate_facts(_plain(book), variant, calcs))
    assert "Join" not in plan and "Sort" not in plan


def test_actions_feed_by_token_and_by_text(book):
    calcs = el.calc_fields(book)
    fed = {r.workbook_id: r.num_param_actions_feeding_calc for r in metrics.feeding_actions(book, calcs).collect()}
    assert fed == {"a": 4, "d": 4}
    # References that are stored already do for targets without brackets: no formula is read.
    refs = metrics.stored_calcs(book).drop("formula")
    fed = {r.workbook_id: r.num_param_actions_feeding_calc for r in metrics.feeding_actions(_plain(book), refs).collect()}
    assert fed == {"a": 3, "d": 3}


def test_depth_takes_stored_references(book):
    calcs = metrics.stored_calcs(book)
    want = {r.workbook_id: r.max_calc_nesting_depth for r in nesting_depth(calcs.drop("refs")).collect()}
    got = {r.workbook_id: r.max_calc_nesting_depth for r in nesting_depth(calcs.drop("formula")).collect()}
    assert got == want and got["c"] == 2


def test_rounds_hold_new_constants_only(spark, monkeypatch):
    # n0 -> n1 -> ... -> n9, and n0 -> n9: a node's constants are stored in the round that finds them and not again.
    pairs = [(f"n{i}", f"n{i + 1}") for i in range(9)] + [("n0", "n9")]
    made, add = [], graphs.Steps.add
    monkeypatch.setattr(graphs.Steps, "add", lambda self, df: (made.append(df), add(self, df))[1])
    edges = spark.createDataFrame([(1, a, b) for a, b in pairs], "g int, src string, dst string")
    got = {r.src: r.value for r in graphs.longest_paths(edges, ["g"]).collect()}
    assert got == {f"n{i}": 10 - i for i in range(9)}
    assert all("Window" not in _plan(df) for df in made)
    assert sorted(v for df in made for (v,) in df.where("src = 'n0' AND dst IS NULL").select("value").collect()) == [2, 10]


def test_rounding_uses_no_decimals(spark):
    rng = random.Random(5)
    values = [0.05, 0.15, 0.25, 0.35, 2.5, 99.95, 0.0, 1e15 + 0.25, *[rng.random() * 10 ** rng.randint(0, 8) for _ in range(500)]]
    df = spark.createDataFrame([(v,) for v in values], "v double").select("v", round1(F.col("v")).alias("r"))
    assert "decimal" not in _plan(df)
    for row in df.collect():
        assert row.r == float(Decimal(row.v).quantize(Decimal("0.1"), ROUND_HALF_EVEN))
