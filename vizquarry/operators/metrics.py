"""Per-workbook metrics. Each is map-side combined counting; workbooks without a hit keep their zero."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from vizquarry import fixed
from vizquarry.functions.formulas import has_lod, has_table_calc, raw_refs
from vizquarry.functions.numbers import round1
from vizquarry.operators.elements import (
    SOURCE_PATH,
    at,
    calc_fields,
    ends_with,
    is_parameters,
    last_scope,
    parameter_actions,
    parameters,
    scopes_at,
)
from vizquarry.session import cut_lineage


def workbooks(elements: DataFrame) -> DataFrame:
    """One row per workbook: its root element."""
    return elements.where(F.col("depth") == 0).select("workbook_id")


#: Counts of which a workbook has the largest; the others add up.
LARGEST = {"max_container_nesting_depth", "max_calc_nesting_depth"}


def _one(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def _is_root() -> Column:
    return F.col("depth") == 0


def _rows(elements: DataFrame, *parts: tuple[Column, dict[str, Column]]) -> DataFrame:
    """What each row that a part looks at, or a root row, adds to the counts of its workbook."""
    wanted = reduce(lambda a, b: a | b, [w for w, _ in parts], _is_root())
    values = {name: value for _, part in parts for name, value in part.items()}
    return elements.where(wanted).select("workbook_id", *[v.alias(n) for n, v in values.items()])


def _summed(rows: DataFrame) -> DataFrame:
    """One row per workbook."""
    names = [c for c in rows.columns if c != "workbook_id"]
    return rows.groupBy("workbook_id").agg(*[(F.max if n in LARGEST else F.sum)(n).alias(n) for n in names])


def _relation_hits(variant: str) -> Column:
    """How many counted data sources a relation row lies below."""
    own = lambda s: ~is_parameters(s["name"])
    if variant == "strict":
        sources = F.filter("scopes", lambda s: (s["path"] == SOURCE_PATH) & own(s))
    else:
        sources = F.filter("scopes", lambda s: ends_with(s["path"], SOURCE_PATH) & own(s))
    return F.size(sources)


def _sources(variant: str) -> tuple[Column, dict[str, Column]]:
    tag, kind = F.col("tag"), F.col("attrs")["type"]
    is_source = (tag == "datasource") & at(SOURCE_PATH, variant) & ~is_parameters(F.col("attrs")["name"])
    hits = F.when(tag == "relation", _relation_hits(variant)).otherwise(0)
    return is_source | (tag == "relation"), {
        "num_datasources": _one(is_source),
        "num_joins": F.when(kind == "join", hits).otherwise(0),
        "num_custom_sql": F.when(kind == "text", hits).otherwise(0),
    }


def data_model(elements: DataFrame, variant: str = "strict") -> DataFrame:
    return _summed(_rows(elements, _sources(variant)))


def _calc_rows(calcs: DataFrame) -> DataFrame:
    return calcs.select(
        "workbook_id",
        F.lit(1).alias("num_calc_fields"),
        _one(has_lod("formula")).alias("num_lod_expressions"),
        _one(has_table_calc("formula")).alias("num_table_calcs"),
    )


def calculations(calcs: DataFrame, depths: DataFrame, books: DataFrame) -> DataFrame:
    """``calcs`` from ``calc_fields``; ``depths`` holds (workbook_id, max_calc_nesting_depth)."""
    return _zero_filled(books, _summed(_calc_rows(calcs)), depths)


def _zero_filled(books: DataFrame, *parts: DataFrame) -> DataFrame:
    joined = reduce(lambda left, right: left.join(right, "workbook_id", "left"), parts, books)
    return joined.select(
        "workbook_id",
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in joined.columns if c != "workbook_id"],
    )


def _sheets() -> tuple[Column, dict[str, Column]]:
    tag, path = F.col("tag"), F.col("path")
    # Zones nested in each other straight below a dashboard's own zone list.
    nest = F.regexp_extract("path", r"(?:^|/)dashboards/dashboard/zones((?:/zone)+)$", 1)
    return tag.isin("worksheet", "dashboard", "zone"), {
        "num_sheets": _one((tag == "worksheet") & ends_with(path, "worksheets/worksheet")),
        "num_dashboards": _one((tag == "dashboard") & ends_with(path, "dashboards/dashboard")),
        "max_container_nesting_depth": F.when(tag == "zone", F.length(nest) / F.lit(len("/zone"))).otherwise(0).cast("bigint"),
    }


def _object_rows(elements: DataFrame) -> DataFrame:
    """(workbook_id, _objects): leaf zones of every dashboard."""
    tag, path = F.col("tag"), F.col("path")
    # Leaf zones count where the dashboard has a zone list of its own.
    boards = elements.where((tag == "dashboard") & ends_with(path, "dashboards/dashboard")).select(
        "workbook_id",
        F.col("elem_id").alias("dashboard_id"),
        F.lit(0).alias("leaf"),
        F.array_contains("child_tags", "zones").alias("has_zones"),
    )
    leaves = (
        elements.where((tag == "zone") & ~F.array_contains("child_tags", "zone"))
        .withColumn("_board", F.explode(scopes_at("dashboards/dashboard")))
        .select(
            "workbook_id",
            F.col("_board.elem_id").alias("dashboard_id"),
            F.lit(1).alias("leaf"),
            F.lit(False).alias("has_zones"),
        )
    )
    return (
        boards.unionByName(leaves)
        .groupBy("workbook_id", "dashboard_id")
        .agg(F.sum("leaf").alias("leaves"), F.max("has_zones").alias("has_zones"))
        .select("workbook_id", F.when(F.col("has_zones"), F.col("leaves")).otherwise(0).alias("_objects"))
    )


def _objects_per_dashboard() -> Column:
    per_board = F.coalesce("_objects", F.lit(0)).cast("double") / F.col("num_dashboards")
    return F.when(F.col("num_dashboards") > 0, round1(per_board)).otherwise(F.lit(0.0))


def structure(elements: DataFrame) -> DataFrame:
    return (
        _summed(_rows(elements, _sheets()))
        .join(_summed(_object_rows(elements)), "workbook_id", "left")
        .withColumn("avg_objects_per_dashboard", _objects_per_dashboard())
        .drop("_objects")
    )


TOKEN = r"\[([^\[\]]+)\]"


def _fed_rows(elements: DataFrame, calcs: DataFrame) -> DataFrame:
    """(workbook_id, num_param_actions_feeding_calc) of every target that some formula names.

    A formula names a target without brackets where it is one of the formula's bracket tokens, so both
    sides are counted by token in one aggregation, combined before it shuffles, and no formula moves.
    """
    count = "num_param_actions_feeding_calc"
    actions, bracket = parameter_actions(elements), F.col("target").rlike(r"[\[\]]")
    counted = actions.where(~bracket).select("workbook_id", F.col("target").alias("token"), F.lit(1).alias("n"), F.lit(0).alias("named"))
    # The bracket token that ends with a reference is what follows the reference's last opening bracket.
    refs = F.col("refs") if "refs" in calcs.columns else raw_refs("formula")
    named = calcs.select("workbook_id", F.explode(refs).alias("ref"))
    named = named.select("workbook_id", F.substring_index("ref", "[", -1).alias("token"), F.lit(0).alias("n"), F.lit(1).alias("named"))
    fed = (
        counted.unionByName(named)
        .groupBy("workbook_id", "token")
        .agg(F.sum("n").alias(count), F.max("named").alias("named"))
        .where((F.col(count) > 0) & (F.col("named") == 1) & F.col("workbook_id").isNotNull())
        .select("workbook_id", count)
    )
    odd = cut_lineage(actions.where(bracket))
    return fed if odd.isEmpty() else fed.unionByName(_fed_by_text(odd, calcs).withColumnRenamed("n", count))


def _fed_by_text(actions: DataFrame, calcs: DataFrame) -> DataFrame:
    """(workbook_id, n) of targets that hold brackets themselves.

    The substring test becomes an equi-join on a bracket token that the sought text must contain, and
    the test itself runs on the pairs that share it. Targets are made distinct first, so the formula
    side of a hot token meets each target once and an inner join may be split where it is skewed.
    """
    actions = actions.groupBy("workbook_id", "target").agg(F.count(F.lit(1)).alias("n"))
    sought = actions.withColumn("needle", F.concat(F.lit("["), "target", F.lit("]")))
    # A needle without a token holds "[]"; so does every formula that contains it.
    sought = sought.withColumn("token", F.regexp_extract("needle", TOKEN, 1))
    tokens = F.array_union(
        F.array_distinct(F.regexp_extract_all("formula", F.lit(TOKEN), F.lit(1))),
        F.when(F.col("formula").contains("[]"), F.array(F.lit(""))).otherwise(
            F.array().cast("array<string>")
        ),
    )
    offered = calcs.select("workbook_id", "formula", F.explode(tokens).alias("token"))
    return (
        sought.join(offered, ["workbook_id", "token"])
        .where(F.col("formula").contains(F.col("needle")))
        .select("workbook_id", "target", "n")
        .distinct()
        .select("workbook_id", "n")
    )


def feeding_actions(elements: DataFrame, calcs: DataFrame) -> DataFrame:
    """(workbook_id, num_param_actions_feeding_calc): parameter actions whose target some formula names."""
    return _summed(_fed_rows(elements, calcs))


def _first_child() -> Column:
    return F.coalesce(F.get("child_tags", F.lit(0)), F.lit("other"))


def _controls(variant: str) -> tuple[Column, dict[str, Column]]:
    tag, path = F.col("tag"), F.col("path")
    is_set = (
        (tag == "column")
        & at(SOURCE_PATH + "/column", variant)
        & (
            F.coalesce(F.col("attrs")["type"] == "set", F.lit(False))
            | F.array_contains("child_tags", "groupfilter")
        )
    )
    is_action = (tag == "action") & ends_with(path, "actions/action")
    return (tag == "filter") | is_set | is_action, {
        "num_filters": F.when(tag == "filter", F.size(scopes_at("worksheets/worksheet"))).otherwise(0),
        "num_sets": _one(is_set),
        **{
            f"num_actions_{kind}": _one(is_action & (_first_child() == kind))
            for kind in ("filter", "highlight", "url", "parameter")
        },
    }


def _parameter_rows(elements: DataFrame, variant: str) -> DataFrame:
    return parameters(elements, variant).select("workbook_id", F.lit(1).alias("num_parameters"))


def interactivity(elements: DataFrame, calcs: DataFrame, variant: str = "strict") -> DataFrame:
    counts = _summed(_rows(elements, _controls(variant)))
    return _zero_filled(counts, _summed(_parameter_rows(elements, variant)), feeding_actions(elements, calcs))


def _features(variant: str) -> dict[str, Column]:
    tag, path, attrs = F.col("tag"), F.col("path"), F.col("attrs")
    zone = tag == "zone"
    found = {
        fixed.FEATURE_STORY: (tag == "storyboard") & ends_with(path, "storyboards/storyboard"),
        fixed.FEATURE_EXTENSION: zone & (attrs["type"] == "extension"),
    }
    if variant == "broad":
        found[fixed.FEATURE_DYNAMIC_ZONE] = zone & (
            (F.coalesce(attrs["param"], F.lit("")) != "")
            | (F.coalesce(attrs["visual-context"], F.lit("")) != "")
        )
    found[fixed.FEATURE_SET_ACTION] = (
        (tag == "action") & ends_with(path, "actions/action") & (_first_child() == "set")
    )
    return found


def _feature_counts(variant: str) -> tuple[Column, dict[str, Column]]:
    return F.col("tag").isin("storyboard", "zone", "action"), {label: _one(hit) for label, hit in _features(variant).items()}


def _feature_list(variant: str) -> Column:
    flags = [F.when(F.col(f"`{label}`") > 0, F.lit(label)) for label in _features(variant)]
    return F.concat_ws(", ", *flags).alias("no_equivalent_features")


def no_equivalent(elements: DataFrame, variant: str = "strict") -> DataFrame:
    """(workbook_id, no_equivalent_features): fixed order, joined by ', ', empty when none."""
    return _summed(_rows(elements, _feature_counts(variant))).select("workbook_id", _feature_list(variant))


def stored_calcs(elements: DataFrame, variant: str = "strict") -> DataFrame:
    """``calc_fields`` with the references of each formula, made and searched once for all that reads them."""
    return cut_lineage(calc_fields(elements, variant).withColumn("refs", raw_refs("formula")))


METRICS = [
    "num_datasources", "num_joins", "num_custom_sql",
    "num_calc_fields", "num_lod_expressions", "num_table_calcs", "max_calc_nesting_depth",
    "num_sheets", "num_dashboards", "max_container_nesting_depth", "avg_objects_per_dashboard",
    "num_filters", "num_sets", "num_actions_filter", "num_actions_highlight", "num_actions_url", "num_actions_parameter",
    "num_parameters", "num_param_actions_feeding_calc",
]


def estate_facts(elements: DataFrame, variant: str = "strict", calcs: DataFrame | None = None) -> DataFrame:
    """``estate_metrics`` and ``no_equivalent`` beside each other.

    The rows of all parts go through one aggregation, combined before its one shuffle; nothing is joined or sorted.
    """
    from vizquarry.operators.depth import nesting_depth

    if calcs is None:
        calcs = stored_calcs(elements, variant)
    parts = [
        _rows(elements, _sources(variant), _sheets(), _controls(variant), _feature_counts(variant), (_is_root(), {"_roots": _one(_is_root())})),
        _object_rows(elements),
        _parameter_rows(elements, variant),
        _fed_rows(elements, calcs),
        _calc_rows(calcs),
        nesting_depth(calcs),
    ]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    # A workbook has as many rows as roots.
    found = _summed(rows).where((F.col("_roots") > 0) & F.col("workbook_id").isNotNull())
    found = found.withColumn("_root", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_roots"))))
    counts = [
        _objects_per_dashboard().alias(m) if m == "avg_objects_per_dashboard" else F.coalesce(m, F.lit(0)).cast("bigint").alias(m)
        for m in METRICS
    ]
    return found.select("workbook_id", *counts, _feature_list(variant))


def estate_metrics(
    elements: DataFrame, variant: str = "strict", calcs: DataFrame | None = None
) -> DataFrame:
    """All counts of the scorecard, one row per workbook. ``calcs`` is ``calc_fields`` if stored already."""
    return estate_facts(elements, variant, calcs).drop("no_equivalent_features")
