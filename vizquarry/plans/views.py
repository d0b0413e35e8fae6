"""From calculated fields to metric view definitions, for the whole estate at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vizquarry import fixed
from vizquarry.functions.formulas import kind
from vizquarry.functions.names import slug, slug_suffix
from vizquarry.functions.translate import translated
from vizquarry.plans.sources import plan_sources, plan_units, with_plan_key
from vizquarry.session import cut_lineage


def colmap_json(colmap: Column) -> Column:
    return F.to_json(F.map_from_entries(colmap))


def translate_plans(plans: DataFrame) -> DataFrame:
    """Adds expr, eval_expr, kind, status; ``notes`` becomes plan notes and translation notes."""
    # Stored, so that the Python step runs once however many columns are taken from its result.
    done = cut_lineage(
        plans.withColumn("_f", F.when(F.col("fatal").isNull(), F.col("formula")))
        .withColumn("_t", translated("_f", colmap_json(F.col("colmap"))))
        .drop("_f")
    )
    refused = F.when(
        F.col("fatal").isNotNull(), F.array(F.format_string(fixed.NOTE_REFUSED, "fatal"))
    ).otherwise(F.col("_t.notes"))
    expr = F.col("_t.expr")
    notes = F.concat("notes", refused)
    return done.select(
        *[c for c in plans.columns if c != "notes"],
        notes.alias("notes"),
        expr.alias("expr"),
        F.col("_t.eval_expr").alias("eval_expr"),
        F.when(expr.isNotNull(), kind(expr)).alias("kind"),
        F.when(expr.isNull(), F.lit("unsupported"))
        .when(F.size(notes) > 0, F.lit("needs_review"))
        .otherwise(F.lit("ok"))
        .alias("status"),
    )


def with_slugs(calcs: DataFrame, order: str = "ord") -> DataFrame:
    """Adds ``slug``: unique part of the view name within a workbook.

    The first calculation of a slug keeps it, later ones get the end of their id. A slug that an earlier
    suffix made counts as used too, which may in turn give another calculation a suffix; that is repeated
    until nothing changes, as a rule at once. First appearance is a minimum per slug, so a frequent name is
    combined before the shuffle and never sorted in one task. Only workbooks in which a slug repeats are looked at
    beyond a count.
    """
    base = slug("name")
    calcs = calcs.where(F.col("workbook_id").isNotNull() & F.col(order).isNotNull() & F.col("name").isNotNull())
    counted = calcs.groupBy("workbook_id", base.alias("_slug")).agg(F.count(F.lit(1)).alias("_n"))
    crowded = cut_lineage(counted.where("_n > 1").select("workbook_id").distinct())
    if crowded.isEmpty():
        return calcs.withColumn("slug", base)
    names = calcs.join(crowded, "workbook_id", "left_semi").select(
        "workbook_id",
        F.col(order).alias("_at"),
        base.alias("_slug"),
        F.concat(base, F.lit("_"), slug_suffix("calc_id")).alias("_long"),
    )
    first = names.groupBy("workbook_id", "_slug").agg(F.min("_at").alias("_first"))
    names = cut_lineage(
        names.join(first, ["workbook_id", "_slug"])
        .withColumn("_used", F.col("_at") > F.col("_first"))
        .drop("_first")
    )
    while True:
        made = (
            names.where("_used")
            .groupBy("workbook_id", F.col("_long").alias("_slug"))
            .agg(F.min("_at").alias("_made"))
        )
        again = names.join(made, ["workbook_id", "_slug"]).where(
            ~F.col("_used") & (F.col("_at") > F.col("_made"))
        )
        again = cut_lineage(again.select("workbook_id", "_at", F.lit(True).alias("_again")))
        if again.isEmpty():
            break
        names = cut_lineage(
            names.join(again, ["workbook_id", "_at"], "left")
            .withColumn("_used", F.col("_used") | F.coalesce("_again", F.lit(False)))
            .drop("_again")
        )
    chosen = names.select(
        "workbook_id",
        F.col("_at").alias(order),
        F.when(F.col("_used"), F.col("_long")).otherwise(F.col("_slug")).alias("slug"),
    )
    chosen = cut_lineage(chosen)
    while True:  # ids that end alike: later ones also get their place, until no two are equal
        firsts = chosen.groupBy("workbook_id", "slug").agg(F.min(order).alias("_first"), F.count("*").alias("_n"))
        repeated = firsts.where("_n > 1").select("workbook_id", "slug", "_first")
        if repeated.isEmpty():
            break
        longer = F.concat("slug", F.lit("_"), F.col(order).cast("string"))
        chosen = cut_lineage(
            chosen.join(repeated, ["workbook_id", "slug"], "left")
            .withColumn("slug", F.when(F.col(order) > F.col("_first"), longer).otherwise(F.col("slug")))
            .drop("_first")
        )
    return calcs.join(chosen, ["workbook_id", order], "left").withColumn("slug", F.coalesce("slug", base))


def _json_text(c: Column) -> Column:
    """A string as JSON text, which is also a double quoted YAML scalar."""
    listed = F.to_json(F.array(c))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def definition_yaml(include_source_fields: bool = False) -> Column:
    """Definition text from slug, name, kind, expr, comment, base and joins."""
    q = lambda c: _json_text(F.col(c) if isinstance(c, str) else c)
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    joins = F.transform(
        "joins",
        lambda j: text(
            "  - name: ", q(j["name"]), "\n    source: ", q(j["source"]), "\n    on: ", q(j["on"])
        ),
    )
    entry = text(
        "  - name: ", q("slug"), "\n    expr: ", q("expr"), "\n    display_name: ", q("name")
    )
    dimension = F.col("kind") == "dimension"
    wildcard = F.lit('  - expr: "source.*"')
    if include_source_fields:
        fields = F.concat_ws("\n", F.lit("fields:"), wildcard, F.when(dimension, entry))
    else:
        fields = F.when(dimension, text("fields:\n", entry))
    counter = F.lit('  - name: "record_count"\n    expr: "COUNT(1)"\n    display_name: "Record Count"')
    return F.concat_ws(
        "\n",
        F.lit(f"version: {fixed.DEFINITION_VERSION}"),
        text("comment: ", q("comment")),
        text("source: ", q("base")),
        F.when(F.size("joins") > 0, text("joins:\n", F.array_join(joins, "\n"))),
        fields,
        F.lit("measures:"),
        F.when(dimension, counter).otherwise(entry),
    )


def _ddl() -> Column:
    quoted = F.array_join(
        F.transform(
            F.split("view_name", r"\."),
            lambda p: F.concat(F.lit("`"), F.replace(p, F.lit("`"), F.lit("``")), F.lit("`")),
        ),
        ".",
    )
    return F.format_string(fixed.DEFINITION_DDL.replace("\n", "%n"), quoted, F.col("definition"))


def build_views(
    calcs: DataFrame,
    catalog: DataFrame,
    target_schema: str = "",
    prefix: str = fixed.VIEW_PREFIX,
    include_source_fields: bool = False,
) -> DataFrame:
    """One metric view definition per deduplicated calculation.

    ``calcs`` comes from ``dedupe_calcs`` with a ``source_set`` column naming the candidate tables.
    Distinct (formula, hints, tables) are planned and translated once and joined back.
    """
    renamed = {"formula": "original", "formula_inlined": "formula", "datasources": "hints"}
    keyed = cut_lineage(with_plan_key(calcs.withColumnsRenamed(renamed)))
    plans = translate_plans(plan_sources(plan_units(keyed), catalog)).drop(
        "source_set", "formula", "hints"
    )
    named = with_slugs(keyed).join(plans, "plan_key", "left")
    schema = F.regexp_replace("base", r"\.[^.]*\z", "")
    path = F.lit(target_schema) if target_schema else schema
    comment = F.format_string(fixed.DEFINITION_COMMENT, "name", "calc_id", "original")
    built = (
        named.withColumn("view_name", F.concat_ws(".", path, F.concat(F.lit(prefix), "slug")))
        .withColumn("comment", comment)
        .withColumn(
            "definition",
            F.when(F.col("expr").isNotNull(), definition_yaml(include_source_fields)),
        )
        .withColumn("sql", F.when(F.col("definition").isNotNull(), _ddl()))
    )
    return built.select(
        "workbook_id", "ord", "name", "calc_id", "slug", "view_name", "kind", "status",
        F.lit("rule").alias("converted_by"),
        F.col("base").alias("source_table"), "joins", "colmap", "notes",
        F.col("original").alias("formula"), "expr", "eval_expr", "definition", "sql",
    )
