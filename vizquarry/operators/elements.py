"""Workbook facts as filters over element rows.

``strict`` looks at the workbook's own data sources only; ``broad`` also takes the source stanzas that
every worksheet repeats.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vizquarry import fixed
from vizquarry.functions.names import blank_to_null, strip_brackets

VARIANTS = ("strict", "broad")
SOURCE_PATH = "datasources/datasource"


def ends_with(path: Column, steps: str) -> Column:
    return (path == steps) | path.endswith("/" + steps)


def at(steps: str, variant: str) -> Column:
    """The row stands at ``steps`` below the root (strict) or anywhere (broad)."""
    path = F.col("path")
    return path == steps if variant == "strict" else ends_with(path, steps)


def scopes_at(steps: str) -> Column:
    return F.filter("scopes", lambda s: ends_with(s["path"], steps))


def last_scope() -> Column:
    return F.get("scopes", F.size("scopes") - 1)


def is_parameters(name: Column) -> Column:
    return F.coalesce(name == fixed.PARAMETER_SOURCE, F.lit(False))


def calc_fields(elements: DataFrame, variant: str = "strict") -> DataFrame:
    """(workbook_id, calc_name, formula, ord): one row per name, the last formula, the first position."""
    formula = F.col("attrs")["formula"]
    return (
        elements.where(F.col("tag") == "calculation")
        .where(at(SOURCE_PATH + "/column/calculation", variant))
        .where((F.col("tag_ord") == 1) & (formula != ""))
        .where(~is_parameters(last_scope()["name"]))
        .select(
            "workbook_id",
            strip_brackets(F.coalesce(F.col("parent_attrs")["name"], F.lit(""))).alias("calc_name"),
            formula.alias("formula"),
            "elem_id",
        )
        .groupBy("workbook_id", "calc_name")
        .agg(F.max_by("formula", "elem_id").alias("formula"), F.min("elem_id").alias("ord"))
    )


def calc_records(elements: DataFrame) -> DataFrame:
    """One row per calculation and enclosing data source, for the semantic layer."""
    attrs, column = F.col("attrs"), F.col("parent_attrs")
    sources = F.filter(
        "scopes", lambda s: (s["tag"] == "datasource") & ~is_parameters(s["name"])
    )
    calc_id = strip_brackets(F.coalesce(column["name"], F.lit("")))
    return (
        elements.where(F.col("tag") == "calculation")
        .where(ends_with(F.col("path"), "column/calculation") & (F.col("tag_ord") == 1))
        .where((attrs["class"] == fixed.CALCULATION_CLASS) & (attrs["formula"] != ""))
        .withColumn("_source", F.explode(sources))
        .select(
            "workbook_id",
            F.col("_source.elem_id").alias("source_ord"),
            F.col("parent_id").alias("calc_ord"),
            F.coalesce(
                blank_to_null("_source.caption"), blank_to_null("_source.name"), F.lit("")
            ).alias("datasource"),
            calc_id.alias("calc_id"),
            F.coalesce(blank_to_null(column["caption"]), calc_id).alias("name"),
            attrs["formula"].alias("formula"),
            column["datatype"].alias("datatype"),
            column["role"].alias("tableau_role"),
        )
    )


def parameters(elements: DataFrame, variant: str = "strict") -> DataFrame:
    """Distinct (workbook_id, parameter_name)."""
    attrs = F.col("attrs")
    return (
        elements.where(F.col("tag") == "column")
        .where(at(SOURCE_PATH + "/column", variant))
        .where(is_parameters(last_scope()["name"]))
        .select(
            "workbook_id",
            strip_brackets(
                F.coalesce(blank_to_null(attrs["caption"]), attrs["name"], F.lit(""))
            ).alias("parameter_name"),
        )
        .distinct()
    )


def parameter_actions(elements: DataFrame) -> DataFrame:
    """(workbook_id, target) of every action whose first child changes a parameter."""
    target = strip_brackets(F.coalesce(F.col("attrs")["parameter"], F.lit("")))
    return (
        elements.where((F.col("tag") == "parameter") & (F.col("sib_ord") == 1))
        .where(ends_with(F.col("path"), "actions/action/parameter"))
        .select("workbook_id", target.alias("target"))
        .where(F.col("target") != "")
    )
