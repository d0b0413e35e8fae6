"""Nesting depth of calculated fields: the longest chain of references that never repeats a field."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vizquarry.functions.formulas import raw_refs
from vizquarry.operators.graphs import path_lengths
from vizquarry.session import cut_lineage


def reference_edges(calcs: DataFrame) -> DataFrame:
    """(workbook_id, src, dst): references from one calculated field to another of the workbook."""
    return _edges(calcs.select("workbook_id", "calc_name", raw_refs("formula").alias("refs")))


def _edges(calcs: DataFrame) -> DataFrame:
    refs = calcs.select("workbook_id", F.col("calc_name").alias("src"), F.explode("refs").alias("dst"))
    refs = refs.where(F.col("src") != F.col("dst"))
    targets = calcs.select("workbook_id", F.col("calc_name").alias("dst"))
    return refs.join(targets, ["workbook_id", "dst"], "left_semi").select("workbook_id", "src", "dst")


def nesting_depth(calcs: DataFrame) -> DataFrame:
    """(workbook_id, max_calc_nesting_depth) for every workbook with a calculated field.

    All workbooks go through the same rounds, log2(depth) of them where there is no cycle. Fields that reach a cycle
    are searched path by path inside their component only. ``calcs`` that hold ``refs`` are stored already.
    """
    # Read as sources, as targets and alone: formulas are made and searched once.
    if "refs" not in calcs.columns:
        calcs = cut_lineage(calcs.select("workbook_id", "calc_name", raw_refs("formula").alias("refs")))
    alone = calcs.select("workbook_id", F.lit(1).alias("depth"))
    deep = path_lengths(_edges(calcs), ["workbook_id"]).select("workbook_id", F.col("value").alias("depth"))
    return (
        alone.unionByName(deep)
        .groupBy("workbook_id")
        .agg(F.max("depth").cast("int").alias("max_calc_nesting_depth"))
    )
