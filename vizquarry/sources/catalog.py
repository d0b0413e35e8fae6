"""Candidate source tables and their columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vizquarry import fixed
from vizquarry.functions.names import norm, short_name

CATALOG_COLUMNS = (
    "source_set string, table_ord int, table_name string, column_ord int, column_name string,"
    " column_type string"
)


def column_catalog(spark: SparkSession, tables: dict[str, DataFrame], source_set: str = "all") -> DataFrame:
    """One row per column of the listed tables, in list order. Reads schemas only."""
    rows = [
        (source_set, t, name, c, f.name, f.dataType.simpleString())
        for t, (name, df) in enumerate(tables.items(), 1)
        for c, f in enumerate(df.schema, 1)
    ]
    return with_norm(spark.createDataFrame(rows, CATALOG_COLUMNS))


def session_catalog(spark: SparkSession, names: list[str], source_set: str = "all") -> DataFrame:
    """The same for tables known to the session catalog."""
    return column_catalog(spark, {n: spark.table(n) for n in names}, source_set)


def with_norm(catalog: DataFrame) -> DataFrame:
    return catalog.withColumn("norm_name", norm("column_name"))


def _entries(c: Column) -> Column:
    text = F.trim(c)
    listed = F.when(text.startswith("["), F.from_json(text, "array<string>")).otherwise(F.split(text, ","))
    return F.transform(listed, lambda e: F.replace(F.trim(e), F.lit("`"), F.lit("")))


def resolve_sources(requests: DataFrame, listing: DataFrame, prefix: str = fixed.VIEW_PREFIX) -> DataFrame:
    """Table lists to candidate tables, first mention first.

    ``requests`` holds (request_id, source_tables): a comma list or JSON array. ``listing`` holds
    (schema_name, table_name, table_type, listing_ord) of the catalog. Two-part names stand for all
    tables of that schema but views and names with ``prefix``. Anything else comes out as an error row.
    """
    entries = requests.select(
        "request_id", F.posexplode(_entries(F.col("source_tables"))).alias("entry_ord", "entry")
    ).where(F.col("entry") != "")
    n_parts = F.size(F.split("entry", r"\."))
    none = F.lit(None).cast("string")
    exact = entries.where(n_parts == 3).select(
        "request_id", "entry_ord", F.lit(0).alias("listing_ord"), F.col("entry").alias("table_name"),
        none.alias("error"),
    )
    usable = listing.where(
        ~F.upper("table_type").contains("VIEW") & ~short_name("table_name").startswith(prefix)
    )
    expanded = (
        entries.where(n_parts == 2)
        .join(usable, F.col("entry") == F.col("schema_name"))
        .select("request_id", "entry_ord", "listing_ord", "table_name", none.alias("error"))
    )
    wrong = entries.where(~n_parts.isin(2, 3)).select(
        "request_id", "entry_ord", F.lit(0).alias("listing_ord"), none.alias("table_name"),
        F.format_string("Expected catalog.schema.table or catalog.schema, got '%s'", "entry").alias("error"),
    )
    return (
        exact.unionByName(expanded)
        .unionByName(wrong)
        .groupBy("request_id", "table_name", "error")
        .agg(F.min(F.struct("entry_ord", "listing_ord")).alias("first"))
        .select("request_id", "first.entry_ord", "first.listing_ord", "table_name", "error")
    )
