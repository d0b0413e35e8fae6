"""Table ingest: open formats in, clean typed tables out."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from vizquarry.functions.names import quoted, sanitize


@dataclass
class TableSource:
    """One extract table as files. ``temporal`` maps columns to ``date`` or ``timestamp``."""

    name: str
    path: str
    format: str = "parquet"
    schema: str | T.StructType | None = None
    options: dict = field(default_factory=dict)
    temporal: dict = field(default_factory=dict)


def read_source(spark: SparkSession, source: TableSource) -> DataFrame:
    """All rows of one source table, lazily."""
    reader = spark.read.format(source.format).options(**source.options)
    if source.schema is not None:
        reader = reader.schema(source.schema)
    elif source.format not in ("parquet", "orc"):
        raise ValueError(f"{source.name}: {source.format} files need an explicit schema")
    return normalize_temporal(reader.load(source.path), source.temporal)


def normalize_temporal(df: DataFrame, temporal: dict) -> DataFrame:
    """Dates to DATE, timestamps to zone-free timestamps with microseconds."""
    targets = {"date": "date", "timestamp": "timestamp_ntz"}
    return df.withColumns({c: F.col(quoted(c)).cast(targets[kind]) for c, kind in temporal.items()})


def unique_names(columns: DataFrame, table: str, ordinal: str, name: str) -> DataFrame:
    """Adds ``clean_name``: sanitized, and unique within its table.

    The first column of a name keeps it. Every further one takes the next number whose result is not
    the sanitized name of another column of the table. The frame holds column metadata, one row per
    column, so a window per (table, name) sees a table's width at most.
    """
    base = columns.withColumn("_base", sanitize(name))
    within = Window.partitionBy(table, "_base").orderBy(ordinal)
    # Numbers already taken for base `a` are the k of sanitized names `a_k`.
    parts = F.regexp_extract("_base", r"^(.*)_([1-9][0-9]{0,8})$", 1)
    number = F.regexp_extract("_base", r"^(.*)_([1-9][0-9]{0,8})$", 2)
    taken = (
        base.where(parts != "")
        .select(F.col(table), parts.alias("_base"), number.cast("int").alias("_k"))
        .groupBy(table, "_base")
        .agg(F.collect_set("_k").alias("_taken"))
    )
    repeat = F.row_number().over(within) - 1
    ranked = base.withColumn("_repeat", repeat).join(taken, [table, "_base"], "left")
    none = F.array().cast("array<int>")
    free = F.array_except(
        F.sequence(F.lit(1), F.col("_repeat") + F.size(F.coalesce("_taken", none))),
        F.coalesce("_taken", none),
    )
    numbered = F.concat("_base", F.lit("_"), F.get(free, F.col("_repeat") - 1).cast("string"))
    return ranked.withColumn(
        "clean_name", F.when(F.col("_repeat") == 0, F.col("_base")).otherwise(numbered)
    ).drop("_base", "_repeat", "_taken")


def clean_columns(df: DataFrame) -> DataFrame:
    """Rename every column to its clean name; column metadata is the only thing brought to the driver."""
    spark = df.sparkSession
    listed = spark.createDataFrame(list(enumerate(df.columns)), "ord int, name string")
    rows = (
        unique_names(listed.withColumn("tbl", F.lit(0)), "tbl", "ord", "name")
        .select("ord", "clean_name")
        .collect()
    )
    names = dict(rows)
    return df.toDF(*[names[i] for i in range(len(df.columns))])


def manifest(tables: dict[str, DataFrame], catalog: str, schema: str) -> DataFrame:
    """Full table name, row count and column count of every loaded table, in one job."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(f"{catalog}.{schema}.{name}").alias("table_name"),
            "row_count",
            F.lit(len(df.columns)).cast("bigint").alias("column_count"),
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)
