"""Datasets behind dashboard widgets: profiles, single figures, breakdowns, series, rows, filter values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from vizquarry.functions.names import quoted

CATEGORY_LIMIT = 50


def _shape(t: T.DataType) -> str:
    if isinstance(t, T.NumericType):
        return "numeric"
    if isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "temporal"
    return "text" if isinstance(t, T.StringType) else "other"


def _text(c: Column, shape: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss") if shape == "temporal" else c.cast("string")


def profile_columns(df: DataFrame, table: str, distinct: str = "approx") -> DataFrame:
    """One row per column: type, shape, non-null and distinct counts, least and greatest value.

    A single aggregation reads every column once. Distinct counts are sketches unless ``exact`` is asked
    for; exact ones are counted column by column, each reading its own column only and shuffling its
    distinct values, instead of expanding every row by the number of columns.
    """
    aggregates, fields, counts = [], [], []
    for i, f in enumerate(df.schema):
        c, shape = F.col(quoted(f.name)), _shape(f.dataType)
        aggregates.append(F.count(c).alias(f"n{i}"))
        if distinct == "exact":
            counts.append(
                df.select(c.alias("v")).where("v IS NOT NULL").distinct()
                .agg(F.count(F.lit(1)).alias("distinct_count"))
                .select(F.lit(i + 1).alias("column_ord"), "distinct_count")
            )
            known = F.lit(None).cast("bigint")
        else:
            aggregates.append(F.approx_count_distinct(c).alias(f"d{i}"))
            known = F.col(f"d{i}")
        ordered = shape != "other"
        if ordered:
            aggregates += [F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}")]
        low = F.col(f"lo{i}") if ordered else F.lit(None)
        high = F.col(f"hi{i}") if ordered else F.lit(None)
        number = shape == "numeric"
        text = ordered and not number
        no_number, no_text = F.lit(None).cast("double"), F.lit(None).cast("string")
        fields.append(
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(i + 1).alias("column_ord"),
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("column_type"),
                F.lit(shape).alias("shape"),
                F.col(f"n{i}").alias("non_null_count"),
                known.alias("distinct_count"),
                (low.cast("double") if number else no_number).alias("min_number"),
                (high.cast("double") if number else no_number).alias("max_number"),
                (_text(low, shape) if text else no_text).alias("min_text"),
                (_text(high, shape) if text else no_text).alias("max_text"),
            )
        )
    profile = df.agg(*aggregates).select(F.inline(F.array(*fields)))
    if distinct != "exact":
        return profile
    exact = union_all(counts)
    columns = profile.columns
    return profile.drop("distinct_count").join(exact, "column_ord").select(columns)


def kpi(df: DataFrame, measures: dict[str, str]) -> DataFrame:
    """Single figures, one row."""
    return df.agg(*[F.expr(e).alias(n) for n, e in measures.items()])


def categories(df: DataFrame, category: str, measures: dict[str, str], by: str, k: int) -> DataFrame:
    """The ``k`` categories with the greatest ``by``; ties go to the lesser name."""
    grouped = df.groupBy(category).agg(*[F.expr(e).alias(n) for n, e in measures.items()])
    return grouped.orderBy(F.col(by).desc(), F.col(category)).limit(k)


def series(df: DataFrame, time: str, unit: str, measures: dict[str, str]) -> DataFrame:
    """Measures per time unit."""
    period = F.date_trunc(unit, time).cast("timestamp_ntz").alias("period")
    return df.groupBy(period).agg(*[F.expr(e).alias(n) for n, e in measures.items()])


def detail(df: DataFrame, columns: list[str], keys: list[str], n: int) -> DataFrame:
    """The first ``n`` rows by ``keys``: each task keeps its own first ``n``, then they are merged."""
    return df.select(*columns).orderBy(*keys).limit(n)


def filter_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, value): distinct values of each chosen column, in one pass over the table."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns]
    )
    return df.select(F.inline(pairs)).where(F.col("value").isNotNull()).distinct()


def empty_tables(manifest: DataFrame) -> DataFrame:
    """Tables that cannot be drawn, with the reason."""
    reason = F.when(F.col("column_count") == 0, F.lit("schema is empty")).when(
        F.col("row_count") == 0, F.lit("table has no rows")
    )
    return manifest.withColumn("reason", reason).where(F.col("reason").isNotNull())


def widget_plan(profile: DataFrame, category_limit: int = CATEGORY_LIMIT) -> DataFrame:
    """Which widget suits a column, and whether it should be a filter."""
    low = (F.col("shape") == "text") & (F.col("distinct_count") <= category_limit)
    return profile.select(
        "table_name",
        "column_name",
        F.when(F.col("shape") == "numeric", F.lit("kpi"))
        .when(low, F.lit("category"))
        .when(F.col("shape") == "temporal", F.lit("series"))
        .otherwise(F.lit("detail"))
        .alias("widget"),
        low.alias("is_filter"),
    )


def out_of_scope(used: DataFrame, listed: DataFrame) -> DataFrame:
    """Rows of ``used`` whose ``table_name`` is not among the listed tables."""
    return used.join(listed.select("table_name").distinct(), "table_name", "left_anti")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
