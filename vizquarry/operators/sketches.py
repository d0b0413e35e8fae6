"""Stored sketch states that merge: distinct counts and quantiles of a table that grows, without reading it again.

A batch of rows leaves one state for each column and period: counts, a HyperLogLog sketch of the values and, for numbers, a KLL
sketch of their order. Sketches of disjoint rows merge into the sketch of them all, so a dashboard merges states of any batches
and periods. A batch that is added again replaces what it left before.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from vizquarry.functions.names import quoted

#: Registers of a distinct count (2 ** LOG_REGISTERS) and size of a quantile sketch.
LOG_REGISTERS, ORDER_SIZE = 14, 400
#: Three standard errors of a distinct count, and the rank error of a quantile at over 99 %.
DISTINCT_ERROR, RANK_ERROR = 3 * 1.04 / 2 ** (LOG_REGISTERS / 2), 0.02
STATE = (
    "column_name string, period string, row_count long, non_null_count long, distinct_state binary, order_state binary"
)


def states(df: DataFrame, period: Column) -> DataFrame:
    """A row for each column and period, from one aggregation over the rows."""
    aggregates, cells = [F.count(F.lit(1)).alias("n")], []
    for i, f in enumerate(df.schema):
        c = F.col(quoted(f.name))
        plain = isinstance(f.dataType, (T.IntegerType, T.LongType, T.StringType, T.BinaryType))
        text = c if plain else F.to_json(c) if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)) else c.cast("string")
        aggregates += [F.count(c).alias(f"c{i}"), F.hll_sketch_agg(text, LOG_REGISTERS).alias(f"d{i}")]
        order = F.lit(None).cast("binary")
        if isinstance(f.dataType, T.NumericType):
            number = F.when(~F.isnan(c.cast("double")), c.cast("double"))
            aggregates.append(F.kll_sketch_agg_double(number, ORDER_SIZE).alias(f"o{i}"))
            order = F.col(f"o{i}")
        cells.append(
            F.struct(
                F.lit(f.name).alias("column_name"), F.col("period"), F.col("n").alias("row_count"),
                F.col(f"c{i}").alias("non_null_count"), F.col(f"d{i}").alias("distinct_state"), order.alias("order_state"),
            )
        )
    grouped = df.groupBy(period.cast("string").alias("period")).agg(*aggregates)
    return grouped.select(F.inline(F.array(*cells)))


class SketchStore:
    """States below ``path``, in a folder for each table and batch."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def add(self, df: DataFrame, table: str, batch: str, period: Column) -> None:
        """Keep the states of a batch; the same batch again replaces them."""
        states(df, period).write.mode("overwrite").parquet(os.path.join(self.path, f"table_name={table}", f"batch={batch}"))

    def all(self) -> DataFrame:
        return self.spark.read.schema(STATE + ", table_name string, batch string").option("basePath", self.path).parquet(self.path)

    def merged(self, by: tuple[str, ...] = (), shares: tuple[float, ...] = (0.5,)) -> DataFrame:
        """table_name, column_name, the columns ``by`` (period, batch), counts, distinct_count, and quantiles at the shares (null for texts)."""
        keys = ["table_name", "column_name", *by]
        grouped = self.all().groupBy(*keys).agg(
            F.sum("row_count").alias("row_count"),
            F.sum("non_null_count").alias("non_null_count"),
            F.hll_union_agg("distinct_state").alias("distinct_state"),
            F.kll_merge_agg_double("order_state", ORDER_SIZE).alias("order_state"),
        )
        some = F.kll_sketch_get_n_double("order_state") > 0
        quantiles = F.when(some, F.kll_sketch_get_quantile_double("order_state", F.array(*[F.lit(float(s)) for s in shares])))
        return grouped.select(
            *keys, "row_count", "non_null_count", F.hll_sketch_estimate("distinct_state").alias("distinct_count"), quantiles.alias("quantiles")
        )
