"""Table sinks."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from vizquarry.functions.names import quoted


def _register(spark: SparkSession, table: str, path: str) -> None:
    """Give a folder that holds rows already its table, so that an append adds to them."""
    try:
        schema = spark.read.parquet(path).schema
    except AnalysisException as why:
        if why.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return
    spark.catalog.createTable(table, path=path, source="parquet", schema=schema)


def _aligned(df: DataFrame, table: str) -> DataFrame:
    """The columns of ``table`` from ``df``; what the table lacks is added to its metadata first."""
    spark = df.sparkSession
    known = {f.name.lower(): f for f in spark.table(table).schema}
    for f in df.schema:
        old = known.get(f.name.lower())
        if old is not None and old.dataType != f.dataType:
            raise ValueError(
                f"{table}.{f.name} holds {old.dataType.simpleString()}, not {f.dataType.simpleString()}"
            )
    added = [f for f in df.schema if f.name.lower() not in known]
    if added:
        listed = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in added)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({listed})")
    have = {c.lower() for c in df.columns}
    return df.select(
        *[
            F.col(quoted(f.name)) if f.name.lower() in have else F.lit(None).cast(f.dataType).alias(f.name)
            for f in spark.table(table).schema
        ]
    )


def write_table(df: DataFrame, table: str, mode: str = "overwrite", path: str | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table, creating the schema, and return the table.

    An append may bring new columns and lack old ones. New columns are added to the table's metadata
    and earlier files read as null there, so no stored row is rewritten.
    """
    spark = df.sparkSession
    if mode not in ("overwrite", "append"):
        raise ValueError("mode must be 'overwrite' or 'append'")
    if "." in table:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {table.rsplit('.', 1)[0]}")
    writer = df.write.format("parquet")
    if path:
        writer = writer.option("path", path)
    if mode == "append" and path and not spark.catalog.tableExists(table):
        _register(spark, table, path)
    if mode == "overwrite" or not spark.catalog.tableExists(table):
        writer.mode(mode).saveAsTable(table)
        return spark.table(table)

    aligned = _aligned(df, table)
    aligned.write.mode("append").insertInto(table)
    return spark.table(table)


def write_batch(df: DataFrame, table: str, batch: str, path: str | None = None, column: str = "batch_id") -> DataFrame:
    """Put a batch of rows into ``table``, in place of what the same batch left before, and return the table.

    Each batch is a partition. It is written beside the table and moved into its place when all its files are there, so a
    write that is repeated or broken off leaves the rows of every batch once. New columns are added as in ``write_table``.
    """
    spark = df.sparkSession
    if column.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"{column} names the batch")
    rows = df.withColumn(column, F.lit(batch))
    if "." in table:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {table.rsplit('.', 1)[0]}")
    if not spark.catalog.tableExists(table):
        # The table keeps the option: only partitions that a write holds rows for are replaced, after they are staged.
        writer = rows.limit(0).write.format("parquet").option("partitionOverwriteMode", "dynamic").partitionBy(column)
        (writer.option("path", path) if path else writer).mode("ignore").saveAsTable(table)
    if df.isEmpty():  # an empty batch replaces an older one as well
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({quoted(column)} = '{_escaped(batch)}') PURGE")
        return spark.table(table)
    _aligned(rows, table).write.insertInto(table, overwrite=True)
    return spark.table(table)


def _escaped(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")
