"""Token counts through a digest cache.

A count is stored under two digests: that of the content and that of the tokenizer's version. Contents without a
stored count are reduced to distinct ones, encoded, and appended to the cache; every row then gets its count by a
join on the content's digest.

Defined results: a null text counts as an empty one (0 bytes, 0 tokens); repeated rows and equal texts get equal
counts, one row out for each row in; an empty table gives an empty result; other columns are not read and may have
any name; texts of any length are encoded whole.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vizquarry.llm import pieces

CACHE_SCHEMA = "digest binary, n_tokens long"


def normalised(text: Column) -> Column:
    """The content that is counted. Anything beyond null handling could change the count."""
    return F.coalesce(text.cast("string"), F.lit(""))


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def read_cache(spark: SparkSession, cache: str, version: str) -> DataFrame | None:
    """Stored counts of one tokenizer version; digests that two jobs appended at once appear once."""
    try:
        stored = spark.read.schema(CACHE_SCHEMA).parquet(f"{cache}/version={version}")
    except AnalysisException as why:
        if why.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return stored.groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))


def _counted(path: str):
    def run(batches):
        import pyarrow as pa

        encoder = pieces.encoder(path)
        for batch in batches:
            found = [encoder.count(x.as_py()) for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(found, pa.int64())], ["digest", "n_tokens"])

    return run


def fill_cache(docs: DataFrame, tokenizer: str, cache: str, text: str = "text") -> str:
    """Encode the distinct contents that the cache lacks and append their counts; returns the version."""
    spark, version = docs.sparkSession, pieces.tokenizer_version(tokenizer)
    texts = docs.select(normalised(F.col(text)).alias("text")).select(digest(F.col("text")).alias("digest"), "text")
    stored = read_cache(spark, cache, version)
    if stored is not None:
        texts = texts.join(stored, "digest", "left_anti")
    misses = texts.groupBy("digest").agg(F.first("text").alias("text"))
    counted = misses.mapInArrow(_counted(tokenizer), CACHE_SCHEMA)
    counted.write.mode("append").parquet(f"{cache}/version={version}")
    return version


def count_tokens(
    docs: DataFrame, tokenizer: str, cache: str, id_column: str = "doc_id", text: str = "text", limit: int = 1024
) -> DataFrame:
    """id, n_bytes, n_tokens and over_limit of every row; ``cache`` is a folder that all executors share."""
    version = fill_cache(docs, tokenizer, cache, text)
    rows = docs.select(F.col(id_column), normalised(F.col(text)).alias("_text")).select(
        id_column, F.octet_length("_text").cast("long").alias("n_bytes"), digest(F.col("_text")).alias("digest")
    )
    counts = read_cache(docs.sparkSession, cache, version)
    return rows.join(counts, "digest", "left").select(
        id_column, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
