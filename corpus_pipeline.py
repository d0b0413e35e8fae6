"""From raw documents to a token file: five stages, each over all that the one before kept.

Defined results: rows without a doc_id can't be named by any decision and go with the first stage; rows of one doc_id
are one document: they stay if one of them passes the rules, and the near-duplicate stage leaves the one of the smallest text; extra
columns are carried through the filtering stages as they are; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from vizquarry.llm import decontaminate, mixing, near_dedup, quality_rules, registry, token_file
from vizquarry.session import cut_lineage

#: Share of the tokens that the mixing stage takes.
MIX_SHARE = 0.6


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that the quality rules keep."""
    registry.ship(spark)
    kept = quality_rules.quality_rules(docs).where("kept").select("doc_id")
    return docs.join(kept, "doc_id", "left_semi")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest doc_id of each group of near duplicates (five-word shingles, Jaccard 0.8 or more)."""
    registry.ship(spark)
    kept = near_dedup.near_duplicates(docs).where("kept").select("doc_id")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    found = docs.join(kept, "doc_id", "left_semi").groupBy("doc_id").agg(F.min_by(row, F.coalesce("text", F.lit(""))).alias("row"))
    return found.select("row.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold 80 % or more of a benchmark item's five-word shingles."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.contaminated(docs, items).select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take documents by the weights of their domain, language and source."""
    return mixing.corpus_documents(docs, MIX_SHARE)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write every document's token ids and return one row per document from the stored bits."""
    registry.ship(spark)
    path = registry.fresh(spark, "tokens")
    token_file.write_token_file(docs, registry.tokenizer_path(), path)
    return token_file.read_token_file(spark, path)


STAGES = [
    ("quality rules", drop_low_quality),
    ("MinHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources to target weights", mix_sources),
    ("token-ID / binary output", token_output),
]

#: The last stage's ids come from a tokenizer library, which SQL hasn't; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written and read again before the next."""
    docs = registry.table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
