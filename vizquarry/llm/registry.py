"""The queries of the training-data operators, each over its whole table."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from vizquarry.llm import clusters, decontaminate, html_text, language, mixing, near_dedup, negatives, quality_model, quality_rules, repeats, token_counts, token_file, toxicity
from vizquarry.session import scratch_dir, ship_package


#: The mix of the query: tokens taken, as a share of all, and how often a document may be taken.
MIX_SHARE, MIX_EPOCHS = 0.5, 3


def ship(spark: SparkSession) -> None:
    """Python workers need this package."""
    ship_package(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(spark: SparkSession, what: str) -> str:
    """A folder of this call's own below the shared one."""
    return os.path.join(scratch_dir(spark), f"{what}-{uuid.uuid4().hex}")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_counts.count_tokens(docs, tokenizer_path(), fresh(spark, "token-cache"))


def op4_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh(spark, "tokens")
    token_file.write_token_file(table(spark, sf_dir, "documents"), tokenizer_path(), path)
    return token_file.read_token_file(spark, path)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


def op6_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85)


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(table(spark, sf_dir, "pages"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.corpus_rows(table(spark, sf_dir, "documents"), MIX_SHARE, MIX_EPOCHS)


def op11_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, label=label)


def op13_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.cluster(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_toxicity": op2_toxicity,
    "op3_token_counts": op3_token_counts,
    "op4_token_file": op4_token_file,
    "op5_quality_rules": op5_quality_rules,
    "op6_quality_model": op6_quality_model,
    "op7_decontamination": op7_decontamination,
    "op8_near_dedup": op8_near_dedup,
    "op9_html_text": op9_html_text,
    "op10_mixing": op10_mixing,
    "op11_repeats": op11_repeats,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_clusters": op13_clusters,
}

#: Queries that SQL can express.
CHECKS: dict[str, str] = {
    "op7_decontamination": decontaminate.CHECK,
    "op10_mixing": mixing.check(MIX_SHARE, MIX_EPOCHS),
    "op11_repeats": repeats.CHECK,
    "op12_hard_negatives": negatives.CHECK,
    "op13_clusters": clusters.check(),
}
