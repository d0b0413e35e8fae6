"""Benchmark decontamination: size-partitioned MinHash containment search, verified on exact shingle containment.

Items are partitioned by the power of two at or above their number of shingles, u. An item's sketch is the bottom-k
MinHash of its shingles, with k = floor((100 - percent) * u / 100) + 1 from its partition. A document that holds
``percent`` of an item's shingles lacks at most k - 1 of them, so it holds at least one of the sketch, however long
the document is: the candidates are complete, and no Jaccard bound that would shrink with the document is needed.
Candidates are then verified on the shared distinct shingles. Everything is DataFrame expressions, in one scan of the texts.

Shingles are compared by two 64-bit hashes of their words. Only items' own shingles travel: they are broadcast while
there are at most ``broadcast_rows`` (48 bytes each), otherwise document shingles are joined with them by shuffle.

Defined results: null and empty texts and items, and items of fewer words than the width, have no shingle and match
nothing; repeated rows of an id count once, as the union of their texts; null ids match nothing; empty tables give
an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vizquarry.llm import shingles
from vizquarry.session import cut_lineage


def shingled(rows: DataFrame, id_column: str, text: str, width: int, name: str) -> DataFrame:
    """``name``, h1, h2 for each shingle of each row, repeats included."""
    words = F.split(shingles.normalised(F.col(text)), " ")
    listed = rows.where(F.col(id_column).isNotNull()).select(F.col(id_column).alias(name), words.alias("words"))
    listed = listed.where(F.size("words") >= width)
    placed = listed.select(name, "words", F.explode(F.sequence(F.lit(1), F.size("words") - (width - 1))).alias("at"))
    part = F.slice("words", F.col("at"), width)
    return placed.select(name, F.xxhash64(part).alias("h1"), F.xxhash64(F.lit("second"), part).alias("h2"))


def item_sketches(items: DataFrame, width: int, percent: int, id_column: str = "item_id", text: str = "text") -> DataFrame:
    """item_id, h1, h2, n_shingles and whether the shingle is in the item's sketch."""
    own = shingled(items, id_column, text, width, "item_id").distinct()
    ranked = own.selectExpr(
        "*",
        "count(*) OVER (PARTITION BY item_id) AS n_shingles",
        "row_number() OVER (PARTITION BY item_id ORDER BY h1, h2) AS place",
    )
    upper = F.round(F.pow(F.lit(2.0), F.ceil(F.log2(F.col("n_shingles").cast("double"))))).cast("long")
    k = F.floor(upper * (100 - percent) / 100) + 1
    return ranked.select("item_id", "h1", "h2", "n_shingles", (F.col("place") <= k).alias("in_sketch"))


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    width: int = 5,
    percent: int = 80,
    id_column: str = "doc_id",
    text: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
    broadcast_rows: int = 1_000_000,
) -> DataFrame:
    """doc_id, item_id, n_shared, n_shingles: every pair in which the document holds enough of the item."""
    sketches = cut_lineage(item_sketches(items, width, percent, item_column, item_text))
    known = sketches.select("h1", "h2").distinct()
    met = shingled(docs, id_column, text, width, "doc_id")
    met = met.join(F.broadcast(known) if known.count() <= broadcast_rows else known, ["h1", "h2"]).distinct()
    hits = cut_lineage(met).join(sketches, ["h1", "h2"])
    counted = hits.groupBy("doc_id", "item_id").agg(
        F.count("*").alias("n_shared"), F.max("n_shingles").alias("n_shingles"), F.max("in_sketch").alias("candidate")
    )
    found = counted.where(F.col("candidate") & (100 * F.col("n_shared") >= percent * F.col("n_shingles")))
    return found.select("doc_id", "item_id", "n_shared", "n_shingles")


#: The same pairs by brute force.
CHECK = r"""
WITH words AS (
    SELECT 0 AS kind, doc_id AS id, text FROM documents WHERE doc_id IS NOT NULL
    UNION ALL SELECT 1, item_id, text FROM benchmark WHERE item_id IS NOT NULL
), cut AS (
    SELECT kind, id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
    FROM words
), placed AS (
    SELECT kind, id, w, unnest(range(1, len(w) - 3)) AS pos FROM cut WHERE len(w) >= 5
), shingle AS (
    SELECT DISTINCT kind, id, array_to_string(w[pos:pos + 4], ' ') AS s FROM placed
), item AS (
    SELECT id, s, count(*) OVER (PARTITION BY id) AS n FROM shingle WHERE kind = 1
)
SELECT d.id AS doc_id, i.id AS item_id, count(*) AS n_shared, max(i.n) AS n_shingles
FROM shingle d JOIN item i ON d.kind = 0 AND d.s = i.s
GROUP BY 1, 2 HAVING 100 * count(*) >= 80 * max(i.n)
"""
