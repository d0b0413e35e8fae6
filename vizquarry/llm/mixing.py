"""Mixing sources to target weights by hierarchical budgeting.

Documents are leaves of a tree of levels, such as domain, language, source. A node's budget is its parent's times its
share of its siblings' weights; what a node can't fill (its texts times the allowed epochs) goes to its siblings in
proportion to their weights, and only what all of them together can't fill goes to the parent's siblings. Since a
node's capacity is the sum of its leaves', one pass from the top settles this: at each level the children of a node
fill up like connected vessels.

A leaf's budget is spent in epochs: whole ones first, then the prefix, in the seeded order of the next epoch, that
reaches what is left. The prefix of a leaf is found in two steps, so that no task sorts a leaf: token sums per range
of the order, then the order within the one range in which the budget ends.

Everything is DataFrame expressions. Leaves and ranges are small tables; leaf tables are broadcast while they have at
most ``broadcast_leaves`` rows (some 200 bytes each) and joined by shuffle beyond.

Defined results: tokens are runs of characters other than ASCII white space; a null text has none; null level
values are a node of their own, named ``(none)``; a node without a given weight weighs 1, one with weight 0 gets
nothing; documents without tokens are taken with the prefix they stand in; rows of the same id have the same place in
the order and are taken or left together; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vizquarry.session import cut_lineage

NONE = "(none)"
TOKEN = r"[^\x20\x09-\x0D]+"
BROADCAST_LEAVES = 100_000


def token_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(TOKEN)), F.lit(0)).cast("long")


def place(seed: int, epoch: Column, id_column: str) -> Column:
    """A row's place in the order of an epoch: hex digits, the same on any engine."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.col(id_column).cast("string")).cast("binary"))


def small(table: DataFrame, limit: int) -> DataFrame:
    """Broadcast a table only if it is known to be small."""
    return F.broadcast(table) if table.count() <= limit else table


def weight_table(spark: SparkSession, weights: Mapping[Sequence[str], float], depth: int) -> DataFrame:
    """The given weights of the nodes of one depth: path, weight."""
    rows = [(list(path), float(w)) for path, w in weights.items() if len(path) == depth]
    return spark.createDataFrame(rows, "path array<string>, weight double")


def budgets(leaves: DataFrame, levels: Sequence[str], weights: Mapping[Sequence[str], float], total: Column, epochs: int) -> DataFrame:
    """``budget`` of every leaf (levels, supply): top-down, at each level filled up to capacity."""
    spark = leaves.sparkSession
    whole = leaves.agg(F.coalesce(F.sum("supply"), F.lit(0)).alias("whole")).select(total.alias("budget"))
    found = whole.withColumn("path", F.array().cast("array<string>"))
    tree = leaves.select(F.array(*levels).alias("leaf"), (F.col("supply") * epochs).cast("double").alias("capacity"))
    for depth in range(1, len(levels) + 1):
        nodes = tree.groupBy(F.slice("leaf", 1, depth).alias("path")).agg(F.sum("capacity").alias("capacity"))
        nodes = nodes.join(weight_table(spark, weights, depth), "path", "left")
        nodes = nodes.select("path", "capacity", F.coalesce("weight", F.lit(1.0)).alias("weight"), F.slice("path", 1, depth - 1).alias("parent"))
        above = found.select(F.col("path").alias("parent"), F.col("budget").cast("double").alias("above"))
        nodes = nodes.where("weight > 0").join(above, "parent")
        # In order of capacity per weight, a child is full if the water above those before it would cover it.
        nodes = nodes.selectExpr(
            "*",
            "sum(capacity) OVER (PARTITION BY parent ORDER BY capacity / weight, path ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - capacity AS before",
            "sum(weight) OVER (PARTITION BY parent ORDER BY capacity / weight DESC, path DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS still",
        ).withColumn("full", F.expr("capacity * still <= weight * (above - before)"))
        nodes = nodes.selectExpr(
            "*",
            "sum(CASE WHEN full THEN capacity ELSE 0D END) OVER (PARTITION BY parent) AS taken",
            "sum(CASE WHEN full THEN 0D ELSE weight END) OVER (PARTITION BY parent) AS open",
        )
        found = nodes.selectExpr("path", "CASE WHEN full THEN capacity ELSE greatest(0D, above - taken) * weight / open END AS budget")
    return found.select(*[F.col("path")[k].alias(x) for k, x in enumerate(levels)], F.floor(F.col("budget") + 1e-6).alias("budget"))


def plan(
    docs: DataFrame,
    levels: Sequence[str],
    weights: Mapping[Sequence[str], float],
    share: float,
    epochs: int = 1,
    seed: int = 0,
    id_column: str = "doc_id",
    tokens: str = "n_tokens",
) -> DataFrame:
    """Per leaf: supply, budget, ``whole`` epochs taken completely, and the last place taken of the epoch after.

    ``docs`` needs the id, the levels and the tokens only. The budget is ``share`` of all tokens.
    """
    docs = docs.select(F.col(id_column), *levels, F.col(tokens).alias("tokens"))
    leaves = docs.groupBy(*levels).agg(F.sum("tokens").alias("supply"), F.count("*").alias("rows"))
    leaves = cut_lineage(leaves)
    total = F.col("whole") * share
    spent = leaves.join(budgets(leaves, levels, weights, total, epochs), list(levels))
    spent = spent.selectExpr("*", "CASE WHEN supply > 0 THEN CAST(floor(budget / supply) AS INT) ELSE 0 END AS whole")
    spent = spent.selectExpr("*", "budget - whole * supply AS rest")
    # As many ranges as there are rows in one: the square root of a leaf's rows, by leading hex digits.
    digits = F.ceil(F.log(16.0, F.greatest(F.lit(1.0), F.sqrt("rows")))).cast("int")
    spent = cut_lineage(spent.withColumn("digits", digits))
    partial = small(spent.where("rest > 0").select(*levels, "whole", "rest", "digits"), BROADCAST_LEAVES)
    placed = docs.join(partial, list(levels)).withColumn("place", place(seed, F.col("whole"), id_column))
    placed = placed.withColumn("range", F.expr("substr(place, 1, digits)"))
    sums = placed.groupBy(*levels, "range").agg(F.sum("tokens").alias("tokens"), F.max("rest").alias("rest"))
    keys = ", ".join(levels)
    ends = sums.selectExpr("*", f"sum(tokens) OVER (PARTITION BY {keys} ORDER BY range) - tokens AS before")
    # The last range that begins before the budget is reached holds the cut.
    ends = ends.where("before < rest").groupBy(*levels).agg(F.max(F.struct("range", "before")).alias("end"))
    ends = small(cut_lineage(ends.select(*levels, F.col("end.range").alias("range"), "end.before")), BROADCAST_LEAVES)
    inside = placed.join(ends, [*levels, "range"]).groupBy(*levels, "place").agg(
        F.sum("tokens").alias("tokens"), F.max("before").alias("before"), F.max("rest").alias("rest")
    )
    inside = inside.selectExpr("*", f"before + sum(tokens) OVER (PARTITION BY {keys} ORDER BY place) - tokens AS start")
    cuts = inside.where("start < rest").groupBy(*levels).agg(F.max("place").alias("last"))
    return cut_lineage(spent.join(cuts, list(levels), "left").select(*levels, "supply", "budget", "whole", F.coalesce("last", F.lit("")).alias("last")))


def taken(docs: DataFrame, leaves: DataFrame, levels: Sequence[str], seed: int = 0, id_column: str = "doc_id") -> DataFrame:
    """``docs`` with ``_mix_copies``, the epochs each row is taken in; rows that aren't taken go. No row is moved."""
    plans = leaves.select(*levels, F.col("whole").alias("_mix_whole"), F.col("last").alias("_mix_last"))
    marked = docs.join(small(plans, BROADCAST_LEAVES), list(levels))
    whole = F.col("_mix_whole")
    copies = whole + (place(seed, whole, id_column) <= F.col("_mix_last")).cast("int")
    return marked.withColumn("_mix_copies", copies).where("_mix_copies > 0").drop("_mix_whole", "_mix_last")


def with_levels(docs: DataFrame, levels: Mapping[str, Column]) -> DataFrame:
    return docs.withColumns({name: F.coalesce(c.cast("string"), F.lit(NONE)) for name, c in levels.items()})


# What the query and the pipeline mix: domains by the last digit of a source's name, then languages, then sources.
LEVELS = ("_mix_domain", "_mix_lang", "_mix_source")
WEIGHTS = {("d0",): 4.0, ("d1",): 3.0, ("d2",): 2.0, ("d3",): 1.0, **{(f"d{k}", "en"): 2.0 for k in range(4)}}
SEED = 17


def corpus_levels() -> dict[str, Column]:
    digit = F.regexp_extract(F.coalesce(F.col("source"), F.lit("")), r"([0-9])$", 1).try_cast("int")
    domain = F.concat(F.lit("d"), (F.coalesce(digit, F.lit(0)) % 4).cast("string"))
    return dict(zip(LEVELS, (domain, F.col("lang"), F.col("source"))))


def mix_corpus(docs: DataFrame, share: float, epochs: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The documents with their levels, the same without texts but with tokens, and the plan of the leaves."""
    marked = with_levels(docs, corpus_levels())
    sizes = cut_lineage(marked.select("doc_id", *LEVELS, token_count("text").alias("n_tokens")))
    return marked, sizes, plan(sizes, LEVELS, WEIGHTS, share, epochs, SEED)


def corpus_rows(docs: DataFrame, share: float, epochs: int) -> DataFrame:
    """doc_id, domain, lang, source, n_tokens and copies of every document that is taken."""
    _, sizes, leaves = mix_corpus(docs, share, epochs)
    names = dict(zip(LEVELS, ("domain", "lang", "source")))
    found = taken(sizes, leaves, LEVELS, SEED).withColumnsRenamed(names | {"_mix_copies": "copies"})
    return found.select("doc_id", "domain", "lang", "source", "n_tokens", "copies")


def corpus_documents(docs: DataFrame, share: float) -> DataFrame:
    """The documents that a mix of one epoch takes, with their own columns, whatever their names."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_mix_row")
    marked, _, leaves = mix_corpus(docs.select("doc_id", "text", "lang", "source", row), share, 1)
    return taken(marked, leaves, LEVELS, SEED).select("_mix_row.*")


def _level_check(depth: int) -> str:
    """SQL of one level of budgets: node<depth> from node<depth - 1>."""
    own, above = ", ".join("abc"[:depth]), ", ".join("abc"[: depth - 1]) or "1"
    weight = (
        "CASE a WHEN 'd0' THEN 4 WHEN 'd1' THEN 3 WHEN 'd2' THEN 2 WHEN 'd3' THEN 1 ELSE 1 END",
        "CASE b WHEN 'en' THEN 2 ELSE 1 END",
        "1",
    )[depth - 1]
    start = f"SELECT *, sum(cap) OVER w - cap AS bef, sum(wt) OVER v AS still FROM raw{depth} WINDOW w AS (PARTITION BY {above} ORDER BY cap / wt, {own} ROWS UNBOUNDED PRECEDING), v AS (PARTITION BY {above} ORDER BY cap / wt, {own} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    from_above = "(SELECT sum(supply) * SHARE AS budget FROM leaf) u" if depth == 1 else f"node{depth - 1} u"
    using = "ON true" if depth == 1 else f"USING ({above})"
    return f"""
raw{depth} AS (SELECT {own}, sum(supply) * CAST(EPOCHS AS DOUBLE) AS cap, CAST({weight} AS DOUBLE) AS wt, any_value(budget) AS above
    FROM leaf JOIN {from_above} {using} GROUP BY {own}),
start{depth} AS ({start}),
full{depth} AS (SELECT *, cap * still <= wt * (above - bef) AS f FROM start{depth}),
node{depth} AS (SELECT {own}, CASE WHEN f THEN cap ELSE greatest(0, above - sum(CASE WHEN f THEN cap ELSE 0 END) OVER w)
    * wt / sum(CASE WHEN f THEN 0 ELSE wt END) OVER w END AS budget FROM full{depth} WINDOW w AS (PARTITION BY {above}))"""


def check(share: float, epochs: int) -> str:
    """DuckDB SQL for corpus_rows()."""
    levels = ",".join(_level_check(k) for k in (1, 2, 3)).replace("SHARE", f"CAST({share} AS DOUBLE)").replace("EPOCHS", str(epochs))
    return rf"""
WITH rows_ AS (
    SELECT doc_id, 'd' || (coalesce(try_cast(regexp_extract(coalesce(source, ''), '([0-9])$', 1) AS INT), 0) % 4) AS a,
        coalesce(lang, '(none)') AS b, coalesce(source, '(none)') AS c,
        len(regexp_extract_all(coalesce(text, ''), '[^ 	-
]+')) AS n
    FROM documents
), leaf AS (SELECT a, b, c, CAST(sum(n) AS BIGINT) AS supply FROM rows_ GROUP BY a, b, c),{levels},
plan AS (
    SELECT a, b, c, CASE WHEN supply > 0 THEN CAST(floor(floor(budget + 1e-6) / supply) AS INT) ELSE 0 END AS whole,
        floor(budget + 1e-6) - CASE WHEN supply > 0 THEN floor(floor(budget + 1e-6) / supply) ELSE 0 END * supply AS rest
    FROM leaf JOIN node3 USING (a, b, c)
), placed AS (
    SELECT *, md5(concat_ws(':', '{SEED}', CAST(whole AS VARCHAR), CAST(doc_id AS VARCHAR))) AS place
    FROM rows_ JOIN plan USING (a, b, c)
), summed AS (
    SELECT *, sum(n) OVER (PARTITION BY a, b, c ORDER BY place RANGE UNBOUNDED PRECEDING)
        - sum(n) OVER (PARTITION BY a, b, c, place) AS start
    FROM placed
)
SELECT doc_id, a AS domain, b AS lang, c AS source, n AS n_tokens, whole + CAST(start < rest AS INT) AS copies
FROM summed WHERE whole + CAST(start < rest AS INT) > 0
"""
