"""Reference graphs of all workbooks at once: longest paths by doubling, components, simple paths inside a component.

An edge row is (key columns ..., src, dst): ``src`` refers to ``dst`` in the graph named by the key. No graph is ever held by one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vizquarry.session import Steps, cut_lineage, remove, stored


def settle(rows: DataFrame, key: list[str], default: int | None = None, bounded: bool = False) -> tuple[DataFrame, DataFrame]:
    """Solve ``value(src) = max(constant, step + value(dst))`` for every node that reaches no cycle.

    ``rows`` are (key ..., src, dst, value): a step to ``dst``, or a constant of the node where ``dst`` is null. With a
    ``default`` they are stored steps only, and a node without any is worth that. Returns (key ..., src, value) of the
    solved nodes of ``rows``, the largest of a node being its value, and (key ..., src) of those that reach a cycle.

    Pointer doubling: each round puts the equation of ``dst`` in its place in every equation, so steps stand for twice
    as many references as before and are gone after log2(depth) rounds. Steps between two nodes are one step, the longest.
    A round holds the steps that are left and the constants that are new; constants of all rounds stay valid.
    What is left when steps stand for more references than any graph with steps has goes in a cycle (``bounded``).
    """
    node = [*key, "src"]
    steps, span, bound = Steps(rows.sparkSession), 1, None

    def add(made: DataFrame) -> DataFrame:
        return steps.add(made.groupBy(*node, "dst").agg(F.max("value").cast("int").alias("value"))).where("dst IS NOT NULL")

    def constants() -> DataFrame:
        return steps.all().where("dst IS NULL").select(*node, "value")

    live = rows.select(*node, "dst", "value") if default is not None else add(rows)
    while not live.isEmpty() and (bound is None or span <= bound):
        if bounded and bound is None and span >= 8:
            # Few graphs are as deep as that.
            open_graphs = live.select(*key).distinct()
            bound = rows.join(open_graphs, key, "left_semi").groupBy(*key).count().agg(F.max("count")).first()[0]
        targets = live.select(*key, F.col("src").alias("at"), "dst", "value")
        if steps.paths:
            none = F.lit(None).cast(live.schema["dst"].dataType).alias("dst")
            targets = targets.union(constants().select(*key, F.col("src").alias("at"), none, "value"))
        asked = live.select(*node, F.col("dst").alias("at"), F.col("value").alias("step"))
        met = asked.join(targets, [*key, "at"], "inner" if default is None else "left")
        further = F.col("value") if default is None else F.coalesce("value", F.lit(default))
        live = add(met.select(*node, "dst", (F.col("step") + further).alias("value")))
        span *= 2
    if not steps.paths:
        return rows.select(*node, "value").limit(0), rows.select(*node).limit(0)
    if live.isEmpty():
        return constants(), live.select(*node)
    cyclic = cut_lineage(live.select(*node).distinct())
    return constants().join(cyclic, node, "left_anti"), cyclic


def depths(edges: DataFrame, key: list[str]) -> tuple[DataFrame, DataFrame]:
    """Nodes on the longest path from each node that refers to others, the largest of a node, and the nodes that reach a cycle; ``edges`` are stored."""
    return settle(edges.withColumn("value", F.lit(1)), key, 1, bounded=True)


def components(edges: DataFrame, key: list[str]) -> DataFrame:
    """(key ..., src, component): the nodes on a cycle, with the smallest node of their strongly connected component.

    The pairs that reach each other, forward and backward, come from doubling reach until it stops growing.
    """
    reach, path = stored(edges.select(*key, "src", "dst").distinct())
    n = reach.count()
    while True:
        step = reach.select(*key, F.col("src").alias("dst"), F.col("dst").alias("to"))
        further = reach.join(step, [*key, "dst"]).select(*key, "src", F.col("to").alias("dst"))
        grown, new_path = stored(reach.union(further).distinct())
        remove(edges.sparkSession, path)
        reach, path, before = grown, new_path, n
        n = reach.count()
        if n == before:
            break
    back = reach.select(*key, F.col("src").alias("dst"), F.col("dst").alias("src"))
    return reach.join(back, [*key, "src", "dst"], "left_semi").groupBy(*key, "src").agg(F.min("dst").alias("component"))


def simple_paths(edges: DataFrame, members: DataFrame, key: list[str]) -> DataFrame:
    """(key ..., src, last, value): nodes on the longest simple path between any two nodes of a component.

    A path grows by one node a round. Paths with equal ends over the same nodes have the same future, so one goes on: the work is bounded
    by the subsets of one component.
    """
    at = members.select(*key, F.col("src").alias("dst"), F.col("component").alias("also"))
    inside = edges.join(members, [*key, "src"]).join(at, [*key, "dst"]).where("component = also")
    inside = cut_lineage(inside.select(*key, F.col("src").alias("last"), F.col("dst").alias("next")).distinct())
    rounds, length = Steps(members.sparkSession), 1
    paths = members.select(*key, "src", F.col("src").alias("last"), F.array("src").alias("seen"))
    while True:
        paths = rounds.add(paths.withColumn("value", F.lit(length)))
        if paths.isEmpty():
            return rounds.all().groupBy(*key, "src", "last").agg(F.max("value").alias("value"))
        grown = paths.join(inside, [*key, "last"]).where(~F.array_contains("seen", F.col("next")))
        seen = F.array_sort(F.array_append("seen", F.col("next"))).alias("seen")
        paths = grown.select(*key, "src", F.col("next").alias("last"), seen).distinct()
        length += 1


def longest_paths(edges: DataFrame, key: list[str]) -> DataFrame:
    """(key ..., src, value): nodes on the longest path that visits none twice, from each node that refers to others."""
    return path_lengths(edges.distinct(), key).groupBy(*key, "src").agg(F.max("value").alias("value"))


def path_lengths(edges: DataFrame, key: list[str]) -> DataFrame:
    """``longest_paths`` among shorter ones: (key ..., src, value), of which the largest of a node is its length. Repeated edges cost time only."""
    edges = cut_lineage(edges.select(*key, "src", "dst"))
    solved, cyclic = depths(edges, key)
    if cyclic.isEmpty():
        return solved
    # Only nodes that reach a cycle go on. A component's simple paths become steps to what it refers to outside.
    rest = cut_lineage(edges.join(cyclic, [*key, "src"], "left_semi"))
    among = rest.join(cyclic.withColumnRenamed("src", "dst"), [*key, "dst"], "left_semi")
    members = cut_lineage(components(among, key))
    inner = cut_lineage(simple_paths(among, members, key))
    lone = cyclic.join(members, [*key, "src"], "left_anti")
    none = F.lit(None).cast("string").alias("dst")
    own = inner.groupBy(*key, "src").agg(F.max("value").alias("value")).select(*key, "src", none, "value")
    constants = own.union(lone.select(*key, "src", none, F.lit(1).alias("value")))
    others = rest.select(*key, F.col("dst").alias("src")).distinct().join(cyclic, [*key, "src"], "left_anti")
    known = others.join(solved, [*key, "src"], "left").select(*key, "src", none, F.coalesce("value", F.lit(1)).alias("value"))
    constants = constants.union(known)
    also = members.select(*key, F.col("src").alias("dst"), F.col("component").alias("also"))
    leaving = rest.join(members, [*key, "src"]).join(also, [*key, "dst"], "left").where("also IS NULL OR component <> also")
    leaving = leaving.select(*key, F.col("src").alias("last"), "dst")
    steps = inner.join(leaving, [*key, "last"]).groupBy(*key, "src", "dst").agg(F.max("value").alias("value"))
    steps = steps.union(rest.join(lone, [*key, "src"], "left_semi").select(*key, "src", "dst", F.lit(1).alias("value")))
    rest_solved, _ = settle(constants.union(steps), key)
    return solved.union(rest_solved.join(cyclic, [*key, "src"], "left_semi"))
