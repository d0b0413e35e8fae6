"""Exact quantiles of groups of any size, by distributed selection.

A quantile is a value at a rank. Each round counts the rows of every (group, rank) still searched in ``BINS`` ranges of equal
width, and goes on with the range that holds the rank; counts are combined before the shuffle, so a group with half
of all rows is counted by all tasks. A range that holds one distinct value, or ``FEW`` rows at most, is read out.
Each round narrows a range by the number of bins, whatever the distribution does; rows outside the ranges drop out first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from vizquarry.functions.names import quoted
from vizquarry.session import Steps, cut_lineage

BINS = 1024
#: Rows of one range that a task may sort.
FEW = 10_000


def quantiles(rows: DataFrame, keys: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """The keys and one column for each share: the value at that share of the way through the sorted values.

    Between two values it is interpolated, as ``percentile`` does; the middle is 0.5. Null and NaN values don't count, a group
    without others gets nulls. Null keys are a group.
    """
    bad = {name: p for name, p in shares.items() if not 0 <= p <= 1}
    if bad:
        raise ValueError(f"shares lie between 0 and 1: {bad}")
    named = [f"k{i}" for i in range(len(keys))]
    v = F.col(quoted(value)).cast("double")
    valued = rows.select(*[F.col(quoted(k)).alias(n) for k, n in zip(keys, named)], F.when(~F.isnan(v), v).alias("v"))
    same = [F.xxhash64(*named).alias("g")] if named else [F.lit(0).cast("long").alias("g")]
    # Groups are named by all their keys; the digest only keeps null keys joinable.
    valued = valued.select(*named, *same, "v")
    groups = valued.groupBy(*named, "g").agg(F.count("v").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    groups = cut_lineage(groups)
    wanted = [F.struct(F.lit(name).alias("share"), (F.lit(float(p)) * (F.col("n") - 1)).alias("at")) for name, p in shares.items()]
    asked = groups.where("n > 0").select("*", F.explode(F.array(*wanted)).alias("x"))
    ranks = asked.select(*named, "g", "n", "low", "high", F.explode(F.array_distinct(F.array(F.floor("x.at"), F.ceil("x.at")))).alias("rank"))
    ranks = ranks.distinct().select(*named, "g", "rank", "low", "high", F.lit(0).cast("long").alias("before"), F.col("n").alias("held"))
    found = _selected(valued.where("v IS NOT NULL"), ranks, named)

    key = [*named, "g"]
    at = asked.select(*key, "x.share", F.floor("x.at").alias("lower"), F.ceil("x.at").alias("upper"), "x.at")
    lower = found.select(*[F.col(k).alias(f"l_{k}") for k in key], F.col("rank").alias("lower"), F.col("value").alias("a"))
    upper = found.select(*[F.col(k).alias(f"u_{k}") for k in key], F.col("rank").alias("upper_"), F.col("value").alias("b"))
    alike = lambda side: [F.col(k).eqNullSafe(F.col(f"{side}_{k}")) for k in named]
    both = at.join(lower.withColumnRenamed("lower", "lower_"), _every(F.col("g") == F.col("l_g"), F.col("lower") == F.col("lower_"), *alike("l")))
    both = both.join(upper, _every(F.col("g") == F.col("u_g"), F.col("upper") == F.col("upper_"), *alike("u")))
    between = F.when(F.col("lower") == F.col("upper"), F.col("a")).otherwise(F.col("a") + (F.col("at") - F.col("lower")) * (F.col("b") - F.col("a")))
    wide = both.groupBy(*key).agg(*[F.max(F.when(F.col("share") == name, between)).alias(f"q{i}") for i, name in enumerate(shares)])
    wide = wide.select(*[F.col(k).alias(f"w_{k}") for k in key], *[f"q{i}" for i in range(len(shares))])
    out = groups.join(wide, _every(F.col("g") == F.col("w_g"), *alike("w")), "left")
    return out.select(*[F.col(n).alias(k) for k, n in zip(keys, named)], *[F.col(f"q{i}").alias(name) for i, name in enumerate(shares)])


def _every(first: Column, *more: Column) -> Column:
    for condition in more:
        first = first & condition
    return first


def _selected(valued: DataFrame, ranks: DataFrame, named: list[str]) -> DataFrame:
    """(group, rank, value) from ranks searched between ``low`` and ``high``, with ``before`` rows below and ``held`` rows in it."""
    key = [*named, "g", "rank"]
    done, live, rows = Steps(valued.sparkSession), ranks, valued
    few = None
    while True:
        live = done.add(live)
        settled = F.col("low") == F.col("high")
        small = ~settled & (F.col("held") <= FEW)
        read = _inside(rows, live.where(small), named).groupBy(*key, "before").agg(F.sort_array(F.collect_list("v")).alias("sorted"))
        read = read.select(*key, F.get("sorted", (F.col("rank") - F.col("before")).cast("int")).alias("value"))
        few = read if few is None else few.union(read)
        live = live.where(~settled & (F.col("held") > FEW))
        if live.isEmpty():
            ready = done.all().where(settled).select(*key, F.col("low").alias("value"))
            return cut_lineage(ready.union(few))
        # Halves first, as the width itself may be beyond a double.
        width = F.col("high") / BINS - F.col("low") / BINS
        bin_ = F.when(F.col("v") == F.col("high"), BINS - 1).otherwise(
            F.least(F.lit(BINS - 1), F.floor((F.col("v") / BINS - F.col("low") / BINS) / F.greatest(width, F.lit(5e-324)) * BINS))
        )
        inside = _inside(rows, live, named).withColumn("bin", bin_)
        counted = inside.groupBy(*key, "before", "bin").agg(F.count("*").alias("held"), F.min("v").alias("low"), F.max("v").alias("high"))
        order = Window.partitionBy(*key).orderBy("bin")  # BINS rows at most
        placed = counted.withColumn("below", F.col("before") + F.sum("held").over(order) - F.col("held"))
        here = placed.where((F.col("below") <= F.col("rank")) & (F.col("rank") < F.col("below") + F.col("held")))
        live = here.select(*key, "low", "high", F.col("below").alias("before"), "held")


def _inside(rows: DataFrame, ranks: DataFrame, named: list[str]) -> DataFrame:
    """Rows with each rank whose range they are in."""
    theirs = ranks.select(*[F.col(n).alias(f"r_{n}") for n in named], F.col("g").alias("r_g"), "rank", "low", "high", "before")
    condition = _every(F.col("g") == F.col("r_g"), F.col("v").between(F.col("low"), F.col("high")), *[F.col(n).eqNullSafe(F.col(f"r_{n}")) for n in named])
    return rows.join(theirs, condition).select(*named, "g", "rank", "low", "high", "before", "v")
