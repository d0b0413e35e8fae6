"""Which table and which joins a calculated field needs.

All steps are joins and aggregations over (plan, reference, table) rows; the only ordered step, choosing
joined tables reference by reference, is a fold over the references of one formula.

Frames: ``calcs`` holds (source_set, formula, hints array<string>), ``catalog`` comes from
``sources.catalog`` and lists the candidate tables of each source set.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vizquarry import fixed
from vizquarry.functions.formulas import field_refs
from vizquarry.functions.names import norm, quote_column, short_name
from vizquarry.session import cut_lineage

_TAGGED = r"\A(.+?)\s*\(([^()]+)\)\z"
_HIT = "array<struct<table_ord:int,table_name:string,column_name:string>>"


def with_plan_key(calcs: DataFrame) -> DataFrame:
    """Equal (source set, formula, hints) share a plan, so they are planned and translated once."""
    return calcs.withColumn(
        "plan_key", F.sha2(F.to_json(F.struct("source_set", "formula", "hints")), 256)
    )


def plan_units(keyed: DataFrame) -> DataFrame:
    return keyed.groupBy("plan_key").agg(
        *[F.any_value(c).alias(c) for c in ("source_set", "formula", "hints")]
    )


def references(units: DataFrame) -> DataFrame:
    """(plan_key, source_set, ref_ord, ref)."""
    return units.select(
        "plan_key", "source_set", F.posexplode(field_refs("formula")).alias("ref_ord", "ref")
    )


def _one_column_per_table(matches: DataFrame) -> DataFrame:
    """An exact name wins; among equal normalized names the last column does."""
    rank = F.struct(F.col("column_name") == F.col("wanted"), F.col("column_ord"))
    return matches.groupBy("source_set", "ref", "table_ord", "table_name").agg(
        F.max_by("column_name", rank).alias("column_name")
    )


def match_columns(refs: DataFrame, catalog: DataFrame) -> DataFrame:
    """(source_set, ref, table_ord, table_name, column_name): one row per table that holds the reference."""
    wanted = refs.select("source_set", "ref").distinct().withColumn("wanted", F.col("ref"))
    return _one_column_per_table(
        wanted.withColumn("norm_name", norm("wanted")).join(catalog, ["source_set", "norm_name"])
    )


def match_tagged(unmatched: DataFrame, catalog: DataFrame) -> DataFrame:
    """The same for "Field (Table)" references that nothing else matched.

    The field part joins by normalized name; the tag must equal, hold or lie within the table's name.
    """
    tag = norm(F.regexp_extract("ref", _TAGGED, 2))
    table = norm(short_name("table_name"))
    tagged = (
        unmatched.select("source_set", "ref")
        .distinct()
        .where(F.col("ref").rlike(_TAGGED))
        .withColumn("wanted", F.regexp_extract("ref", _TAGGED, 1))
        .withColumn("tag", tag)
        .where(F.col("tag") != "")
        .withColumn("norm_name", norm("wanted"))
    )
    return _one_column_per_table(
        tagged.join(catalog, ["source_set", "norm_name"]).where(
            table.contains(F.col("tag")) | F.col("tag").contains(table)
        )
    )


def all_matches(refs: DataFrame, catalog: DataFrame) -> DataFrame:
    direct = match_columns(refs, catalog)
    unmatched = refs.join(direct, ["source_set", "ref"], "left_anti")
    return direct.unionByName(match_tagged(unmatched, catalog))


def table_facts(catalog: DataFrame) -> DataFrame:
    """(source_set, table_ord, table_name, n_columns, short, norms, columns): one row per candidate."""
    return (
        catalog.groupBy("source_set", "table_ord", "table_name")
        .agg(
            F.count(F.lit(1)).alias("n_columns"),
            F.array_sort(F.collect_list(F.struct("norm_name", "column_ord", "column_name"))).alias("cols"),
        )
        .select(
            "source_set",
            "table_ord",
            "table_name",
            "n_columns",
            norm(short_name("table_name")).alias("short"),
            F.array_distinct(F.col("cols.norm_name")).alias("norms"),
            # The last column of a normalized name stands for it, as in matching.
            F.map_from_entries(
                F.transform(
                    F.filter(
                        "cols",
                        lambda c, i: F.coalesce(
                            F.get(F.col("cols"), i + 1)["norm_name"] != c["norm_name"], F.lit(True)
                        ),
                    ),
                    lambda c: F.struct(c["norm_name"], c["column_name"]),
                )
            ).alias("columns"),
        )
    )


def _hinted(hint_norms: Column, short: Column) -> Column:
    return F.exists(hint_norms, lambda h: short.contains(h) | h.contains(short))


def _hint_norms() -> Column:
    return F.filter(F.transform("hints", norm), lambda h: h != "")


def choose_base(units: DataFrame, refs: DataFrame, matches: DataFrame, facts: DataFrame) -> DataFrame:
    """(plan_key, base): most references covered, then named by a hint, then most columns, then first.

    A table that covers anything beats every table that covers nothing, so only plans without any hit
    look at all tables, once per distinct (source set, hints).
    """
    rank = F.struct("covered", "hinted", "n_columns", (-F.col("table_ord")).alias("first"))
    hints = units.select("plan_key", _hint_norms().alias("hint_norms"))
    sized = facts.select("source_set", "table_name", "n_columns", "short")
    covered = (
        refs.join(matches, ["source_set", "ref"])
        .groupBy("plan_key", "source_set", "table_ord", "table_name")
        .agg(F.count(F.lit(1)).alias("covered"))
        .join(sized, ["source_set", "table_name"])
        .join(hints, "plan_key")
        .withColumn("hinted", _hinted(F.col("hint_norms"), F.col("short")))
    )
    chosen = covered.groupBy("plan_key").agg(F.max_by("table_name", rank).alias("base"))
    bare = units.join(chosen, "plan_key", "left_anti").withColumn("hint_norms", _hint_norms())
    fallback = (
        bare.select("source_set", "hint_norms")
        .distinct()
        .join(facts.select("source_set", "table_ord", "table_name", "n_columns", "short"), "source_set")
        .withColumn("covered", F.lit(0))
        .withColumn("hinted", _hinted(F.col("hint_norms"), F.col("short")))
        .groupBy("source_set", "hint_norms")
        .agg(F.max_by("table_name", rank).alias("base"))
    )
    return chosen.unionByName(bare.join(fallback, ["source_set", "hint_norms"]).select("plan_key", "base"))


def _walk(refs: Column, base: Column) -> Column:
    """Fold over the ordered references: where each is found, and the tables joined so far.

    A reference off the base goes to a table that is joined already if it can, else to its first hit.
    """
    start = F.struct(
        F.array().cast("array<string>").alias("joined"),
        F.array().cast("array<struct<ref:string,table_name:string,column_name:string,opens:boolean>>").alias(
            "picks"
        ),
    )

    def step(state: Column, r: Column) -> Column:
        on_base = F.filter(r["hits"], lambda h: h["table_name"] == base)
        known = F.filter(r["hits"], lambda h: F.array_contains(state["joined"], h["table_name"]))
        best = F.coalesce(F.get(on_base, F.lit(0)), F.get(known, F.lit(0)), F.get(r["hits"], F.lit(0)))
        opens = F.coalesce(
            (best["table_name"] != base) & ~F.array_contains(state["joined"], best["table_name"]),
            F.lit(False),
        )
        pick = F.struct(
            r["ref"].alias("ref"),
            best["table_name"].alias("table_name"),
            best["column_name"].alias("column_name"),
            opens.alias("opens"),
        )
        return F.struct(
            F.when(opens, F.array_append(state["joined"], best["table_name"]))
            .otherwise(state["joined"])
            .alias("joined"),
            F.array_append(state["picks"], pick).alias("picks"),
        )

    return F.aggregate(refs, start, step)


def shared_keys(left: Column, right: Column) -> Column:
    """Sorted normalized names both tables have; those that end in id or key if there are any."""
    shared = F.array_sort(F.array_intersect(left, right))
    keyed = F.filter(shared, lambda k: k.rlike(fixed.JOIN_KEY_PATTERN))
    return F.when(F.size(keyed) > 0, keyed).otherwise(shared)


def _joins(walked: DataFrame, facts: DataFrame) -> DataFrame:
    """(plan_key, joins): the joined tables in order, with alias, keys and condition."""
    opened = walked.select(
        "plan_key",
        "source_set",
        "base",
        F.posexplode(F.filter("picks", lambda p: p["opens"])).alias("join_ord", "pick"),
    )
    base = facts.select(
        "source_set",
        F.col("table_name").alias("base"),
        F.col("norms").alias("base_norms"),
        F.col("columns").alias("base_columns"),
    )
    other = facts.select(
        "source_set", F.col("table_name").alias("other"), "short", "norms", "columns"
    )
    alias = F.when(F.col("short") == "", F.lit("t")).otherwise(F.col("short"))
    alias = F.when(alias.rlike("^[0-9]"), F.concat(F.lit("_"), alias)).otherwise(alias)
    return (
        opened.withColumn("other", F.col("pick.table_name"))
        .join(base, ["source_set", "base"])
        .join(other, ["source_set", "other"])
        .select(
            "plan_key",
            F.struct(
                "join_ord",
                F.col("other").alias("source"),
                F.col("pick.ref").alias("ref"),
                alias.alias("alias"),
                F.transform(
                    shared_keys(F.col("base_norms"), F.col("norms")),
                    lambda k: F.struct(
                        k.alias("key"),
                        quote_column(F.col("base_columns")[k]).alias("base_column"),
                        quote_column(F.col("columns")[k]).alias("column"),
                    ),
                ).alias("keys"),
            ).alias("j"),
        )
        .groupBy("plan_key")
        .agg(F.array_sort(F.collect_list("j")).alias("found"))
        .select("plan_key", _with_unique_aliases(F.col("found")).alias("found"))
    )


def _with_unique_aliases(found: Column) -> Column:
    """Append ``_j`` until an alias differs from ``source`` and the aliases before it."""

    def step(done: Column, j: Column) -> Column:
        used = F.concat(F.array(F.lit("source")), F.transform(done, lambda d: d["name"]))
        tries = F.transform(
            F.sequence(F.lit(0), F.size(used)), lambda n: F.concat(j["alias"], F.repeat(F.lit("_j"), n))
        )
        name = F.get(F.filter(tries, lambda t: ~F.array_contains(used, t)), F.lit(0))
        on = F.array_join(
            F.transform(
                j["keys"],
                lambda k: F.concat(
                    F.lit("source."), k["base_column"], F.lit(" = "), name, F.lit("."), k["column"]
                ),
            ),
            " AND ",
        )
        return F.array_append(
            done,
            F.struct(
                name.alias("name"),
                j["source"].alias("source"),
                on.alias("on"),
                j["ref"].alias("ref"),
                j["keys"].alias("keys"),
            ),
        )

    start = F.array().cast(
        "array<struct<name:string,source:string,on:string,ref:string,"
        "keys:array<struct<key:string,base_column:string,column:string>>>>"
    )
    return F.aggregate(found, start, step)


def plan_sources(units: DataFrame, catalog: DataFrame) -> DataFrame:
    """One row per plan unit with base, joins, colmap, notes and fatal.

    ``colmap`` lists (ref, sql) in reference order. ``fatal`` says why the tables cannot be joined; the
    plan then has no joins and no map.
    """
    # Each of these is joined several times below; stored, they are computed once and their sizes known.
    units = cut_lineage(units)
    facts = cut_lineage(table_facts(catalog))
    refs = references(units)
    matches = cut_lineage(all_matches(refs, catalog))
    base = choose_base(units, refs, matches, facts)
    hits = matches.groupBy("source_set", "ref").agg(
        F.array_sort(F.collect_list(F.struct("table_ord", "table_name", "column_name"))).alias("hits")
    )
    ordered = (
        refs.join(hits, ["source_set", "ref"], "left")
        .groupBy("plan_key")
        .agg(
            F.array_sort(
                F.collect_list(
                    F.struct("ref_ord", "ref", F.coalesce("hits", F.array().cast(_HIT)).alias("hits"))
                )
            ).alias("refs")
        )
    )
    no_refs = F.array().cast(f"array<struct<ref_ord:int,ref:string,hits:{_HIT}>>")
    walked = (
        units.join(base, "plan_key", "left")
        .join(ordered, "plan_key", "left")
        .withColumn("picks", _walk(F.coalesce("refs", no_refs), F.col("base"))["picks"])
        .drop("refs")
    )
    no_joins = F.array().cast(
        "array<struct<name:string,source:string,on:string,ref:string,"
        "keys:array<struct<key:string,base_column:string,column:string>>>>"
    )
    walked = cut_lineage(walked)
    planned = walked.join(_joins(walked, facts), "plan_key", "left").withColumn(
        "found", F.coalesce("found", no_joins)
    )
    # Planning halts at the first table without a shared column; what came before it keeps its notes.
    broken = F.get(F.filter("found", lambda j: F.size(j["keys"]) == 0), F.lit(0))
    halted = F.coalesce(
        F.array_position(F.col("picks.ref"), F.col("broken.ref")), F.lit(0)
    ).cast("int")
    reached = F.when(F.col("halted") > 0, F.slice("picks", 1, F.col("halted") - 1)).otherwise(
        F.col("picks")
    )

    def join_of(pick: Column) -> Column:
        return F.get(F.filter("found", lambda j: j["source"] == pick["table_name"]), F.lit(0))

    def note(pick: Column) -> Column:
        j = join_of(pick)
        names = F.array_join(F.transform(j["keys"], lambda k: k["key"]), ", ")
        return (
            F.when(pick["table_name"].isNull(), F.format_string(fixed.NOTE_NOT_FOUND, pick["ref"]))
            .when(pick["opens"], F.format_string(fixed.NOTE_JOINED, j["source"], j["name"], names))
        )

    def sql(pick: Column) -> Column:
        column = quote_column(F.coalesce(pick["column_name"], pick["ref"]))
        return F.when(
            pick["table_name"].isNull() | (pick["table_name"] == F.col("base")), column
        ).otherwise(F.concat(join_of(pick)["name"], F.lit("."), column))

    fatal = F.when(F.col("base").isNull(), F.lit(fixed.FATAL_NO_TABLE)).when(
        F.col("halted") > 0,
        F.format_string(
            fixed.FATAL_NO_KEYS, F.col("broken.ref"), F.col("broken.source"), F.col("base")
        ),
    )
    entry = lambda p: F.struct(p["ref"].alias("ref"), sql(p).alias("sql"))
    return (
        planned.withColumn("broken", broken)
        .withColumn("halted", halted)
        .withColumn("fatal", fatal)
        .withColumn("notes", F.filter(F.transform(reached, note), lambda n: n.isNotNull()))
        .withColumn("joins", F.when(F.col("halted") == 0, F.col("found")).otherwise(no_joins))
        .withColumn(
            "colmap",
            F.when(F.col("halted") == 0, F.transform("picks", entry)).otherwise(
                F.array().cast("array<struct<ref:string,sql:string>>")
            ),
        )
        .select("plan_key", "source_set", "formula", "hints", "base", "joins", "colmap", "notes", "fatal")
    )
