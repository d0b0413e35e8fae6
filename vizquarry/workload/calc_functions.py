"""One query per rule of the calculation language, each evaluated over the whole sales tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from vizquarry import fixed
from vizquarry.operators.quantiles import quantiles
from vizquarry.plans.dashboards import union_all
from vizquarry.workload import fixtures as fx
from vizquarry.workload.checks import check
from vizquarry.workload.semantic import views_for

# name: (formula, cast of the value or None, same thing in the check's SQL, table of the check)
DIMENSIONS = {
    "fn_zn": ("ZN(IIF([Quantity] > 25, [Discount], NULL))", None,
              "coalesce(CASE WHEN quantity > 25 THEN discount END, 0)", "sales_lines"),
    "fn_ifnull": ('IFNULL(IIF([Quantity] > 25, [Return Flag], NULL), "none")', None,
                  "coalesce(CASE WHEN quantity > 25 THEN return_flag END, 'none')", "sales_lines"),
    "fn_isnull": ("ISNULL(IIF([Quantity] > 25, [Tax], NULL))", None,
                  "(CASE WHEN quantity > 25 THEN tax END) IS NULL", "sales_lines"),
    "fn_iif": ('IIF([Quantity] > 25, "high", "low", "unknown")', None,
               "CASE WHEN quantity > 25 THEN 'high' ELSE 'low' END", "sales_lines"),
    "fn_if_elseif": ('IF [Quantity] > 40 THEN "L" ELSEIF [Quantity] > 30 THEN "M" ELSEIF [Tax] > 0.04 THEN "T"'
                     ' ELSE "S" END', None,
                     "CASE WHEN quantity > 40 THEN 'L' WHEN quantity > 30 THEN 'M' WHEN tax > 0.04 THEN 'T'"
                     " ELSE 'S' END", "sales_lines"),
    "fn_case": ('CASE [Return Flag] WHEN "A" THEN 1 WHEN "N" THEN 2 ELSE 3 END', "bigint",
                "CASE return_flag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END", "sales_lines"),
    "fn_equality": ('[Return Flag] == "R"', None, "return_flag = 'R'", "sales_lines"),
    "fn_string_literal": ('IIF([Line Status] = "O", "it\'s open", \'closed "now"\')', None,
                          "CASE WHEN line_status = 'O' THEN 'it''s open' ELSE 'closed \"now\"' END", "sales_lines"),
    "fn_len": ("LEN([Part Name])", "bigint", "length(part_name)", "sales_parts"),
    "fn_mid": ("MID([Part Name], 2, 5)", None, "substring(part_name, 2, 5)", "sales_parts"),
    "fn_find": ('FIND([Part Name], "a", 3)', "bigint", "instr(part_name, 'a')", "sales_parts"),
    "fn_str": ("STR([Line Number])", None, "CAST(line_number AS VARCHAR)", "sales_lines"),
    "fn_float": ("FLOAT(STR([Line Number])) / 4", None, "CAST(line_number AS DOUBLE) / 4", "sales_lines"),
    "fn_int": ("INT([Extended Price] / 1000)", "bigint", "CAST(trunc(extended_price / 1000) AS BIGINT)", "sales_lines"),
    "fn_datetrunc": ('DATETRUNC("month", [Ship Date], "monday")', "timestamp_ntz", "date_trunc('month', ship_date)",
                     "sales_lines"),
    "fn_today": ("TODAY() >= [Ship Date]", None, "current_date >= ship_date", "sales_lines"),
    "fn_now": ("NOW() >= [Ship Date]", None, "now()::TIMESTAMP >= ship_date", "sales_lines"),
    "fn_divide": ("[Quantity] / [Discount]", None, "quantity / nullif(discount, 0)", "sales_lines"),
}

# name: (measure name -> (formula, SQL of the check, digits or None), grouping column)
MEASURES = {
    "fn_countd": {"parts": ("COUNTD([Part Id])", "count(DISTINCT part_id)", None)},
    "fn_attr": {"line": ("ATTR([Line Status])", "min(line_status)", None)},
    "fn_stdevp": {"v": ("STDEVP([Quantity])", "stddev_pop(quantity)", 6)},
    "fn_stdev": {"v": ("STDEV([Quantity])", "stddev_samp(quantity)", 6)},
    "fn_varp": {"v": ("VARP([Quantity])", "var_pop(quantity)", 6)},
    "fn_var": {"v": ("VAR([Quantity])", "var_samp(quantity)", 6)},
    "fn_max": {"most": ("MAX([Tax])", "max(tax)", None),
               "most_of_two": ("SUM(MAX([Tax], [Discount]))", "sum(greatest(tax, discount))", 4)},
    "fn_min": {"least": ("MIN([Tax])", "min(tax)", None),
               "least_of_two": ("SUM(MIN([Tax], [Discount]))", "sum(least(tax, discount))", 4)},
    "fn_sum_avg_count_median": {"total": ("SUM([Extended Price])", "sum(extended_price)", 2),
                                "mean": ("AVG([Extended Price])", "avg(extended_price)", 4),
                                "n": ("COUNT([Extended Price])", "count(extended_price)", None),
                                "mid": ("MEDIAN([Quantity])", "median(quantity)", 4)},
    "fn_percentile": {"p90": ("PERCENTILE([Quantity], 0.9)", "quantile_cont(quantity, 0.9)", 4)},
    "fn_corr_covar": {"r": ("CORR([Quantity], [Extended Price])", "corr(quantity, extended_price)", 6),
                      "cp": ("COVAR_POP([Quantity], [Extended Price])", "covar_pop(quantity, extended_price)", 2),
                      "cs": ("COVAR_SAMP([Quantity], [Extended Price])", "covar_samp(quantity, extended_price)", 2)},
    "fn_any_value": {"flag": ("ANY_VALUE([Return Flag])", "any_value(return_flag)", None)},
    "fn_passed_statistics": {"a": ("STDDEV_SAMP([Tax])", "stddev_samp(tax)", 6),
                             "b": ("STDDEV_POP([Tax])", "stddev_pop(tax)", 6),
                             "c": ("VAR_SAMP([Tax])", "var_samp(tax)", 6),
                             "d": ("VAR_POP([Tax])", "var_pop(tax)", 6)},
}
# Lists are as long as an order has lines.
COLLECTED = {"numbers": "COLLECT_LIST([Line Number])", "flags": "COLLECT_SET([Return Flag])"}
APPROXIMATE = {"parts": "APPROX_COUNT_DISTINCT([Part Id])", "p50": "APPROX_PERCENTILE([Quantity], 0.5)"}

# Names the translator does not know; they work where Spark has them.
PASSED = {
    "UPPER": ("UPPER([Brand])", "upper(brand)"),
    "LOWER": ("LOWER([Brand])", "lower(brand)"),
    "TRIM": ("TRIM([Brand])", "trim(brand)"),
    "ABS": ("STR(ABS([Size] - 25))", "CAST(abs(size - 25) AS VARCHAR)"),
    "ROUND": ("STR(INT(ROUND([Retail Price])))", "CAST(CAST(round(retail_price) AS BIGINT) AS VARCHAR)"),
    "CONTAINS": ('IIF(CONTAINS([Part Name], "a"), "yes", "no")', "CASE WHEN contains(part_name, 'a') THEN 'yes' ELSE 'no' END"),
    "LEFT": ("LEFT([Part Type], 3)", "left(part_type, 3)"),
}
UNITS = [u.lower() for u in fixed.DATE_UNITS]


def _every_formula() -> dict[str, str]:
    out = {name: spec[0] for name, spec in DIMENSIONS.items()}
    for name, measures in MEASURES.items():
        out.update({f"{name}.{m}": spec[0] for m, spec in measures.items()})
    out.update({f"fn_approx.{m}": f for m, f in APPROXIMATE.items()})
    out.update({f"fn_collect.{m}": f for m, f in COLLECTED.items()})
    out.update({f"passed.{n}": f for n, (f, _) in PASSED.items()})
    for u in UNITS:
        out[f"trunc.{u}"] = f'DATETRUNC("{u}", [Ship Date])'
        out[f"add.{u}"] = f"MAX(DATEADD('{u}', 3, [Ship Date]))"
        out[f"diff.{u}"] = f"SUM(DATEDIFF('{u}', [Order Date], [Ship Date]))"
        out[f"part.{u}"] = f"SUM(DATEPART('{u}', [Ship Date]))"
    return out


def _view(spark, sf, name):
    return views_for(spark, sf, _every_formula())[name]


def _dimension(name):
    cast = DIMENSIONS[name][1]

    def run(spark, sf):
        view = _view(spark, sf, name)
        value = F.col(view.slug)
        return view.select().select((value.cast(cast) if cast else value).alias("value"), "record_count")

    return run


def _measures(name):
    def run(spark, sf):
        views = {m: _view(spark, sf, f"{name}.{m}") for m in MEASURES[name]}
        first = next(iter(views.values()))
        # The measures share their source, so one aggregation serves them all.
        exprs = {m: v.expr for m, v in views.items()}
        grouped = first.source().groupBy("return_flag").agg(*[F.expr(e).alias(m) for m, e in exprs.items()])
        out = ["return_flag"]
        for m, (_, _, digits) in MEASURES[name].items():
            c = F.col(m)
            out.append((F.round(c, digits) if digits else c).alias(m))
        return grouped.select(*out)

    return run


def fn_measure_reference(spark, sf):
    view = _view(spark, sf, "fn_sum_avg_count_median.total")
    half = {"half_total": f"MEASURE({view.slug}) / 2"}
    return view.select("return_flag", measures=half).select(
        "return_flag", F.round(view.slug, 2).alias("total"), F.round("half_total", 2).alias("half_total")
    )


def fn_approx(spark, sf):
    """Approximate aggregates beside the exact ones: within 10 % of the count, and in the middle by rank."""
    exprs = {m: _view(spark, sf, f"fn_approx.{m}").expr for m in APPROXIMATE}
    source = _view(spark, sf, "fn_approx.parts").source()
    by_rank = {"low": "percentile(quantity, 0.48)", "high": "percentile(quantity, 0.52)"}
    # Counted apart: beside a distinct count every other aggregate is kept for each flag and part.
    found = source.groupBy("return_flag").agg(*[F.expr(e).alias(m) for m, e in (exprs | by_rank).items()])
    exact = source.groupBy(F.col("return_flag").alias("_flag")).agg(F.expr("count(DISTINCT part_id)").alias("exact_parts"))
    return found.join(exact, F.col("return_flag").eqNullSafe(F.col("_flag"))).select(
        "return_flag", "exact_parts", (F.abs(F.col("parts") - F.col("exact_parts")) <= 0.1 * F.col("exact_parts")).alias("parts_close"),
        F.col("p50").between(F.floor("low"), F.ceil("high")).alias("p50_close"),
    )


QUANTILES = {"p01": 0.01, "mid": 0.5, "p90": 0.9, "most": 1.0}


def fn_quantiles(spark, sf):
    """MEDIAN and PERCENTILE by distributed selection: each group is counted by all tasks."""
    source = _view(spark, sf, "fn_percentile.p90").source()
    found = quantiles(source, ["return_flag", "line_status"], "extended_price", QUANTILES)
    return found.select("return_flag", "line_status", *[F.round(q, 4).alias(q) for q in QUANTILES])


def fn_collect(spark, sf):
    exprs = {m: _view(spark, sf, f"fn_collect.{m}").expr for m in COLLECTED}
    source = _view(spark, sf, "fn_collect.numbers").source()
    listed = source.groupBy("order_id").agg(*[F.expr(e).alias(m) for m, e in exprs.items()])
    return listed.select("order_id", *[F.array_join(F.array_sort(m), ",").alias(m) for m in COLLECTED])


def fn_passthrough(spark, sf):
    parts = []
    for name in PASSED:
        view = _view(spark, sf, f"passed.{name}")
        parts.append(
            view.select().select(F.lit(name).alias("fn"), F.col(view.slug).alias("value"), "record_count")
        )
    return union_all(parts)


def _unit_views(spark, sf, prefix):
    """The views of all units and the source that they share."""
    views = {u: _view(spark, sf, f"{prefix}.{u}") for u in UNITS}
    return views, next(iter(views.values())).source()


def _unit_totals(prefix, keys, name, kind):
    """One aggregation with a column per unit, then a row per unit."""

    def run(spark, sf):
        views, source = _unit_views(spark, sf, prefix)
        wide = source.groupBy(*keys).agg(*[F.expr(v.expr).cast(kind).alias(u) for u, v in views.items()])
        return wide.unpivot(list(keys), list(views), "unit", name)

    return run


def fn_date_units(spark, sf):
    views, source = _unit_views(spark, sf, "trunc")
    values = [F.struct(F.lit(u).alias("unit"), F.expr(v.expr).cast("timestamp_ntz").alias("v")) for u, v in views.items()]
    periods = source.select(F.explode(F.array(*values)).alias("x")).select("x.unit", "x.v").distinct()
    return periods.groupBy("unit").agg(
        F.count(F.lit(1)).alias("periods"), F.min("v").alias("first"), F.max("v").alias("last")
    )


QUERIES = {
    **{name: _dimension(name) for name in DIMENSIONS},
    **{name: _measures(name) for name in MEASURES},
    "fn_measure_reference": fn_measure_reference,
    "fn_approx": fn_approx,
    "fn_quantiles": fn_quantiles,
    "fn_collect": fn_collect,
    "fn_passthrough": fn_passthrough,
    "fn_date_units": fn_date_units,
    "fn_dateadd": _unit_totals("add", (), "latest", "timestamp_ntz"),
    "fn_datediff": _unit_totals("diff", ("return_flag",), "total", "bigint"),
    "fn_datepart": _unit_totals("part", ("return_flag",), "total", "double"),
}

_MONTHS = """trunc(((year(ship_date) * 12 + month(ship_date)) * 32 + day(ship_date)
    - (year(order_date) * 12 + month(order_date)) * 32 - day(order_date)) / 32.0)"""
_DIFFS = {
    "year": f"trunc({_MONTHS} / 12)", "quarter": f"trunc({_MONTHS} / 3)", "month": _MONTHS,
    **{u: f"date_sub('{u}', order_date, ship_date)" for u in ("week", "day", "hour", "minute", "second")},
}
_JOINED = "sales_lines l LEFT JOIN sales_orders o ON o.order_id = l.order_id"


def _union(make) -> str:
    return " UNION ALL ".join(f"SELECT '{u}' AS unit, {make(u)}" for u in UNITS)


CHECKS = {
    name: f"SELECT {sql}{'::' + cast.upper() if cast == 'bigint' else ''} AS value, count(*) AS record_count"
    f" FROM {table} GROUP BY 1"
    for name, (_, cast, sql, table) in DIMENSIONS.items()
}
for _name, _specs in MEASURES.items():
    _cols = ", ".join(
        f"{f'round({sql}, {digits})' if digits else sql} AS {m}" for m, (_, sql, digits) in _specs.items()
    )
    CHECKS[_name] = f"SELECT return_flag, {_cols} FROM sales_lines GROUP BY return_flag"
CHECKS["fn_measure_reference"] = """SELECT return_flag, round(sum(extended_price), 2) AS total,
    round(sum(extended_price) / 2, 2) AS half_total FROM sales_lines GROUP BY return_flag"""
CHECKS["fn_approx"] = """SELECT return_flag, count(DISTINCT part_id) AS exact_parts, true AS parts_close, true AS p50_close
    FROM sales_lines GROUP BY return_flag"""
CHECKS["fn_quantiles"] = "SELECT return_flag, line_status, " + ", ".join(
    f"round(quantile_cont(extended_price, {p}), 4) AS {q}" for q, p in QUANTILES.items()
) + " FROM sales_lines GROUP BY return_flag, line_status"
CHECKS["fn_collect"] = """SELECT order_id, array_to_string(list_sort(list(line_number)), ',') AS numbers,
    array_to_string(list_sort(list(DISTINCT return_flag)), ',') AS flags FROM sales_lines GROUP BY order_id"""
CHECKS["fn_passthrough"] = " UNION ALL ".join(
    f"SELECT '{n}' AS fn, {sql} AS value, count(*) AS record_count FROM sales_parts GROUP BY 2"
    for n, (_, sql) in PASSED.items()
)
CHECKS["fn_date_units"] = _union(
    lambda u: f"count(DISTINCT date_trunc('{u}', ship_date)) AS periods, min(date_trunc('{u}', ship_date))::TIMESTAMP"
    f" AS first, max(date_trunc('{u}', ship_date))::TIMESTAMP AS last FROM sales_lines"
)
CHECKS["fn_dateadd"] = _union(
    lambda u: "max(ship_date + INTERVAL "
    + ("9 MONTH" if u == "quarter" else f"3 {u.upper()}") + ") AS latest FROM sales_lines"
)
CHECKS["fn_datediff"] = _union(
    lambda u: f"return_flag, CAST(sum({_DIFFS[u]}) AS BIGINT) AS total FROM {_JOINED} GROUP BY return_flag"
)
CHECKS["fn_datepart"] = _union(
    lambda u: f"return_flag, CAST(sum(date_part('{u}', ship_date)) AS DOUBLE) AS total"
    " FROM sales_lines GROUP BY return_flag"
)
CHECKS = {k: check(v) for k, v in CHECKS.items()}
