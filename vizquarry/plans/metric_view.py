"""Metric views that can be queried: a source plan with an expression, evaluated by Spark."""

from __future__ import annotations

import re
import threading
from dataclasses import dataclass, field
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from vizquarry.functions.names import quoted
from vizquarry.plans.views import build_views
from vizquarry.sources.catalog import column_catalog


#: Which keys of a table are known to be unique, as long as its frame lives.
_UNIQUE: WeakKeyDictionary[DataFrame, dict[tuple, bool]] = WeakKeyDictionary()
_CHECKING = threading.Lock()


@dataclass
class MetricView:
    """``tables`` maps table names to frames; the rest is one row of ``build_views``."""

    slug: str
    kind: str
    expr: str
    base: str
    joins: list = field(default_factory=list)
    colmap: list = field(default_factory=list)
    tables: dict[str, DataFrame] = field(default_factory=dict)

    @staticmethod
    def of(row: Row, tables: dict[str, DataFrame]) -> "MetricView":
        if row.expr is None:
            raise ValueError("; ".join(row.notes))
        return MetricView(
            row.slug, row.kind, row.eval_expr, row.source_table, row.joins, row.colmap, tables
        )

    def source(self) -> DataFrame:
        """The base table with its joined tables, each as one struct column named by its alias.

        Bare names then mean the base table and ``alias.column`` the joined one, whatever columns the
        two share. Only join keys and mapped columns of a joined table are read. The join is a left
        join; no side is hinted, so Spark broadcasts where statistics allow it. A joined table whose keys
        repeat would count base rows several times, so it is refused with a ValueError.
        """
        df = self.tables[self.base]
        for j in self.joins:
            self._require_unique(j)
            prefix = j["name"] + "."
            used = sorted({_bare(m["sql"][len(prefix):]) for m in self.colmap if m["sql"].startswith(prefix)})
            keys = [(_bare(k["base_column"]), _bare(k["column"])) for k in j["keys"]]
            renamed = {theirs: f"__{j['name']}_{theirs}" for _, theirs in keys}
            side = self.tables[j["source"]].select(
                *[F.col(quoted(k)).alias(v) for k, v in renamed.items()],
                F.struct(*[F.col(quoted(c)) for c in used]).alias(j["name"]),
            )
            condition = [df[quoted(ours)] == side[quoted(renamed[theirs])] for ours, theirs in keys]
            df = df.join(side, condition, "left").drop(*renamed.values())
        return df

    def select(self, *dims, measures: dict[str, str] | None = None) -> DataFrame:
        """The view grouped by ``dims`` (column names or Columns; any source column may be one).

        A measure view aggregates its expression. A dimension view groups by it and counts records.
        ``measures`` adds further named aggregates; they may use ``MEASURE(slug)``.
        """
        df = self.source()
        keys = [F.col(d) if isinstance(d, str) else d for d in dims]
        named = {self.slug: self.expr} if self.kind == "measure" else {"record_count": "COUNT(1)"}
        for name, expr in (measures or {}).items():
            named[name] = resolve_measures(expr, named)
        if self.kind == "dimension":
            keys.append(F.expr(self.expr).alias(self.slug))
        aggregates = [F.expr(e).alias(n) for n, e in named.items()]
        return df.groupBy(*keys).agg(*aggregates) if keys else df.agg(*aggregates)

    def rows(self, *columns) -> DataFrame:
        """A dimension view per source row, beside the given source columns."""
        if self.kind != "dimension":
            raise ValueError(f"{self.slug} aggregates; use select()")
        return self.source().select(*columns, F.expr(self.expr).alias(self.slug))

    def _require_unique(self, join) -> None:
        """Check once per table and keys that the join is many-to-one."""
        keys = tuple(_bare(k["column"]) for k in join["keys"])
        table = self.tables[join["source"]]
        with _CHECKING:  # sets of definitions are tried beside each other; one of them looks
            known = _UNIQUE.setdefault(table, {})
            if keys not in known:
                found = duplicate_keys(table.dropna(subset=[quoted(k) for k in keys]), [quoted(k) for k in keys])
                known[keys] = found.isEmpty()
        if not known[keys]:
            raise ValueError(f"{join['source']} has repeated keys ({', '.join(keys)}): the join is not many-to-one")

    def duplicate_keys(self) -> dict[str, DataFrame]:
        """Per joined table, the keys with more than one row: there the join is not many-to-one."""
        return {
            j["name"]: duplicate_keys(
                self.tables[j["source"]], [_bare(k["column"]) for k in j["keys"]]
            )
            for j in self.joins
        }


def _bare(sql: str) -> str:
    return sql[1:-1].replace("``", "`") if sql.startswith("`") else sql


def duplicate_keys(table: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once, with their number of rows."""
    return table.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")


def resolve_measures(expr: str, named: dict[str, str]) -> str:
    """Put the expression of another measure in place of ``MEASURE(name)``."""
    return re.sub(
        r"(?i)\bMEASURE\s*\(\s*`?(\w+)`?\s*\)",
        lambda m: f"({named[m.group(1)]})" if m.group(1) in named else m.group(0),
        expr,
    )


def metric_views(
    spark: SparkSession, formulas: dict[str, str], tables: dict[str, DataFrame], hints: list[str] | None = None
) -> dict[str, MetricView]:
    """Views for a handful of named formulas over the given tables."""
    planned = plan_formulas(spark, formulas, tables, hints).collect()
    return {r.name: MetricView.of(r, tables) for r in planned}


def plan_formulas(
    spark: SparkSession, formulas: dict[str, str], tables: dict[str, DataFrame], hints: list[str] | None = None
) -> DataFrame:
    rows = [(0, i, n, n, f, f, hints or [], "all") for i, (n, f) in enumerate(formulas.items())]
    calcs = spark.createDataFrame(
        rows,
        "workbook_id int, ord int, name string, calc_id string, formula string, formula_inlined string,"
        " datasources array<string>, source_set string",
    )
    return build_views(calcs, column_catalog(spark, tables))
