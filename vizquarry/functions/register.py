"""Formula helpers as SQL functions of the session."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import SparkSession, functions as F, types as T

from vizquarry import fixed
from vizquarry.functions import formulas
from vizquarry.functions.translate import expression


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _replaced(text: str, pattern: str, by: str) -> str:
    return f"regexp_replace({text}, {_literal(pattern)}, {_literal(by)})"


@F.pandas_udf(T.StringType())
def _rendered(texts: pd.Series, columns: pd.Series) -> pd.Series:
    # Equal pairs of a batch are rendered once; maps are mostly the same for all of it.
    pairs, maps, done = list(zip(texts, columns)), {}, {}
    for f, m in dict.fromkeys(pairs):
        if m not in maps:
            maps[m] = json.loads(m) if m else {}
        done[f, m] = None if f is None else expression(f, maps[m])
    return pd.Series([done[p] for p in pairs], dtype=object)


def register_functions(spark: SparkSession) -> list[str]:
    """``formula_text``, ``formula_to_sql``, ``formula_refusal`` and ``formula_kind`` for SQL over a calc table.

    ``formula_text`` is a formula without its comments; the others start from it. ``formula_to_sql`` takes a map of
    references to columns as an optional second argument. ``formula_kind`` is about the SQL text, and null without one.
    """
    spark.udf.register("formula_rendered", _rendered)
    text = _replaced(_replaced(_replaced("f", formulas.BLOCK_COMMENT, ""), formulas.LINE_BREAK, "\n"), formulas.LINE_COMMENT, "$1")
    plain = _replaced("formula_text(f)", "(?s)" + fixed.STRING_LITERAL, "''")
    cases = " ".join(f"WHEN {plain} RLIKE {_literal('(?i)' + p)} THEN {_literal(label)}" for p, label in fixed.REFUSALS)
    measure = f"{_replaced('f', formulas.SQL_LITERAL, chr(39) * 2)} RLIKE {_literal('(?i)' + fixed.AGGREGATE_PATTERN)}"
    bodies = {
        "formula_text(f STRING)": f"btrim({text}, {_literal(fixed.BLANK_CHARACTERS)})",
        "formula_to_sql(f STRING, columns MAP<STRING, STRING> DEFAULT NULL)": "formula_rendered(formula_text(f), to_json(columns))",
        "formula_refusal(f STRING)": f"CASE {cases} END",
        "formula_kind(f STRING)": f"CASE WHEN f IS NULL THEN NULL WHEN {measure} THEN 'measure' ELSE 'dimension' END",
    }
    for head, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURNS STRING RETURN {body}")
    return [head.split("(")[0] for head in bodies]
