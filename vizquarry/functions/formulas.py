"""Formula text rules as column expressions; all run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from vizquarry import fixed


BLOCK_COMMENT = r"(?s)/\*.*?\*/"
LINE_BREAK = r"\r\n|[\r\x0B\x0C\x1C-\x1E\x{85}\x{2028}\x{2029}]"
#: What precedes a comment of a line, as group 1, and the comment.
LINE_COMMENT = r"""(?m)^((?:"[^"\n]*"|'[^'\n]*'|[^"'/\n]|/(?!/))*+)//[^\n]*"""
#: Literals and quoted names of SQL text, in which a call isn't one.
SQL_LITERAL = r"(?s)'(?:[^'\\]|\\.)*'|`[^`]*`"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_comments(c: Column | str) -> Column:
    """Drop ``/* */`` anywhere and ``//`` up to the line end unless it stands inside quotes.

    The possessive loop walks a line piece by piece and halts at the first ``//`` outside quotes or at
    a quote that the line does not close; in the second case nothing is cut. Each pattern runs only on
    texts that hold what it looks for.
    """
    text = _col(c)
    text = F.when(text.contains("/*"), F.regexp_replace(text, BLOCK_COMMENT, "")).otherwise(text)
    text = F.when(text.rlike(LINE_BREAK), F.regexp_replace(text, LINE_BREAK, "\n")).otherwise(text)
    text = F.when(text.contains("//"), F.regexp_replace(text, LINE_COMMENT, "$1")).otherwise(text)
    return F.btrim(text, F.lit(fixed.BLANK_CHARACTERS))


def formula_key(c: Column | str) -> Column:
    """Runs of blanks as one space, ends trimmed."""
    return F.trim(F.regexp_replace(_col(c), fixed.BLANK + "+", " "))


def blank_literals(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), "(?s)" + fixed.STRING_LITERAL, "''")


def raw_refs(c: Column | str) -> Column:
    """Distinct ``[x]`` tokens of the raw text, in order."""
    return F.array_distinct(F.regexp_extract_all(_col(c), F.lit(fixed.FIELD_TOKEN), F.lit(1)))


def field_refs(c: Column | str) -> Column:
    """Distinct ``[x]`` tokens outside string literals, blanks collapsed, in order."""
    return F.array_distinct(
        F.transform(
            F.regexp_extract_all(blank_literals(c), F.lit(fixed.FIELD_TOKEN), F.lit(1)), formula_key
        )
    )


def has_lod(c: Column | str) -> Column:
    return _col(c).contains("{") & _col(c).rlike("(?i)" + fixed.LOD_PATTERN)


def has_table_calc(c: Column | str) -> Column:
    return _col(c).rlike("(?i)" + fixed.TABLE_CALC_PATTERN)


def refusal(c: Column | str) -> Column:
    """Label of the first reason to refuse a formula, null when there is none."""
    plain = blank_literals(c)
    first_pattern, first_label = fixed.REFUSALS[0]
    chain = F.when(plain.rlike("(?i)" + first_pattern), F.lit(first_label))
    for pattern, label in fixed.REFUSALS[1:]:
        chain = chain.when(plain.rlike("(?i)" + pattern), F.lit(label))
    return chain


def kind(c: Column | str) -> Column:
    """``measure`` when the SQL text calls an aggregate outside literals, else ``dimension``."""
    plain = F.regexp_replace(_col(c), SQL_LITERAL, "''")
    return F.when(plain.rlike("(?i)" + fixed.AGGREGATE_PATTERN), F.lit("measure")).otherwise(
        F.lit("dimension")
    )
