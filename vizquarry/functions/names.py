"""Name rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from vizquarry import fixed


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def quoted(name: str) -> str:
    """A column name as SQL text, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def sanitize(c: Column | str) -> Column:
    """Identifier form: every other character than letters, digits and ``_`` becomes ``_``."""
    clean = F.lower(F.btrim(F.regexp_replace(_col(c), r"[^\p{L}\p{N}_]", "_"), F.lit("_")))
    return F.when(clean == "", F.lit(fixed.UNNAMED_TABLE)).otherwise(clean)


def norm(c: Column | str) -> Column:
    """Matching form: ASCII letters and digits, runs of anything else as one ``_``."""
    return F.btrim(F.regexp_replace(F.lower(_col(c)), r"[^0-9a-z]+", "_"), F.lit("_"))


def short_name(c: Column | str) -> Column:
    return F.substring_index(_col(c), ".", -1)


def slug(c: Column | str) -> Column:
    """View name part: like ``norm``, never empty, never starting with a digit."""
    base = norm(c)
    base = F.when(base == "", F.lit("calc")).otherwise(base)
    return F.when(base.rlike("^[0-9]"), F.concat(F.lit("_"), base)).otherwise(base)


def slug_suffix(c: Column | str) -> Column:
    """Last six letters or digits of an id."""
    return F.regexp_extract(F.regexp_replace(F.lower(_col(c)), r"[^0-9a-z]+", ""), ".{0,6}$", 0)


def quote_column(c: Column | str) -> Column:
    """Plain identifiers as they are, anything else between backticks."""
    c = _col(c)
    quoted = F.concat(F.lit("`"), F.replace(c, F.lit("`"), F.lit("``")), F.lit("`"))
    return F.when(c.rlike(r"\A(?U)[A-Za-z_]\w*\z"), c).otherwise(quoted)


def strip_brackets(c: Column | str) -> Column:
    return F.btrim(_col(c), F.lit("[]"))


def blank_to_null(c: Column | str) -> Column:
    """Attributes that are present but empty count as absent."""
    return F.nullif(_col(c), F.lit(""))
