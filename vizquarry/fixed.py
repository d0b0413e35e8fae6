"""Word lists, patterns, weights, labels and text formats that decide results.

They are stated once, here, so that every operator and every check reads the same ones.
"""

# ---- formula patterns -------------------------------------------------------------------------

FIELD_TOKEN = r"\[([^\]]+)\]"
STRING_LITERAL = r"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*\""""
# Unicode blanks, including the four separators that Java's \s leaves out.
BLANK = r"[\s\x1C-\x1F\x{85}\x{A0}\x{2000}-\x{200A}\x{2028}\x{2029}\x{3000}]"
BLANK_CHARACTERS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009"
    "\u200a\u2028\u2029\u3000"
)

LOD_PATTERN = r"\{\s*(FIXED|INCLUDE|EXCLUDE)\b"
TABLE_CALC_PATTERN = (
    r"\b(WINDOW_(SUM|AVG|MAX|MIN|MEDIAN|COUNT|STDEV|STDEVP|VAR|VARP)"
    r"|RUNNING_(SUM|AVG|MAX|MIN|COUNT)"
    r"|RANK_?(DENSE|MODIFIED|UNIQUE)?"
    r"|INDEX|FIRST|LAST|LOOKUP|TOTAL|PREVIOUS_VALUE)\s*\("
)

# Formulas the translator refuses, first match wins.
REFUSALS = [
    (r"\{", "LOD expression (FIXED/INCLUDE/EXCLUDE)"),
    (
        r"\b(WINDOW_\w+|RUNNING_\w+|LOOKUP|PREVIOUS_VALUE|INDEX|SIZE|FIRST|LAST|TOTAL|RANK\w*)\s*\(",
        "table calculation",
    ),
    (r"\b(SCRIPT_\w+|RAWSQL\w*|MODEL_\w+)\s*\(", "external / raw SQL function"),
    (r"\[Parameters\]\s*\.", "Tableau parameter reference"),
    (r"\bDATEPARSE\s*\(", "DATEPARSE (format strings differ)"),
]

AGGREGATE_PATTERN = (
    r"\b(SUM|AVG|COUNT|MIN|MAX|MEDIAN|STDDEV_SAMP|STDDEV_POP|VAR_SAMP|VAR_POP|PERCENTILE"
    r"|COLLECT_LIST|COLLECT_SET|CORR|COVAR_\w+|ANY_VALUE|APPROX_\w+|MEASURE)\s*\("
)

# ---- calculation language to SQL -----------------------------------------------------------------

DATE_UNITS = ["YEAR", "QUARTER", "MONTH", "WEEK", "DAY", "HOUR", "MINUTE", "SECOND"]

# name: (fewest arguments, SQL form). {0} {1} {2} are arguments, {all} every argument, {first3} at
# most three, {unit} the first argument read as a date unit.
CALL_FORMS = {
    "ZN": (1, "COALESCE({0}, 0)"),
    "IFNULL": (2, "COALESCE({0}, {1})"),
    "ISNULL": (1, "({0} IS NULL)"),
    "IIF": (0, "IF({first3})"),
    "COUNTD": (1, "COUNT(DISTINCT {0})"),
    "ATTR": (1, "MIN({0})"),
    "STDEVP": (1, "STDDEV_POP({0})"),
    "STDEV": (1, "STDDEV_SAMP({0})"),
    "VARP": (1, "VAR_POP({0})"),
    "VAR": (1, "VAR_SAMP({0})"),
    "LEN": (1, "LENGTH({0})"),
    "MID": (0, "SUBSTRING({all})"),
    "FIND": (2, "INSTR({0}, {1})"),
    "STR": (1, "CAST({0} AS STRING)"),
    "FLOAT": (1, "CAST({0} AS DOUBLE)"),
    "INT": (1, "CAST({0} AS INT)"),
    "DATETRUNC": (2, "DATE_TRUNC('{unit}', {1})"),
    "DATEDIFF": (3, "DATEDIFF({unit}, {1}, {2})"),
    "DATEADD": (3, "DATEADD({unit}, {1}, {2})"),
    "DATEPART": (2, "EXTRACT({unit} FROM {1})"),
    "TODAY": (0, "CURRENT_DATE()"),
    "NOW": (0, "CURRENT_TIMESTAMP()"),
    "MAX": (1, "MAX({0})"),
    "MIN": (1, "MIN({0})"),
}
# The same names with two or more arguments.
ROW_WISE_FORMS = {"MAX": "GREATEST({all})", "MIN": "LEAST({all})"}
KEYWORD_FORMS = {"ELSEIF": "WHEN", "IF": "CASE WHEN"}

SQL_PRODUCT = "Spark SQL"
NOTE_ATTR = "ATTR() approximated with MIN()"
NOTE_STRING_PLUS = "string concatenation with '+' - consider CONCAT()"
NOTE_CARET = f"'^' is XOR in {SQL_PRODUCT} - use POWER() if exponent was intended"
NOTE_REFUSED = "unsupported: %s"
NOTE_CALL_FAILED = "could not translate function call (%s)"
NOTE_NOT_FOUND = "column [%s] not found in any source table"
NOTE_JOINED = (
    "joined %s as '%s' on %s (inferred from shared column names; verify it is many-to-one)"
)
FATAL_NO_TABLE = "no candidate table with known columns"
FATAL_NO_KEYS = "[%s] is in %s, which shares no column with %s to join on"

# ---- metric view definitions ------------------------------------------------------------------------

VIEW_PREFIX = "mv_"
DEFINITION_VERSION = "1.1"
DEFINITION_COMMENT = "Tableau calculated field '%s' (%s). Original formula: %s"
DEFINITION_DDL = "CREATE OR REPLACE VIEW %s WITH METRICS LANGUAGE YAML AS\n$$\n%s\n$$"
JOIN_KEY_PATTERN = r"(^|_)(id|key)$"

# ---- workbook XML ----------------------------------------------------------------------------------

PARAMETER_SOURCE = "Parameters"
CALCULATION_CLASS = "tableau"
WORKBOOK_SUFFIX = ".twb"
EXTRACT_SUFFIX = ".hyper"

# ---- scoring ----------------------------------------------------------------------------------------

CATEGORIES = ["data_model", "calculations", "structure", "interactivity"]
CATEGORY_WEIGHTS = {"data_model": 0.15, "calculations": 0.40, "structure": 0.20, "interactivity": 0.25}
CATEGORY_CEILINGS = {"data_model": 15, "calculations": 60, "structure": 40, "interactivity": 30}
CATEGORY_INPUTS = {
    "data_model": {"num_datasources": 1, "num_joins": 1, "num_custom_sql": 1},
    "calculations": {"num_calc_fields": 1, "num_lod_expressions": 3, "num_table_calcs": 3},
    "structure": {"num_sheets": 1, "num_dashboards": 1, "max_container_nesting_depth": 2},
    "interactivity": {"num_filters": 1, "num_parameters": 1, "num_param_actions_feeding_calc": 3},
}
LOG_SCALE = 10.0
TIERS = ["Simple", "Moderate", "Complex", "Very Complex"]
TIER_LIMITS = [25, 50, 75]
HIGHEST_TIER_TO_PROCEED = "Complex"
# metric, threshold it must exceed, tier it forces at least, label
OVERRIDES = [
    ("max_calc_nesting_depth", 5, "Very Complex", "calc nesting depth > 5"),
    ("num_param_actions_feeding_calc", 0, "Complex", "parameter action feeds a calculated field"),
]
FEATURE_STORY = "Story Points"
FEATURE_EXTENSION = "Dashboard Extensions (custom JS objects)"
FEATURE_DYNAMIC_ZONE = "Dynamic Zone Visibility (DZV)"
FEATURE_SET_ACTION = "Set Actions"

REASON_FEATURES = "no-equivalent feature(s) detected: %s"
REASON_OVERRIDES = "override flag(s) triggered: %s"
REASON_TIER = "complexity tier is %s"
REASON_NONE = "no overrides, no no-equivalent features, tier <= Complex"

NO_TABLE_PATHS = (
    "`%s`.`%s`.*  -- (exact table names unavailable: no .hyper file found or tableauhyperapi not installed)"
)
# The product the dashboards move to is the caller's choice, so it is a slot of the format.
AUTHORING_LINE = (
    "Rebuild the Tableau dashboard '%s' (conversion complexity: %s) as a {product} dashboard"
    " using data from: %s. Source workbook has %d sheet(s) and %d dashboard(s) with %d filter(s)"
    " and %d parameter(s). Calculated fields to reimplement as SQL: %s. Tableau features with no"
    " direct {vendor} equivalent (will need a workaround or feature drop): %s."
)

UNNAMED_TABLE = "unnamed_table"
