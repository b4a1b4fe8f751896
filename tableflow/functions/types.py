"""Column expressions that map source column types and defaults to a target.

Each function works on the columns of a catalogue (``sources.catalogue.CATALOGUE_DDL``)
whose missing statistics are -1 (``operators.mapping.normalise_stats``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The kind of each source type; a type not listed is of kind "other".
KINDS = {
    "VARCHAR2": "text", "NVARCHAR2": "text", "UROWID": "address", "CHAR": "char", "NCHAR": "char",
    "DATE": "time", "TIMESTAMP(6)": "time", "TIMESTAMP(0)": "time", "NUMBER": "number",
    "FLOAT": "real", "BINARY_FLOAT": "real", "BINARY_DOUBLE": "real",
    "CLOB": "clob", "NCLOB": "clob", "LONG": "clob", "BLOB": "blob", "RAW": "blob", "LONG RAW": "blob",
}
VARIABLE_TEXT = ("VARCHAR2", "NVARCHAR2")
SHORT_TEXT = ("text", "char", "address")

# Limits of the mapping rules.
WIDE_TEXT = 10_000
LONG_NUMBER = 6
NO_STATISTIC = -1
# Default expressions that name a function of the source.
SOURCE_FUNCTIONS = ("SYSDATE", "SYS_GUID", "USER")

_INT_LIMIT = "2147483647"
_BIGINT_LIMIT = "9223372036854775807"

# The rule of the kinds that have just one.
PLAIN_RULES = {"text": "varchar", "address": "varchar", "char": "char", "time": "datetime", "clob": "longtext",
               "blob": "longblob"}
# Target and Spark type of each rule; arguments are added to some of them.
TARGET_NAME = {
    "varchar": "VARCHAR", "tinytext": "TINYTEXT", "char": "CHAR", "datetime": "DATETIME", "int": "INT",
    "bigint": "BIGINT", "decimal": "DECIMAL", "fraction": "DECIMAL", "large": "DECIMAL",
    "number_fallback": "DECIMAL", "longtext": "LONGTEXT", "longblob": "LONGBLOB", "double": "DOUBLE",
}
SPARK_NAME = {
    "varchar": "string", "tinytext": "string", "char": "string", "datetime": "timestamp_ntz", "int": "int",
    "bigint": "bigint", "decimal": "decimal", "fraction": "decimal", "large": "decimal",
    "number_fallback": "decimal", "longtext": "string", "longblob": "binary", "double": "double",
}
WITH_LENGTH = ("varchar", "char")
WITH_DIGITS = ("decimal", "fraction", "large", "number_fallback")


def _looked_up(names: dict[str, str], key: Column) -> Column:
    at = F.array_position(F.lit(list(names)), key).cast("int") - 1
    return F.get(F.lit(list(names.values())), at)


def source_kind() -> Column:
    """Kind of the source type, looked up once; times of any other precision are "fraction"."""
    kind = F.col("data_type")
    other = F.when(kind.rlike(r"^TIMESTAMP\(\d+\)$"), "fraction").otherwise("other")
    return F.coalesce(_looked_up(KINDS, kind), other)


def _whole_number() -> Column:
    p, s = F.col("data_precision"), F.col("data_scale")
    return ((p > 0) & (s == 0)) | ((p == NO_STATISTIC) & s.isin(NO_STATISTIC, 0))


def _number_rule(compat: bool, profiled: bool) -> Column:
    """Rule of a ``NUMBER``.

    The plain rules (``compat``) take a short or unknown average length for an integer of
    32 bits and drop what no rule covers. Otherwise a number without statistics becomes
    64 bits, and a profile keeps every value in range.
    """
    p, s, stored = F.col("data_precision"), F.col("data_scale"), F.col("avg_col_len")
    decimal = F.when((p > 0) & (s > 0), "decimal")
    if compat:
        integer = F.when(stored >= LONG_NUMBER, "bigint").otherwise("int")
        return decimal.when(_whole_number(), integer).otherwise("dropped")
    short = (stored >= 0) & (stored < LONG_NUMBER)
    integer = F.when(short, "int").otherwise("bigint")
    if profiled:
        def beyond(limit: str) -> Column:
            widest = F.greatest(F.abs("min_value"), F.abs("max_value"))
            return F.coalesce(widest > F.lit(limit).cast("decimal(38,0)"), F.lit(False))

        integer = (F.when((p == NO_STATISTIC) & (F.col("max_scale") > 0), "fraction")
                   .when(beyond(_BIGINT_LIMIT), "large")
                   .when(short & ~beyond(_INT_LIMIT), "int").otherwise("bigint"))
    return decimal.when(_whole_number(), integer).otherwise("number_fallback")


def type_rule(compat: bool, profiled: bool) -> Column:
    """Name of the mapping rule of a column."""
    kind = F.col("_kind")
    rule = F.when(kind == "number", _number_rule(compat, profiled))
    if compat:
        rule = rule.when((kind == "text") & (F.col("char_length") >= WIDE_TEXT), "tinytext")
    else:
        rule = rule.when(kind == "real", "double").when(kind == "fraction", "datetime")
    return rule.otherwise(F.coalesce(_looked_up(PLAIN_RULES, kind), F.lit("unmapped")))


def digits(compat: bool, profiled: bool) -> Column:
    """``precision,scale`` of a decimal target, null for other rules."""
    rule, p, s = F.col("rule"), F.col("data_precision"), F.col("data_scale")
    wide, whole = F.lit(38), F.lit(0)
    precision = F.when(rule == "decimal", p if compat else F.greatest(p, s))
    scale = F.when(rule == "decimal", s)
    if profiled:
        precision = precision.when((rule == "large") & (p > 0), p)
        scale = scale.when(rule == "fraction", F.col("max_scale")).when(rule == "large", whole)
    text = F.concat(precision.otherwise(wide).cast("string"), F.lit(","),
                    scale.otherwise(F.greatest(s, whole)).cast("string"))
    return F.when(rule.isin(*WITH_DIGITS), text)


def spark_type() -> Column:
    """Spark type of the rule; null where the rule gives none."""
    return F.concat(_looked_up(SPARK_NAME, F.col("rule")), _in_brackets(F.col("digits")))


def target_type() -> Column:
    """Target type of the rule; an unlisted source type keeps its name and length."""
    rule = F.col("rule")
    length = F.when(rule.isin(*WITH_LENGTH, "unmapped"), F.col("char_length").cast("string"))
    name = F.when(rule == "unmapped", F.col("data_type")).otherwise(_looked_up(TARGET_NAME, rule))
    return F.concat(name, _in_brackets(F.coalesce(length, F.col("digits"))))


def _in_brackets(text: Column) -> Column:
    return F.coalesce(F.concat(F.lit("("), text, F.lit(")")), F.lit(""))


def max_length() -> Column:
    return F.when(F.col("rule").isin(*WITH_LENGTH, "tinytext"), F.col("char_length"))


def bare_default(default: Column) -> Column:
    """A default without the brackets and blanks around it; quoted text stays as it is."""
    inside = r"^[\s(]*('(?:[^']|'')*'|[^()']+(?:\(\))?)[\s)]*$"
    # What the pattern does not cover stays whole: it always takes at least one character.
    return F.trim(F.coalesce(F.nullif(F.regexp_extract(default, inside, 1), F.lit("")), default))


def constant_default(bare: Column, named: Column) -> Column:
    """Default of the target column: constants are kept, calls and ``NULL`` are dropped.

    Empty for a number default without a number. ``bare`` comes from ``bare_default``; ``named`` is it in upper case without an empty
    argument list.
    """
    kind = F.col("_kind")
    number = F.regexp_extract(bare, r"(?:^|[^\w.])(-?(?:\d+(?:\.\d+)?|\.\d+))(?:$|[^\w.])", 1)
    return (
        F.when(bare.isNull() | named.isin("NULL", "") | kind.isin("clob", "blob"), None)
        .when(kind.isin(*SHORT_TEXT), F.when(~named.isin(*SOURCE_FUNCTIONS), bare))
        .when(kind.isin("number", "real"), number)
        .when(kind.isin("time", "fraction"), F.when(named == "SYSDATE", "current_timestamp()"))
        .otherwise(bare)
    )


def compat_default() -> Column:
    """Default as the plain rules give it; an empty text means no default."""
    kind, default = F.col("_kind"), F.col("data_default")
    squeezed = F.translate(F.upper(default), " ()", "")
    whole = (
        F.when(default.isNull() | F.upper(default).startswith("NULL"), default)
        .when(default.isin("''", ""), "")
        .otherwise(F.regexp_extract(default, r"\b\d+\b", 0))
    )
    return (
        F.when((kind == "text") & (F.col("char_length") >= WIDE_TEXT), "null")
        .when(kind.isin(*SHORT_TEXT), F.when(squeezed.isin(*SOURCE_FUNCTIONS), "").otherwise(squeezed))
        .when(kind == "time", F.when(default.isin("sysdate", "( (SYSDATE) )"), "current_timestamp()").otherwise(""))
        .when((kind == "number") & _whole_number(), whole)
        .when(kind.isin("clob", "blob"), "")
        .otherwise(default)
    )


def breaks_table() -> Column:
    """A default of a whole number that holds no digits; the plain rules then lose the table."""
    default = F.col("data_default")
    takes_digits = ~(default.isNull() | F.upper(default).startswith("NULL") | default.isin("''", ""))
    whole = (F.col("data_type") == "NUMBER") & _whole_number()
    return F.coalesce(whole & takes_digits & ~default.rlike(r"\b\d+\b"), F.lit(False))
