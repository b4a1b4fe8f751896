"""Profiles of a table's columns, each in one pass whatever the number of columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .mapping import widened


def one_row_per_column(df: DataFrame, per_column: dict[str, dict[str, Column]]) -> DataFrame:
    """Aggregate every column at once, then turn the single row into one row per column."""
    packed = df.agg(*[
        F.struct(*[expr.alias(field) for field, expr in fields.items()]).alias(f"s{i}")
        for i, fields in enumerate(per_column.values())
    ])
    rows = F.explode(F.array(*[
        F.struct(F.lit(name).alias("column_name"), F.col(f"s{i}").alias("s")) for i, name in enumerate(per_column)
    ]))
    return packed.select(rows.alias("r")).select("r.column_name", "r.s.*")


def _named(df: DataFrame, columns: Sequence[str] | None, kinds: tuple[type, ...]) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, kinds) and (columns is None or f.name in columns)]


def text_widths(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``column_name, max_length, width`` of the text columns (characters, not bytes)."""
    names = _named(df, columns, (T.StringType, T.VarcharType, T.CharType))
    if not names:
        return df.sparkSession.createDataFrame([], "column_name string, max_length int, width int")
    longest = one_row_per_column(df, {
        c: {"max_length": F.coalesce(F.max(F.length(F.col(f"`{c}`"))), F.lit(0))} for c in names})
    return longest.withColumn("width", widened(F.col("max_length")))


def number_widths(df: DataFrame, columns: Sequence[str] | None = None, digits: int = 10) -> DataFrame:
    """``column_name, avg_length, min_value, max_value, max_scale, inexact`` of the numeric columns.

    Values are compared exactly; doubles as decimals with ``digits`` places. ``inexact`` counts
    the values that are not such a decimal (too large, too small, not finite). They are in no
    other figure but the length.
    """
    names = _named(df, columns, (T.NumericType,))
    if not names:
        return df.sparkSession.createDataFrame([], "column_name string, avg_length double, min_value decimal(38,0), "
                                                   "max_value decimal(38,0), max_scale int, inexact bigint")
    kinds = [df.schema[c].dataType for c in names]
    places = max([k.scale if isinstance(k, T.DecimalType) else 0 if isinstance(k, T.IntegralType) else digits
                  for k in kinds], default=0)

    # Texts and places are found once for each value, in a projection that the aggregates share.
    shown, per_column = [], {}
    for i, (c, kind) in enumerate(zip(names, kinds, strict=True)):
        value, text = F.col(f"`{c}`"), F.col(f"`{c}`").cast("string")
        shown += [value.alias(f"v{i}"), F.octet_length(text).alias(f"n{i}")]
        if isinstance(kind, T.IntegralType):
            exact, scale, inexact = F.col(f"v{i}"), F.lit(0), F.lit(0).cast("bigint")
        else:
            shown.append(_places(value, kind, text, digits).alias(f"p{i}"))
            exact, scale = F.when(F.col(f"p{i}").isNotNull(), F.col(f"v{i}")), F.coalesce(F.max(f"p{i}"), F.lit(0))
            inexact = F.count_if(F.col(f"v{i}").isNotNull() & F.col(f"p{i}").isNull())
        ends = kind if isinstance(kind, (T.IntegralType, T.DecimalType)) else T.DecimalType(38, digits)
        per_column[c] = {
            "avg_length": F.round(F.avg(f"n{i}"), 4),
            "min_value": F.min(exact).try_cast(ends).try_cast(f"decimal(38,{places})"),
            "max_value": F.max(exact).try_cast(ends).try_cast(f"decimal(38,{places})"),
            "max_scale": scale,
            "inexact": inexact,
        }
    return one_row_per_column(df.select(*shown), per_column)


def _places(value: Column, kind: T.DataType, text: Column, digits: int) -> Column:
    """Places behind the point of each value as a decimal, null for one that is no decimal with ``digits`` places."""
    def behind(shown: Column) -> Column:
        return F.length(F.rtrim(F.split_part(shown, F.lit("."), F.lit(2)), F.lit("0")))

    if isinstance(kind, T.DecimalType):
        return F.when(F.abs(value) >= 0, behind(text) if kind.scale else F.lit(0))
    near = value.try_cast(f"decimal(38,{digits})")
    slow = F.when(near.cast(kind) == value, behind(near.cast("string")))
    if not isinstance(kind, T.DoubleType):
        return slow
    # A double's own text, if it has no exponent and few places, is that decimal: nearly all end here.
    tail = F.length(text) - F.instr(text, ".")
    plain = (F.instr(text, "E") == 0) & (F.instr(text, ".") > 0) & (tail <= digits)
    return F.when(plain, F.when(text.endswith(".0"), 0).otherwise(tail)).otherwise(slow)
