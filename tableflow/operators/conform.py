"""Bring rows to a target schema, keeping the ones that do not fit with a reason."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.rounding import to_second
from .mapping import ColumnRule

REASON = "reject_reason"


def _converted(value: Column, rule: ColumnRule, source: T.DataType, whole_seconds: bool) -> Column:
    if rule.spark_type is None:
        return value
    if whole_seconds and rule.spark_type.startswith("timestamp"):
        if not isinstance(source, (T.TimestampType, T.TimestampNTZType)):
            value = value.try_cast(rule.spark_type)
        return to_second(value).try_cast(rule.spark_type)
    return value.try_cast(rule.spark_type)


def _scale_lost(value: Column, result: Column, rule: ColumnRule, source: T.DataType, exact: bool) -> Column | None:
    """Whether the result stands for another number than the value; ``None`` where it cannot."""
    if not isinstance(source, (T.NumericType, T.StringType)) or rule.spark_type is None:
        return None
    whole = rule.spark_type in ("tinyint", "smallint", "int", "bigint")
    if not whole and not (exact and rule.spark_type.startswith("decimal")):
        return None
    if isinstance(source, T.IntegralType) and whole:
        return None
    if isinstance(source, T.StringType):  # digits behind the point that the target has no place for
        places = T.DataType.fromDDL(rule.spark_type).scale if rule.spark_type.startswith("decimal") else 0
        digits = F.rtrim(F.split_part(value, F.lit("."), F.lit(2)), F.lit(" 0"))
        return F.length(digits) > places
    back = result.try_cast(source)
    return result.isNotNull() & (back.isNull() | (back != value))


def flag(df: DataFrame, rules: Sequence[ColumnRule], keep: Sequence[str] = (), exact_scale: bool = False,
         empty_as_null: bool = False, whole_seconds: bool = True) -> DataFrame:
    """Converted columns plus ``reject_reason``, null for a row that fits.

    A reason lists every failed check as ``COLUMN:check`` with the checks ``type`` (the
    value has no counterpart), ``scale`` (digits would be lost: always for whole numbers,
    with ``exact_scale`` for decimals too), ``length`` and ``null``. Columns in ``keep`` are
    carried along unchecked; one that is neither there nor in a rule is an error. Names
    match in any case and come out as the rules spell them.
    """
    converted, checks = [], []
    named = {f.name.upper(): f for f in df.schema}
    unruled = set(named) - {r.name.upper() for r in rules} - {c.upper() for c in keep}
    if unruled:
        raise ValueError(f"columns without a rule: {', '.join(sorted(unruled))}")
    for rule in rules:
        source = named[rule.name.upper()].dataType
        value = F.col(f"`{named[rule.name.upper()].name}`")
        if empty_as_null and isinstance(source, T.StringType):
            value = F.nullif(value, F.lit(""))
        result = _converted(value, rule, source, whole_seconds)
        note = {"metadata": {"comment": rule.comment.replace('"', "")}} if rule.comment else {}
        converted.append(result.alias(rule.name, **note))

        def failed(check: str, condition: Column, name: str = rule.name) -> Column:
            return F.when(condition, F.lit(f"{name}:{check}"))

        # A column that already has the target type needs no type check.
        if rule.spark_type is not None and source.simpleString() != rule.spark_type:
            checks.append(failed("type", value.isNotNull() & result.isNull()))
        lost = _scale_lost(value, result, rule, source, exact_scale)
        if lost is not None:
            checks.append(failed("scale", lost))
        if rule.max_length is not None:
            checks.append(failed("length", F.length(result) > rule.max_length))
        if not rule.nullable:
            checks.append(failed("null", value.isNull()))
    reason = F.nullif(F.concat_ws(";", *checks), F.lit("")) if checks else F.lit(None).cast("string")
    return df.select(*converted, *[F.col(f"`{c}`") for c in keep], reason.alias(REASON))


def conform(df: DataFrame, rules: Sequence[ColumnRule], keep: Sequence[str] = (),
            **options: bool) -> tuple[DataFrame, DataFrame]:
    """``(good, rejects)``: converted rows, and source rows that do not fit with the reason.

    Each column needs a rule or a place in ``keep``; rejected rows have all columns.
    """
    good = flag(df, rules, keep, **options).where(F.col(REASON).isNull()).drop(REASON)
    return good, rejects(df, rules, **options)


def rejects(df: DataFrame, rules: Sequence[ColumnRule], **options: bool) -> DataFrame:
    """Rows that do not fit, unconverted, with the reason."""
    kept = [c for c in df.columns if c.upper() not in {r.name.upper() for r in rules}]
    whole = df.withColumn("_row", F.struct(*[F.col(f"`{c}`") for c in df.columns]))
    return flag(whole, rules, [*kept, "_row"], **options).where(F.col(REASON).isNotNull()).select("_row.*", REASON)


def align(df: DataFrame, target: T.StructType) -> DataFrame:
    """Columns of ``target`` in its order; names match in any case, absent ones are null."""
    have = {name.upper(): name for name in df.columns}
    return df.select(*[
        (F.col(f"`{have[f.name.upper()]}`") if f.name.upper() in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in target
    ])
