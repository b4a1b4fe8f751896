"""Compare two sides by content: sums of row hashes by nested ranges, rows only where these differ."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..joins import divisible_join
from ..session import materialise

#: Bits of the key hash that name the ranges of each level.
LEVELS = (10, 24)
CHANGED, LOST, ADDED = "changed", "lost", "added"


def _same_form(ours: T.DataType, theirs: T.DataType) -> str | None:
    """The type in which both sides compare equal values as equal; ``None`` where they have it already."""
    if ours == theirs:
        return None
    numbers = (ours, theirs)
    if all(isinstance(t, T.IntegralType) for t in numbers):
        return "bigint"
    if all(isinstance(t, (T.IntegralType, T.DecimalType)) for t in numbers):
        scale = max(getattr(t, "scale", 0) for t in numbers)
        whole = max(t.precision - t.scale if isinstance(t, T.DecimalType) else 19 for t in numbers)
        return f"decimal({min(38, whole + scale)},{scale})" if whole + scale <= 38 else "string"
    if all(isinstance(t, T.NumericType) for t in numbers):
        return "double"
    if all(isinstance(t, (T.TimestampType, T.TimestampNTZType, T.DateType)) for t in numbers):
        return "timestamp_ntz"
    return "string"


def _sided(src: DataFrame, tgt: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The columns of both sides under one name and in one form."""
    def found(df: DataFrame) -> dict[str, T.StructField]:
        return {f.name.upper(): f for f in df.schema}

    ours, theirs = found(src), found(tgt)
    kinds = {c: _same_form(ours[c.upper()].dataType, theirs[c.upper()].dataType) for c in columns}

    def of(df: DataFrame, fields: dict[str, T.StructField]) -> DataFrame:
        taken = {c: F.col(f"`{fields[c.upper()].name}`") for c in columns}
        return df.select(*[(col.cast(kinds[c]) if kinds[c] else col).alias(c) for c, col in taken.items()])

    return of(src, ours), of(tgt, theirs)


def _hash(columns: Sequence[str]) -> Column:
    """A hash of values and of where they are null."""
    return F.xxhash64(*[part for c in columns for part in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())])


def _content(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows and the sum of their hashes by group: the order of rows does not matter, repeated rows count."""
    return rows.groupBy(*[F.col(f"`{c}`") for c in by]).agg(
        F.count("*").alias("_rows"), F.sum(F.col("_row").cast("decimal(20,0)")).alias("_sum"))


def _differing(ours: DataFrame, theirs: DataFrame, by: Sequence[str]) -> DataFrame:
    """The groups whose content differs, with the rows of either side."""
    left, right = _content(ours, by), _content(theirs, by)
    right = right.select(*[F.col(f"`{c}`").alias(f"_t{i}") for i, c in enumerate(by)], F.col("_rows").alias("_rows2"), F.col("_sum").alias("_sum2"))
    same = reduce(and_, [left[f"`{c}`"].eqNullSafe(right[f"_t{i}"]) for i, c in enumerate(by)])
    return (left.join(right, same, "full").where(~(F.col("_rows").eqNullSafe(F.col("_rows2")) & F.col("_sum").eqNullSafe(F.col("_sum2"))))
            .select(*[F.coalesce(F.col(f"`{c}`"), F.col(f"_t{i}")).alias(c) for i, c in enumerate(by)],
                    F.coalesce("_rows", F.lit(0)).alias("source_rows"), F.coalesce("_rows2", F.lit(0)).alias("target_rows")))


def compare_content(src: DataFrame, tgt: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None,
                    levels: Sequence[int] = LEVELS) -> DataFrame:
    """The keys whose rows differ: the keys, ``difference`` and the rows of either side.

    ``difference`` is ``changed`` (both have the key, its rows are not the same), ``lost`` (the target lacks
    it) or ``added`` (the source does). ``columns`` are those that both sides have, by name in any case,
    unless named; values of different types are compared as the same number, instant or text. Keys may
    repeat and be null: rows of a key are compared as a whole, whatever their order, and a null is a value.

    Each side adds up the hashes of its rows by ranges of the key's hash. Only ranges whose sums differ are cut
    further, and rows are exchanged only for the last of them; equal tables end after the first
    level, a row for each range and task. Hashes have 64 bits: two unequal ranges agree once in 2 ** 64.
    """
    theirs_named = {c.upper() for c in tgt.columns}
    shared = list(columns) if columns else [c for c in src.columns if c.upper() in theirs_named]
    wanted = [*keys, *[c for c in shared if c.upper() not in {k.upper() for k in keys}]]
    place = F.xxhash64(_hash(keys), F.lit(7))
    ours, theirs = (df.withColumns({"_row": _hash(wanted), "_key": place}).select(*[F.col(f"`{k}`") for k in keys], "_row", "_key")
                    for df in _sided(src, tgt, wanted))
    for bits in levels:
        ours, theirs = (df.withColumn("_range", F.shiftrightunsigned("_key", 64 - bits)) for df in (ours, theirs))
        open_ranges = materialise(_differing(ours, theirs, ["_range"]).select(F.col("_range").alias("_open")), "ranges")
        ours, theirs = (divisible_join(df, open_ranges, [df["_range"]], [open_ranges["_open"]], "left_semi") for df in (ours, theirs))
        if open_ranges.isEmpty():
            break
    found = _differing(ours, theirs, keys)
    kind = F.when(F.col("target_rows") == 0, LOST).when(F.col("source_rows") == 0, ADDED).otherwise(CHANGED)
    return found.select(*[F.col(f"`{k}`") for k in keys], kind.alias("difference"), "source_rows", "target_rows")
