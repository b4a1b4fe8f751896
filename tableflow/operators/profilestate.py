"""Profiles that are kept by part of a table and merged, so that only new parts are read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Up to so many known parts are left out by a filter that prunes files; more by an anti join.
PRUNED_PARTS = 10_000
_TEXT = (T.StringType, T.VarcharType, T.CharType)


def _sketched(kind: T.DataType, value: Column) -> tuple[Column, Column]:
    """Sketches of distinct values and of quantiles; null where a type has none."""
    number = value.cast("double") if isinstance(kind, T.NumericType) else F.lit(None).cast("double")
    return (F.hll_sketch_agg(value.cast("string")),
            F.kll_sketch_agg_double(number) if isinstance(kind, T.NumericType) else F.lit(None).cast("binary"))


def profile_parts(df: DataFrame, part: str) -> DataFrame:
    """One row for each value of ``part`` and each other column, made in one pass with partial sums.

    Columns: part, column_name, row_count, null_count, min_number, max_number (numbers, as doubles),
    min_text, max_text (texts; others as text of their extremes), max_length (characters), and the
    sketches distinct_sketch and quantile_sketch. A null part is a part. No rows give none.
    """
    fields = [f for f in df.schema if f.name != part and isinstance(f.dataType, T.AtomicType)]

    def one(field: T.StructField) -> Column:
        value, kind = F.col(f"`{field.name}`"), field.dataType
        numeric, text = isinstance(kind, T.NumericType), isinstance(kind, _TEXT)
        ordered = not isinstance(kind, T.BinaryType)
        distinct, quantiles = _sketched(kind, value)
        low, high = (F.min(value), F.max(value)) if ordered else (F.lit(None), F.lit(None))
        none = F.lit(None)
        return F.struct(
            F.lit(field.name).alias("column_name"), F.count("*").alias("row_count"),
            (F.count("*") - F.count(value)).alias("null_count"),
            (low if numeric else none).cast("double").alias("min_number"),
            (high if numeric else none).cast("double").alias("max_number"),
            (none if numeric else low).cast("string").alias("min_text"),
            (none if numeric else high).cast("string").alias("max_text"),
            (F.max(F.length(value)) if text else none).cast("int").alias("max_length"),
            distinct.alias("distinct_sketch"), quantiles.alias("quantile_sketch"))

    packed = df.groupBy(F.col(f"`{part}`").cast("string").alias("part")).agg(
        *[one(field).alias(f"c{i}") for i, field in enumerate(fields)])
    return packed.select("part", F.inline(F.array(*[F.col(f"c{i}") for i in range(len(fields))])))


def profile_again(df: DataFrame, part: str, known: DataFrame) -> DataFrame:
    """``known`` (of an earlier call) and the profiles of parts it lacks; a part that is known is not read again."""
    parts = known.select("part").distinct()
    names = [r.part for r in parts.limit(PRUNED_PARTS + 1).collect()]
    here = F.col(f"`{part}`").cast("string")
    if len(names) <= PRUNED_PARTS:
        listed = [n for n in names if n is not None]
        unread = ~here.isin(listed) if listed else F.lit(True)
        new = df.where(F.when(here.isNull(), F.lit(None not in names)).otherwise(unread))
    else:
        new = df.join(parts, here.eqNullSafe(parts["part"]), "left_anti")
    return known.unionByName(profile_parts(new, part))


def merged_profile(state: DataFrame) -> DataFrame:
    """One row for each column: sums and extremes of its parts, ``distinct_estimate`` and ``quartiles`` (numbers only).

    Counts, extremes and lengths are those of a pass over the whole table; the other two are estimates,
    within some 2% of the number and of the rank. A column that all parts hold as null has null extremes.
    """
    found = state.groupBy("column_name").agg(
        F.sum("row_count").alias("row_count"), F.sum("null_count").alias("null_count"),
        F.min("min_number").alias("min_number"), F.max("max_number").alias("max_number"),
        F.min("min_text").alias("min_text"), F.max("max_text").alias("max_text"), F.max("max_length").alias("max_length"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("distinct_estimate"),
        F.kll_merge_agg_double(F.when(F.col("min_number").isNotNull(), F.col("quantile_sketch"))).alias("_merged"))
    shares = F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))
    quartiles = F.when(F.col("min_number").isNotNull(), F.kll_sketch_get_quantile_double("_merged", shares))
    return found.withColumn("quartiles", quartiles).drop("_merged")
