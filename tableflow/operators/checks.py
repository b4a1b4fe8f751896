"""Constraints as checks on data: each returns what violates it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..joins import divisible_join
from .paging import number_rows
from .profile import one_row_per_column


def _cols(names: Sequence[str]) -> list[Column]:
    return [F.col(f"`{n}`") for n in names]


def _any_null(names: Sequence[str]) -> Column:
    found = F.lit(False)
    for col in _cols(names):
        found = found | col.isNull()
    return found


def _counted(df: DataFrame, keys: Sequence[str], wide_keys: bool) -> DataFrame:
    """Keys that occur more than once, with their number of rows.

    Copies collapse on the map side, so a key that fills a third of the table sends one
    row per task. With ``wide_keys`` (long texts) only 8 bytes per row are exchanged
    first, and the texts themselves only for the hashes that occur twice.
    """
    if wide_keys:
        hashed = df.select(*_cols(keys), F.xxhash64(*_cols(keys)).alias("_hash"))
        twice = (hashed.groupBy("_hash").agg(F.count("*").alias("_n")).where("_n > 1")
                 .select(F.col("_hash").alias("_twice")))
        df = divisible_join(hashed, twice, [hashed["_hash"]], [twice["_twice"]], "left_semi")
    return df.groupBy(*_cols(keys)).agg(F.count("*").alias("row_count")).where("row_count > 1")


def check_primary_key(df: DataFrame, keys: Sequence[str], wide_keys: bool = False) -> DataFrame:
    """Keys with a null part or more than one row: the keys, ``row_count`` and ``problem``."""
    if wide_keys:
        nulls = (df.where(_any_null(keys)).groupBy(*_cols(keys)).agg(F.count("*").alias("row_count"))
                 .withColumn("problem", F.lit("null")))
        twice = _counted(df.where(~_any_null(keys)), keys, True).withColumn("problem", F.lit("duplicate"))
        return nulls.unionByName(twice)
    problem = F.when(_any_null(keys), "null").when(F.col("row_count") > 1, "duplicate")
    return (df.groupBy(*_cols(keys)).agg(F.count("*").alias("row_count"))
            .withColumn("problem", problem).where("problem IS NOT NULL"))


def check_unique(df: DataFrame, keys: Sequence[str], wide_keys: bool = False) -> DataFrame:
    """Keys with more than one row; keys with a null part do not count."""
    return _counted(df.where(~_any_null(keys)), keys, wide_keys)


def check_not_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``column_name, null_count`` of all declared columns in one pass."""
    return one_row_per_column(df, {
        c: {"null_count": F.count_if(F.col(f"`{c}`").isNull())} for c in columns or df.columns})


def _matching(child: DataFrame, parent: DataFrame, child_keys: Sequence[str],
              parent_keys: Sequence[str]) -> tuple[DataFrame, DataFrame, Column]:
    known = parent.select(*[F.col(f"`{k}`").alias(f"_p{i}") for i, k in enumerate(parent_keys)])
    present = child.where(~_any_null(child_keys))
    same = F.lit(True)
    for i, key in enumerate(child_keys):
        same = same & (present[f"`{key}`"] == known[f"_p{i}"])
    return present, known, same


def orphan_rows(child: DataFrame, parent: DataFrame, child_keys: Sequence[str],
                parent_keys: Sequence[str]) -> DataFrame:
    """Child rows whose key is in no parent row; a key with a null part refers to nothing.

    Spark picks the join by size, and splits a key that holds too many child rows
    (adaptive skew join).
    """
    present, known, same = _matching(child, parent, child_keys, parent_keys)
    return present.join(known, same, "left_anti")


def orphan_summary(child: DataFrame, parent: DataFrame, child_keys: Sequence[str],
                   parent_keys: Sequence[str]) -> DataFrame:
    """Orphan keys with their number of child rows.

    Child rows are counted per key before the join, so a frequent key is one row in it.
    """
    per_key = child.groupBy(*_cols(child_keys)).agg(F.count("*").alias("orphan_count"))
    present, known, same = _matching(per_key, parent, child_keys, parent_keys)
    # An anti join would be moved below the count by the optimizer, and meet every child row.
    found = present.join(known.distinct().withColumn("_found", F.lit(True)), same, "left")
    return found.where("_found IS NULL").select(*_cols(child_keys), "orphan_count")


def assign_ids(df: DataFrame, id_col: str, order_keys: Sequence[str], unique: bool = False) -> DataFrame:
    """Give rows without an id the numbers after the largest one, in the order of the keys.

    Existing ids are left as they are and those rows are not moved.
    """
    kind = df.schema[id_col].dataType
    largest = df.agg(F.max(id_col)).first()[0] or 0
    missing = df.where(F.col(id_col).isNull()).drop(id_col)
    numbered = number_rows(missing, order_keys, unique, "_no")
    filled = numbered.withColumn(id_col, (F.lit(largest) + F.col("_no")).cast(kind)).select(*_cols(df.columns))
    return df.where(F.col(id_col).isNotNull()).unionByName(filled)
