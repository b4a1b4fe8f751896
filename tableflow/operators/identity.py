"""Ids that stay the same over runs: a map of keys to ids that only grows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.store import Store, append, read_tables
from .paging import number_rows


def _matched(left: DataFrame, known: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join by keys in which a null is a value."""
    named = known.withColumnsRenamed({k: f"_k{i}" for i, k in enumerate(keys)})
    same: Column = reduce(and_, [left[f"`{k}`"].eqNullSafe(named[f"_k{i}"]) for i, k in enumerate(keys)])
    return left.join(named, same, how).drop(*[f"_k{i}" for i in range(len(keys))])


def known_ids(df: DataFrame, store: Store, name: str, keys: Sequence[str], id_col: str = "id") -> DataFrame:
    """The map of keys to ids after the keys of ``df`` are in it: the keys and ``id_col``.

    Keys that the table ``name`` of the store has keep their ids. The others get the numbers after the largest
    one, in the order of the keys, and are added in one append; so a call that is repeated, after a
    failure or with the same rows, adds nothing. A null in a key is a value. Only one caller at a
    time may add to a map.
    """
    spark = df.sparkSession
    known = read_tables(spark, store, [name])[name]
    present = df.select(*[F.col(f"`{k}`") for k in keys]).distinct()
    missing = present if known is None else _matched(present, known.select(*keys), keys, "left_anti")
    largest = 0 if known is None else known.agg(F.max(id_col)).first()[0] or 0
    if known is None or not missing.isEmpty():
        numbered = number_rows(missing, keys, True, "_no")
        added = numbered.select(*[F.col(f"`{k}`") for k in keys], (F.lit(largest) + F.col("_no")).cast("bigint").alias(id_col))
        append(added, store, name)
        known = read_tables(spark, store, [name])[name]
    return known


def assign_ids_again(df: DataFrame, store: Store, name: str, keys: Sequence[str], id_col: str = "id") -> DataFrame:
    """``df`` with the id of each row's key, the same in every run; see ``known_ids``.

    Rows of one key share its id. The map is joined by its keys; Spark splits a key with too many rows.
    """
    known = known_ids(df, store, name, keys, id_col)
    return _matched(df, known.select(*keys, id_col), keys, "left")
