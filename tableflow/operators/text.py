"""Rewriting tables of statements or texts; every operator works on the whole text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as t
from ..joins import divisible_join


def rewrite_text(df: DataFrame, col: str, rules: Sequence[tuple[str, str]] = t.VIEW_RULES) -> DataFrame:
    """Literal replacements in the given order."""
    return df.withColumn(col, t.replaced(F.col(col), rules))


def rewrite_code(df: DataFrame, col: str, rules: Sequence[tuple[str, str]] = t.VIEW_RULES) -> DataFrame:
    """Literal replacements that leave quoted texts and comments as they are.

    A rule with a quote in it applies where code holds its whole text. Rules on ``--`` give way to the
    reading of comments: one whose mark no space follows gets it. Null stays null, empty stays empty.
    """
    return df.withColumn(col, t.replaced_in_code(F.col(col), rules))


def normalise_text(df: DataFrame, col: str, rules: Sequence[tuple[str, str]] = t.TRIGGER_RULES) -> DataFrame:
    """Upper case, fixed replacements, line feeds removed."""
    return df.withColumn(col, t.normalised(F.col(col), rules))


def strip_definition(df: DataFrame, col: str, marker: str | None = None, schema: str | None = None) -> DataFrame:
    """Cut before ``marker``, drop quotes, the schema prefix and line feeds."""
    return df.withColumn(col, t.definition(F.col(col), marker, schema))


def text_between(df: DataFrame, col: str, start: str, end: str, name: str = "found") -> DataFrame:
    """Add the text between two markers, null where one is absent."""
    return df.withColumn(name, t.between(F.col(col), start, end))


def valid_only(defs: DataFrame, objects: DataFrame, key: str, object_key: str, valid: str) -> DataFrame:
    """Definitions whose key is among the objects for which ``valid`` (SQL) holds."""
    known = objects.where(valid).select(F.col(object_key).alias("_object")).distinct()
    return divisible_join(defs, known, [defs[key]], [known["_object"]], "left_semi")
