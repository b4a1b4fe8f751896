"""Lists of names: cleaning them and keeping only the rows they select."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..joins import divisible_join


def folded(col: Column | str) -> Column:
    """Names are the same when they agree without case and outer blanks."""
    return F.upper(F.trim(col))


def name_list(df: DataFrame, col: str = "value") -> DataFrame:
    """First comma field of each line, trimmed and upper-cased, blank lines left out."""
    name = folded(F.split_part(F.col(col), F.lit(","), F.lit(1)))
    return df.select(name.alias("name")).where("name <> ''")


def read_name_list(spark: SparkSession, path: str) -> DataFrame:
    return name_list(spark.read.text(path))


def restrict_to_list(df: DataFrame, col: str, names: DataFrame | None) -> DataFrame:
    """Rows whose ``col`` is in ``names``; every row when there is no list."""
    if names is None:
        return df
    wanted = names.select(folded("name").alias("_wanted")).distinct()
    return divisible_join(df, wanted, [folded(df[col])], [wanted["_wanted"]], "left_semi")
