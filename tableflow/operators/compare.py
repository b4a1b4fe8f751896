"""Compare two sides: row counts by table, existence by key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.names import folded
from ..sources.store import Store, read_tables
from .paging import number_rows

# Marks of the compare result.
NO_TABLE = "TABLE NOT EXIST"
NO_VIEW = "NOT EXISTS VIEW"
NO_ROWS = -1
# Tables that hold a run's own data, unless a plan names others.
COMPARE_TABLE = "RUN_COMPARE"
TASK_TABLE = "RUN_LOG"
OWN_TABLES = (COMPARE_TABLE, TASK_TABLE)


def row_counts(spark: SparkSession, tables: Mapping[str, DataFrame | None]) -> DataFrame:
    """``table_name, row_count`` of all tables in one job; null for an unreadable one.

    No column is read: file formats with counts in their footers read just those. All
    tables share one scan stage and one exchange of a row per table and task.
    """
    names = spark.createDataFrame([(name, df is not None) for name, df in tables.items()],
                                  "table_name string, readable boolean")
    marked = [df.select(F.lit(name).alias("table_name")) for name, df in tables.items() if df is not None]
    if not marked:
        return names.select("table_name", F.lit(None).cast("bigint").alias("row_count"))
    counts = reduce(DataFrame.unionByName, marked).groupBy("table_name").agg(F.count("*").alias("_rows"))
    found = F.when(F.col("readable"), F.coalesce("_rows", F.lit(0)))
    return names.join(counts, "table_name", "left").select("table_name", found.alias("row_count"))


def store_counts(spark: SparkSession, store: Store, names: Sequence[str]) -> DataFrame:
    """``row_counts`` of tables in a store; a database counts its own."""
    if store.kind != "jdbc":
        return row_counts(spark, read_tables(spark, store, names))
    queries = {name: f"(SELECT COUNT(*) AS row_count FROM {name}) c" for name in names}
    found = read_tables(spark, store, list(queries.values()))
    counts = [found[query].select(F.lit(name).alias("table_name"), F.col("row_count").cast("bigint").alias("row_count"))
              for name, query in queries.items() if found[query] is not None]
    lost = [(name, None) for name, query in queries.items() if found[query] is None]
    return reduce(DataFrame.unionByName, counts, spark.createDataFrame(lost, "table_name string, row_count bigint"))


def compare_counts(src: DataFrame, tgt: DataFrame, exclude: Sequence[str] = OWN_TABLES, db_type: str = "TABLE",
                   numbered: bool = False) -> DataFrame:
    """Match ``(table_name, row_count)`` of both sides by name.

    A table the target lacks shows as ``TABLE NOT EXIST`` with -1 rows. ``is_success`` is
    ``Y`` only if the counts agree; an unreadable source is ``N``.
    """
    left = src.select(folded("table_name").alias("source_table_name"), F.col("row_count").alias("source_rows"))
    left = left.where(~F.col("source_table_name").isin(*[name.upper() for name in exclude]))
    right = tgt.select(folded("table_name").alias("_name"), F.col("row_count").alias("_rows"))
    present = F.col("_name").isNotNull()
    result = (
        left.join(right, left["source_table_name"] == right["_name"], "left")
        .withColumns({
            "db_type": F.lit(db_type),
            "target_table_name": F.when(present, F.col("_name")).otherwise(NO_TABLE),
            "target_rows": F.when(present, F.col("_rows")).otherwise(F.lit(NO_ROWS).cast("bigint")),
        })
        .withColumn("is_success", F.when(
            present & F.coalesce(F.col("source_rows") == F.col("target_rows"), F.lit(False)), "Y").otherwise("N"))
        .drop("_name", "_rows")
    )
    return number_rows(result, ["source_table_name"], unique=True, name="id") if numbered else result


def compare_keys(src: DataFrame, tgt: DataFrame, keys: Sequence[str], tgt_keys: Sequence[str] | None = None,
                 missing: str = NO_VIEW) -> DataFrame:
    """Which keys of ``src`` exist in ``tgt``, without case: ``target_key`` or the mark, ``Y``/``N``.

    One row per key: rows of either side that share a key are the same to this question.
    """
    ours = [F.upper(F.col(f"`{k}`").cast("string")).alias(f"_s{i}") for i, k in enumerate(keys)]
    theirs = [F.upper(F.col(f"`{k}`").cast("string")).alias(f"_t{i}") for i, k in enumerate(tgt_keys or keys)]
    left = src.select(*ours).distinct()
    right = tgt.select(*theirs).distinct().withColumn("_found", F.lit(True))
    same = F.lit(True)
    for i in range(len(keys)):
        same = same & (left[f"_s{i}"] == right[f"_t{i}"])
    source_key = F.concat_ws(",", *[F.col(f"_s{i}") for i in range(len(keys))])
    present = F.col("_found").isNotNull()
    return left.join(right, same, "left").select(
        source_key.alias("source_key"), F.when(present, source_key).otherwise(missing).alias("target_key"),
        F.when(present, "Y").otherwise("N").alias("is_success"))


def failures(result: DataFrame) -> DataFrame:
    """Failed rows of a compare result, by target rows, then target name."""
    return result.where("is_success = 'N'").orderBy("target_rows", "target_table_name", "source_table_name")


def exists_in(df: DataFrame, col: str, value: object, counted: str | None = None) -> DataFrame:
    """``found``: distinct values of ``counted`` (``col`` itself if not given) where ``col`` is ``value``."""
    return df.where(F.col(col) == F.lit(value)).agg(F.count_distinct(F.col(counted or col)).alias("found"))
