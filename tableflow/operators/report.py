"""Status and report tables of a run, aggregated from its log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .compare import NO_TABLE
from .paging import number_rows

# Texts of the table report.
INSERT_FAIL = "TABLE INSERT FAIL"
SUCCESS = "SUCCESS"
RUNNING = "running"


def transfer_status(log: DataFrame) -> DataFrame:
    """Totals of each table, ``Y`` if every source row was written, first start and last end."""
    totals = log.where("type = 'TABLE'").groupBy("table_name").agg(
        F.max("source_table_rows").alias("source_table_rows"),
        F.sum("target_table_rows").alias("target_table_rows"),
        F.min("task_start_time").alias("task_start_time"),
        F.max("task_end_time").alias("task_end_time"))
    same = F.col("source_table_rows") == F.col("target_table_rows")
    return totals.withColumn("is_success", F.when(same, "Y").otherwise("N"))


def elapsed(log: DataFrame, start: str = "task_start_time", end: str = "task_end_time") -> DataFrame:
    """Add ``run_time``, whole seconds from start to end, both cut to the second."""
    return log.withColumn("run_time", _epoch(log, end) - _epoch(log, start))


def _epoch(df: DataFrame, name: str) -> Column:
    """Seconds since 1970; a time without zone counts as it stands, whatever the session zone."""
    ts = F.col(name)
    if not isinstance(df.schema[name].dataType, T.TimestampNTZType):
        return F.unix_timestamp(ts)
    day = F.unix_date(ts.cast("date")).cast("bigint")
    return day * 86_400 + F.hour(ts) * 3_600 + F.minute(ts) * 60 + F.second(ts)


def transfer_report(log: DataFrame, missing: DataFrame | None = None, numbered: bool = True) -> DataFrame:
    """One row per table: counts and what became of it, and ``id`` in order of the detail if ``numbered``.

    ``log`` holds ``table_name, source_table_rows, target_table_rows, type, detail``;
    ``missing`` the ``table_name`` of tables that could not be created.
    """
    rows = log.where("type = 'TABLE'").select("table_name", "source_table_rows", "target_table_rows", "detail")
    if missing is not None:
        nothing = F.lit(0).cast("bigint")
        rows = rows.unionByName(missing.select(
            "table_name", nothing.alias("source_table_rows"), nothing.alias("target_table_rows"),
            F.lit(NO_TABLE).alias("detail")))
    tables = rows.groupBy("table_name").agg(
        F.max("source_table_rows").alias("source_table_rows"),
        F.sum("target_table_rows").alias("target_table_rows"),
        F.max(F.coalesce("detail", F.lit(""))).alias("_detail"))
    short = F.when(F.col("source_table_rows") != F.col("target_table_rows"), INSERT_FAIL).otherwise("")
    told = F.concat(short, F.col("_detail"))
    report = tables.withColumn("run_detail", F.when(told == "", SUCCESS).otherwise(told)).drop("_detail")
    return number_rows(report, ["run_detail", "table_name"], unique=True, name="id") if numbered else report


def object_status(log: DataFrame) -> DataFrame:
    """Latest status and message of each object: ``kind, name, status, message``.

    ``log`` holds ``kind, name, status, message, ts``. At one time, a state beats ``running``.
    """
    done = (F.col("status") != RUNNING).alias("done")
    latest = F.max(F.struct("ts", done, "status", "message")).alias("last")
    return log.groupBy("kind", "name").agg(latest).select("kind", "name", "last.status", "last.message")


def run_summary(results: DataFrame, failed: str = "failed") -> DataFrame:
    """``kind, total, success, failed``, each object counted once however often it was tried.

    ``results`` holds ``kind, name, status``; an object fails if its latest try did, or,
    without a ``ts`` column, if every try did.
    """
    bad = F.col("status") == failed
    if "ts" in results.columns:
        objects = results.groupBy("kind", "name").agg(F.max(F.struct("ts", bad.alias("bad")))["bad"].alias("bad"))
    else:
        objects = results.groupBy("kind", "name").agg(F.min(bad).alias("bad"))
    return objects.groupBy("kind").agg(
        F.count("*").alias("total"), F.count_if(~F.col("bad")).alias("success"), F.count_if("bad").alias("failed"))


def count_by_kind(df: DataFrame, kind: str, name: str, exclude_like: str | None = None) -> DataFrame:
    """Rows per kind, leaving out names that match the SQL pattern."""
    kept = df if exclude_like is None else df.where(~F.col(name).like(exclude_like))
    return kept.groupBy(F.col(kind).alias("kind")).agg(F.count("*").alias("total"))
