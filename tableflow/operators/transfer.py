"""Move a table to a store and log what arrived."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_path
from ..sources import store as io
from ..sources.store import Store, parquet_store
from .conform import REASON, align, flag, rejects
from .mapping import ColumnRule
from .paging import with_pages

LOG_DDL = (
    "table_name string, page_no bigint, source_table_rows bigint, target_table_rows bigint, type string, "
    "detail string, task_start_time timestamp_ntz, task_end_time timestamp_ntz"
)


def _write(df: DataFrame, store: Store, name: str, mode: str, rules: Sequence[ColumnRule] | None) -> None:
    if mode == "append":
        io.append(df, store, name)
    elif mode == "truncate":
        io.truncate_load(df, store, name)
    elif mode == "replace":
        # Bounded texts keep their length where the table is created; other types follow the dialect.
        bounded = {r.name: f"VARCHAR({r.max_length})" for r in rules or () if r.max_length and r.spark_type == "string"}
        io.replace(df, store, name, column_types=bounded)
    else:
        raise ValueError("mode is append, truncate or replace")


def now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def log_row(spark: SparkSession, name: str, source: int, target: int, started: datetime,
            detail: str = "", kind: str = "TABLE") -> DataFrame:
    return spark.createDataFrame([(name, None, source, target, kind, detail, started, now())], LOG_DDL)


def _checked(df: DataFrame, rules: Sequence[ColumnRule] | None, keep: Sequence[str],
             options: dict[str, bool]) -> tuple[DataFrame, Observation]:
    """Rows that fit, and a count of all rows and of those left out taken while writing."""
    seen = Observation()
    if rules is None:
        return df.observe(seen, F.count("*").alias("rows"), F.lit(0).cast("bigint").alias("rejected")), seen
    flagged = flag(df, rules, keep, **options)
    out = F.count_if(F.col(REASON).isNotNull()).alias("rejected")
    return flagged.observe(seen, F.count("*").alias("rows"), out).where(F.col(REASON).isNull()).drop(REASON), seen


def _ruled(df: DataFrame, rules: Sequence[ColumnRule] | None, *keep: str) -> DataFrame:
    """The columns that go to the target: those with a rule, if there are rules."""
    names = {r.name.upper() for r in rules or ()} | {k.upper() for k in keep}
    return df if rules is None else df.select(*[F.col(f"`{c}`") for c in df.columns if c.upper() in names])


def _save_rejects(df: DataFrame, rules: Sequence[ColumnRule] | None, seen: Observation,
                  reject_store: Store | None, name: str, options: dict[str, bool]) -> None:
    # The source is read again for the rejected rows only if the write met any.
    if rules is not None and reject_store is not None and seen.get["rejected"]:
        io.append(rejects(df, rules, **options), reject_store, name)


def copy_table(df: DataFrame, store: Store, name: str, mode: str = "replace",
               rules: Sequence[ColumnRule] | None = None, reject_store: Store | None = None,
               **options: bool) -> DataFrame:
    """Write the table in one pass without any exchange; the log has one row.

    Rows that do not fit ``rules`` are left out and kept whole in ``reject_store`` with a
    reason. Counts are taken while the rows are written. With rules, the target has the
    columns they name, as in a mapping that drops some.
    """
    started = now()
    good, seen = _checked(_ruled(df, rules), rules, (), options)
    _write(good, store, name, mode, rules)
    _save_rejects(df, rules, seen, reject_store, name, options)
    rows, out = seen.get["rows"], seen.get["rejected"]
    return log_row(df.sparkSession, name, rows, rows - out, started)


def transfer(df: DataFrame, store: Store, name: str, keys: Sequence[str], page_size: int, unique: bool = False,
             mode: str = "replace", rules: Sequence[ColumnRule] | None = None, reject_store: Store | None = None,
             buckets: int | None = None, **options: bool) -> DataFrame:
    """Write the table in pages of a fixed number of rows and log every page.

    The written table has a column ``page_no``. Target rows are counted per page on what
    was written, reading back that column only; a page without a written row is in the
    log with 0. A JDBC target does not get the column: rows and pages are staged in the
    shared folder first. With ``mode="append"`` pages that were there before count as
    well, so use it on an empty table.
    """
    started = now()
    spark = df.sparkSession
    staged = parquet_store(fresh_path(spark, "stage")) if store.kind == "jdbc" else store
    paged = with_pages(df, keys, page_size, unique, buckets).drop("row_no")
    good, seen = _checked(_ruled(paged, rules, "page_no"), rules, ("page_no",), options)
    _write(good, staged, name, mode if staged is store else "replace", rules)
    _save_rejects(df, rules, seen, reject_store, name, options)
    stage = io.read_table(spark, staged, name)
    if staged is not store:
        _write(stage.drop("page_no"), store, name, mode, rules)
    total = seen.get["rows"]
    if total == 0:
        return log_row(spark, name, 0, 0, started)
    written = stage.groupBy("page_no").agg(F.count("*").alias("_rows"))
    pages = spark.range(1, -(-total // page_size) + 1).withColumnRenamed("id", "page_no")
    return pages.join(written, "page_no", "left").select(
        F.lit(name).alias("table_name"), "page_no", F.lit(total).cast("bigint").alias("source_table_rows"),
        F.coalesce("_rows", F.lit(0)).alias("target_table_rows"), F.lit("TABLE").alias("type"),
        F.lit("").alias("detail"), F.lit(started).cast("timestamp_ntz").alias("task_start_time"),
        F.lit(now()).cast("timestamp_ntz").alias("task_end_time"))


def load_common_columns(df: DataFrame, store: Store, name: str, batch_rows: int = 10_000,
                        reject_store: Store | None = None) -> DataFrame | None:
    """Empty the target table and load the columns it shares with ``df``, others null.

    Returns the log, or ``None`` where the target has no such table. A file table is
    rewritten with its own schema. Rows with a value the target cannot hold are left out and
    kept in ``reject_store`` with a reason; the log counts what was written.
    """
    schema = io.target_schema(df.sparkSession, store, name)
    if schema is None:
        return None
    started = now()
    if store.kind == "jdbc":
        have = {c.upper() for c in df.columns}
        schema = type(schema)([f for f in schema if f.name.upper() in have])
    have = {c.upper() for c in df.columns}
    rules = [ColumnRule(f.name, f.dataType.simpleString()) for f in schema if f.name.upper() in have]
    options = {"exact_scale": True, "whole_seconds": False}
    others = [c for c in df.columns if c.upper() not in {r.name.upper() for r in rules}]
    good, seen = _checked(df, rules, others, options)
    io.truncate_load(align(good, schema), store, name, batch_rows)
    _save_rejects(df, rules, seen, reject_store, name, options)
    rows, out = seen.get["rows"], seen.get["rejected"]
    return log_row(df.sparkSession, name, rows, rows - out, started)
