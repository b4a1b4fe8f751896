"""A whole run: map, load, check, compare and report the tables of one store in another."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.checks import assign_ids, check_not_null, check_primary_key, check_unique, orphan_summary
from ..operators.compare import (
    COMPARE_TABLE,
    NO_TABLE,
    TASK_TABLE,
    compare_counts,
    compare_keys,
    row_counts,
    store_counts,
)
from ..operators.mapping import ROW_WIDTH_LIMIT, column_rules, exact_types, fit_row_width, map_types, schema_of
from ..operators.profile import number_widths, text_widths
from ..operators.report import INSERT_FAIL, RUNNING, elapsed, object_status, run_summary, transfer_report
from ..operators.text import rewrite_text, valid_only
from ..operators.transfer import copy_table, load_common_columns, log_row, now, transfer
from ..session import materialise
from ..sources.catalogue import catalogue_of, measured_catalogue
from ..sources.names import folded
from ..sources.store import Store, read_ranges, read_table, read_tables, replace, save_log

FULL, LISTED, DATA, METADATA = "full", "listed", "data", "metadata"
MODES = (FULL, LISTED, DATA, METADATA)
STATUS_DDL = "kind string, name string, status string, message string, ts timestamp_ntz"


@dataclass(frozen=True)
class Reference:
    """A foreign key of a table."""

    columns: Sequence[str]
    parent: str
    parent_columns: Sequence[str]


@dataclass(frozen=True)
class TablePlan:
    """What is known about a table.

    ``order`` is needed for a log by page. Rows without a value in ``identity`` get the
    next numbers, in that order. A database table is read in ``parts`` ranges of the number
    ``split_key`` at a time, by load, profile and checks alike; without one, in one task.
    """

    name: str
    order: Sequence[str] = ()
    primary_key: Sequence[str] = ()
    unique_keys: Sequence[Sequence[str]] = ()
    not_null: Sequence[str] = ()
    identity: str | None = None
    references: Sequence[Reference] = ()
    split_key: str | None = None
    parts: int = 8


@dataclass(frozen=True)
class Plan:
    """What to move.

    ``measure`` reads lengths and number ranges from the data before mapping. Rejected rows
    go to ``reject_store``, the log (as tables finish) and the compare result to ``log_store``.
    ``views`` (view_name, text) are rewritten; with ``target_views`` (view_name), the compare
    result says which of them are there. A number with more digits behind the point than its target
    has places for is a reject; with ``round_decimals`` it is rounded.
    """

    source: Store
    target: Store
    tables: Sequence[TablePlan]
    mode: str = FULL
    names: Sequence[str] | DataFrame | None = None
    catalogue: DataFrame | None = None
    page_size: int = 10_000
    parallel: int = 2
    compat: bool = False
    measure: bool = False
    reject_store: Store | None = None
    log_store: Store | None = None
    log_table: str = TASK_TABLE
    compare_table: str = COMPARE_TABLE
    views: DataFrame | None = None
    objects: DataFrame | None = None
    target_views: DataFrame | None = None
    round_decimals: bool = False

    def chosen(self) -> list[TablePlan]:
        if self.mode not in MODES:
            raise ValueError(f"mode is one of {', '.join(MODES)}")
        names = self.names
        if isinstance(names, DataFrame):  # at most one name per table of the catalogue
            names = [row["name"] for row in names.collect()]
        if self.mode == LISTED and not names:
            raise ValueError("the listed mode needs names")
        if self.mode in (FULL, METADATA) and names:
            raise ValueError(f"names cannot be combined with the {self.mode} mode")
        wanted = {n.split(",")[0].strip().upper() for n in names or ()} - {""}
        return [t for t in self.tables if not names or t.name.upper() in wanted]


@dataclass
class Run:
    """Result of a run; violations are computed when they are read."""

    log: DataFrame
    report: DataFrame
    compare: DataFrame
    status: DataFrame
    summary: DataFrame
    mapping: DataFrame | None = None
    views: DataFrame | None = None
    violations: Mapping[str, DataFrame] = field(default_factory=dict)


def _profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Range and scale of every numeric column, one pass per table."""
    return reduce(DataFrame.unionByName, [
        number_widths(df).withColumn("table_name", F.lit(name)) for name, df in tables.items()])


def _fitted(mapping: DataFrame, readable: Mapping[str, DataFrame]) -> tuple[DataFrame, set[str]]:
    """Mapping whose too wide tables have text lengths taken from their data, and those tables."""
    lengths = mapping.groupBy(folded("table_name").alias("name")).agg(F.sum("char_length").alias("row"))
    wide = {r["name"] for r in lengths.where(F.col("row") > ROW_WIDTH_LIMIT).collect()}
    widths = [text_widths(df).select(F.lit(name.upper()).alias("table_name"), F.upper("column_name").alias("column_name"),
                                     "width")
              for name, df in readable.items() if name.upper() in wide]
    if not widths:
        return mapping, set()
    named = mapping.withColumns({"_t": F.col("table_name"), "_c": F.col("column_name"), "table_name": folded("table_name"),
                                 "column_name": folded("column_name")})
    fitted = fit_row_width(named, reduce(DataFrame.unionByName, widths))
    length = F.when(F.col("narrowed"), F.col("fitted_length")).otherwise(F.col("max_length"))
    told = F.concat(F.split_part("target_type", F.lit("("), F.lit(1)), F.lit("("), F.col("fitted_length"), F.lit(")"))
    fitted = fitted.withColumns({
        "max_length": length, "target_type": F.when(F.col("narrowed") & F.col("max_length").isNotNull(), told)
        .otherwise(F.col("target_type")), "table_name": F.col("_t"), "column_name": F.col("_c")})
    fitted = materialise(fitted.select(*mapping.columns), "mapping")
    return fitted, wide & {name.upper() for name in readable}


def _read(spark: SparkSession, store: Store, table: TablePlan, types: Mapping[str, str] | None = None) -> DataFrame:
    """A table of a store, in ranges of its split key where a database is asked."""
    if store.kind == "jdbc" and table.split_key:
        return read_ranges(spark, store, table.name, table.split_key, table.parts, types=types)
    return read_table(spark, store, table.name, types=types)


def _load(spark: SparkSession, plan: Plan, table: TablePlan, source: DataFrame,
          mapping: DataFrame | None) -> DataFrame | None:
    """Load one table in the mode of the plan and return its log."""
    if plan.mode == DATA:
        return load_common_columns(source, plan.target, table.name, reject_store=plan.reject_store)
    rules = column_rules(mapping, table.name)
    if plan.mode == METADATA:
        replace(spark.createDataFrame([], schema_of(rules, source.schema)), plan.target, table.name)
        return log_row(spark, table.name, 0, 0, now())
    if plan.source.kind == "jdbc":
        source = _read(spark, plan.source, table, exact_types(rules))
        if table.order or table.identity:
            # Numbering reads its input several times; a live table is read once and cannot change in between.
            source = materialise(source, table.name)
    if table.identity:
        # Paging reads its input several times; the numbers are given once.
        source = materialise(assign_ids(source, table.identity, table.order or source.columns), table.name)
    if table.order:
        unique = bool(table.primary_key) and set(table.primary_key) <= set(table.order)
        return transfer(source, plan.target, table.name, table.order, plan.page_size, unique, rules=rules,
                        reject_store=plan.reject_store, exact_scale=not plan.round_decimals)
    return copy_table(source, plan.target, table.name, rules=rules, reject_store=plan.reject_store,
                      exact_scale=not plan.round_decimals)


def _checks(spark: SparkSession, plan: Plan, table: TablePlan) -> Iterator[tuple[str, str, Callable[[], DataFrame | None]]]:
    """Kind, name and what finds violations in the target; that gives ``None`` where a parent table is not there."""
    def rows(columns: Sequence[str]) -> DataFrame:
        return _read(spark, plan.target, table).select(*columns)

    def lost(ref: Reference) -> DataFrame | None:
        if read_tables(spark, plan.target, [ref.parent])[ref.parent] is None:
            return None
        known = next((t for t in plan.tables if t.name == ref.parent), TablePlan(ref.parent))
        parent = _read(spark, plan.target, known).select(*ref.parent_columns)
        return orphan_summary(rows(ref.columns), parent, ref.columns, ref.parent_columns)

    if table.primary_key:
        yield "CONSTRAINT INDEX", f"{table.name} primary key", lambda: check_primary_key(rows(table.primary_key), table.primary_key)
    for keys in table.unique_keys:
        yield "CONSTRAINT INDEX", f"{table.name} unique {','.join(keys)}", lambda keys=keys: check_unique(rows(keys), keys)
    if table.not_null:
        yield ("CONSTRAINT INDEX", f"{table.name} not null",
               lambda: check_not_null(rows(table.not_null), table.not_null).where("null_count > 0"))
    for ref in table.references:
        yield "FOREIGN KEY", f"{table.name} {','.join(ref.columns)}", lambda ref=ref: lost(ref)


def _told(error: Exception) -> str:
    return f"{type(error).__name__}: {error}"


def run(spark: SparkSession, plan: Plan) -> Run:
    """Run the plan. A table or a check that fails is reported and does not stop the others.

    The driver only submits jobs, a few tables at a time; rows move in tasks.
    """
    tables = plan.chosen()
    sources = read_tables(spark, plan.source, [t.name for t in tables])
    ranged = {t.name: t for t in tables if t.split_key and plan.source.kind == "jdbc"}
    readable = {name: _read(spark, plan.source, ranged[name]) if name in ranged else df
                for name, df in sources.items() if df is not None}
    mapping, narrowed = None, set()
    if plan.mode != DATA:
        described, profile = plan.catalogue, None
        if described is None and plan.measure and readable:
            described, profile = measured_catalogue(spark, readable), _profile(readable)
        elif described is None:
            described = catalogue_of(spark, readable)
        mapping, narrowed = _fitted(materialise(map_types(described, plan.compat, profile), "mapping"), readable)
    status: list[tuple] = []
    saving = Lock()
    if mapping is not None:
        told = mapping.where("rule IN ('unmapped', 'dropped', 'table_lost')").select("table_name", "column_name", "data_type", "rule")
        status += [("COLUMN", f"{r.table_name}.{r.column_name}", r.rule, r.data_type, now()) for r in told.collect()]

    def load(table: TablePlan) -> DataFrame:
        status.append(("TABLE", table.name, RUNNING, "", now()))
        started, log, message, detail = now(), None, "", ""
        try:
            if table.name in readable:
                log = _load(spark, plan, table, readable[table.name], mapping)
            if log is None:
                message = detail = NO_TABLE
            else:
                log = materialise(log, "log")  # read by the report, the log store and the caller
        except Exception as error:  # whatever one table meets, the others go on
            log, message = None, _told(error)
            detail = f"{INSERT_FAIL} {message}"
        done = "narrowed" if table.name.upper() in narrowed else ""
        status.append(("TABLE", table.name, "failed" if message else "end", message or done, now()))
        if log is None:
            log = log_row(spark, table.name, 0, 0, started, detail)
        if plan.log_store is not None:
            with saving:  # files of one table, one writer at a time
                save_log(elapsed(log), plan.log_store, plan.log_table)
        return log

    def check(found: tuple[str, str, Callable[[], DataFrame | None]]) -> tuple[str, DataFrame | None]:
        kind, name, look = found
        try:
            bad = look()
            failed, message = bad is None or not bad.isEmpty(), NO_TABLE if bad is None else ""
        except Exception as error:
            bad, failed, message = None, True, _told(error)
        status.append((kind, name, "failed" if failed else "end", message, now()))
        return name, bad if failed else None

    with ThreadPoolExecutor(max_workers=max(1, plan.parallel)) as pool:
        logs = list(pool.map(load, tables))
    loaded = {name for kind, name, state, *_ in status if state == "end"}

    violations = {}
    if plan.mode != DATA:
        moved = [t for t in tables if t.name in loaded]
        with ThreadPoolExecutor(max_workers=max(1, plan.parallel)) as pool:
            found = pool.map(check, [c for t in moved for c in _checks(spark, plan, t)])
            violations = {name: bad for name, bad in found if bad is not None}
        status += [("AUTO INCREMENT COL", f"{t.name}.{t.identity}", "end", "", now()) for t in moved if t.identity]

    views = None
    if plan.mode in (FULL, METADATA) and plan.views is not None:
        views = plan.views if plan.objects is None else valid_only(
            plan.views, plan.objects, "view_name", "object_name", "object_type = 'VIEW' AND status = 'VALID'")
        views = rewrite_text(views, "text")

    log = reduce(DataFrame.unionByName, logs)
    names = [t.name for t in tables]
    ours = store_counts(spark, plan.source, names) if plan.source.kind == "jdbc" else row_counts(spark, sources)
    compared = compare_counts(ours, store_counts(spark, plan.target, [n for n in names if n in loaded]))
    if views is not None and plan.target_views is not None:
        there = compare_keys(views, plan.target_views, ["view_name"])
        compared = compared.unionByName(there.select(
            F.col("source_key").alias("source_table_name"), F.lit(None).cast("bigint").alias("source_rows"),
            F.lit("VIEW").alias("db_type"), F.col("target_key").alias("target_table_name"),
            F.lit(None).cast("bigint").alias("target_rows"), "is_success"))
    history = spark.createDataFrame(status, STATUS_DDL)
    if plan.log_store is not None:
        stamped = compared.withColumn("compare_time", F.lit(now()).cast("timestamp_ntz"))
        save_log(stamped, plan.log_store, plan.compare_table)
    return Run(log, transfer_report(log), compared, object_status(history), run_summary(history), mapping, views,
               violations)
