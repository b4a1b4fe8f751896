"""A transfer by pages that goes on where an earlier one stopped."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialise
from ..sources.store import Store, append, read_tables, replace
from .conform import REASON, flag, rejects
from .mapping import ColumnRule
from .paging import _add_bucket, _layout, _Layout, cut_key, page_of
from .transfer import LOG_DDL, now

PLAN, PAGES = "_plan", "_pages"
AT_ONCE = 256
MOST_RANGES = 64
_PLAN_DDL = "batch_no int, first_row bigint, rows bigint, page_size bigint, cut string, parts string"
_PAGES_DDL = "batch_no int, page_no bigint, source_rows bigint, target_rows bigint, task_start_time timestamp_ntz, task_end_time timestamp_ntz"


@dataclass(frozen=True)
class _Batches:
    """The batches of a transfer: ranges of the key that are cut once and kept."""

    first: list[int]  # rows before each batch
    rows: list[int]
    cuts: list[str]
    parts: list[str]
    page_size: int

    def layout(self, df: DataFrame, keys: Sequence[str]) -> _Layout:
        if not self.cuts:
            return _Layout(df.withColumn("_bucket", F.lit(0)), list(keys), {0: (self.rows[0], 0)} if self.rows else {})
        key, literal = cut_key(df, self.parts, len(self.parts) == 1)
        keyed = _add_bucket(df, key, self.cuts, literal)
        return _Layout(keyed, list(keys), {b: (n, 0) for b, n in enumerate(self.rows)}, key, self.cuts, literal, self.parts)

    def pages(self, spark: SparkSession, batches: Sequence[int]) -> DataFrame:
        """batch_no, page_no and source_rows: a page that a cut divides has a row in each of its batches."""
        some = spark.createDataFrame([(b, self.first[b], self.rows[b]) for b in batches if self.rows[b]],
                                     "batch_no int, first_row bigint, rows bigint")
        size, end = self.page_size, F.col("first_row") + F.col("rows")
        each = some.withColumn("page_no", F.explode(F.sequence(page_of(F.col("first_row") + 1, size), page_of(end, size))))
        rows = F.least(F.col("page_no") * size, end) - F.greatest((F.col("page_no") - 1) * size, F.col("first_row"))
        return each.select("batch_no", "page_no", rows.alias("source_rows"))


def _batches(df: DataFrame, ledger: Store, name: str, keys: Sequence[str], page_size: int, wanted: int | None) -> _Batches:
    """The batches kept in the ledger; on the first call they are cut and kept."""
    spark = df.sparkSession
    kept = read_tables(spark, ledger, [name + PLAN])[name + PLAN]
    if kept is None:
        made = _layout(df.select(*[F.col(f"`{k}`") for k in keys]), keys, True, wanted)
        starts = made.starts()
        rows = [(b, first, made.counts.get(b, (0, 0))[0], page_size, made.cuts[b - 1] if b else None, json.dumps(list(made.parts)))
                for b, first in enumerate(starts)]
        replace(spark.createDataFrame(rows, _PLAN_DDL).coalesce(1), ledger, name + PLAN)
        kept = read_tables(spark, ledger, [name + PLAN])[name + PLAN]
    # One row for each batch, of which there are as many as buckets of a paged table at most.
    found = sorted(kept.collect(), key=lambda r: r.batch_no)
    if any(r.page_size != page_size for r in found):
        raise ValueError(f"{name} was begun with pages of {found[0].page_size} rows")
    return _Batches([r.first_row for r in found], [r.rows for r in found], [r.cut for r in found[1:]],
                    json.loads(found[0].parts) if found else [], page_size)


def _arrived(spark: SparkSession, store: Store, ledger: Store, name: str) -> DataFrame:
    """The pages of the ledger that the target has, with all rows it counted."""
    target, done = read_tables(spark, store, [name])[name], read_tables(spark, ledger, [name + PAGES])[name + PAGES]
    if done is None:
        return spark.createDataFrame([], _PAGES_DDL)
    last = done.groupBy("batch_no", "page_no").agg(F.max(F.struct("task_end_time", "task_start_time", "source_rows", "target_rows")).alias("r"))
    last = last.select("batch_no", "page_no", "r.source_rows", "r.target_rows", "r.task_start_time", "r.task_end_time")
    if target is None:
        return last.where("target_rows = 0")
    there = target.groupBy(F.col("batch_no").cast("int").alias("b"), F.col("page_no").alias("p")).agg(F.count("*").alias("n"))
    both = last.join(there, (last.batch_no == there.b) & (last.page_no == there.p), "left")
    return both.where(F.coalesce("n", F.lit(0)) == F.col("target_rows")).select(*last.columns)


def _keep(df: DataFrame, store: Store, name: str) -> None:
    """Write the batches of ``df`` in the place of what the table has of them, others stay."""
    (df.write.format(store.fmt).options(**store.options).option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch_no").mode("overwrite").save(store.path(name)))


def _move(rows: DataFrame, store: Store, name: str, rules: Sequence[ColumnRule] | None, reject_store: Store | None,
          options: dict[str, bool]) -> int:
    """Write rows that fit, and the others with a reason; how many there were."""
    seen, places = Observation(), ["page_no", "batch_no"]
    if rules is None:
        _keep(rows.observe(seen, F.count("*").alias("rows")), store, name)
        return seen.get["rows"]
    named = {r.name.upper() for r in rules}
    flagged = flag(rows.select(*[F.col(f"`{c}`") for c in rows.columns if c.upper() in named or c in places]), rules, places, **options)
    bad = F.count_if(F.col(REASON).isNotNull()).alias("bad")
    _keep(flagged.observe(seen, F.count("*").alias("rows"), bad).where(F.col(REASON).isNull()).drop(REASON), store, name)
    if reject_store is not None and seen.get["bad"]:
        _keep(rejects(rows, rules, **options), reject_store, name)
    return seen.get["rows"]


def transfer_resumed(df: DataFrame, store: Store, name: str, keys: Sequence[str], page_size: int, ledger: Store,
                     rules: Sequence[ColumnRule] | None = None, reject_store: Store | None = None, batches: int | None = None,
                     at_once: int = AT_ONCE, limit: int | None = None, **options: bool) -> DataFrame:
    """Write the table in pages and log them; called again, move only what has not arrived.

    ``keys`` name a row. The first call cuts their order into batches and keeps the cuts in the ledger, so a
    row belongs to the same batch and page in every call. A batch is a folder of the target, written whole,
    in one job for ``at_once`` batches; after it, its pages go to the ledger. A call first takes from the plan
    the pages that the ledger has and the target still holds; the batches of those left are read by their
    ranges of the key and written in the place of what was there. So a call that stops anywhere
    leaves no page twice, and pages lost from the target come back. ``limit`` ends a call after so many batches.

    Rows that do not fit ``rules`` are kept in ``reject_store`` by batch in the same way. A source
    whose number of rows in a batch has changed is an error: its pages would not meet. The target is a
    file store; its table has the columns ``page_no`` and ``batch_no``.
    """
    if store.kind != "files":
        raise ValueError("a transfer is resumed in a file store")
    spark = df.sparkSession
    plan = _batches(df, ledger, name, keys, page_size, batches)
    pages = plan.pages(spark, range(len(plan.rows)))
    arrived = materialise(_arrived(spark, store, ledger, name).select("batch_no", "page_no"), "arrived")
    missing = [r.batch_no for r in pages.join(arrived, ["batch_no", "page_no"], "left_anti").select("batch_no").distinct().collect()]
    missing = sorted(missing)[:limit]
    layout = plan.layout(df, keys)
    in_order = Window.partitionBy("_bucket").orderBy(*[F.col(f"`{k}`") for k in keys])
    for at in range(0, len(missing), at_once):
        some, started = missing[at:at + at_once], now()
        wanted = F.array(*[F.lit(b in set(some)) for b in range(len(plan.rows))])
        rows = layout.keyed.where(F.get(wanted, F.col("_bucket")) & _ranges(layout, some))
        first = F.get(F.array(*[F.lit(n).cast("bigint") for n in plan.first]), F.col("_bucket"))
        numbered = rows.withColumn("page_no", page_of(first + F.row_number().over(in_order), page_size))
        numbered = numbered.select(*[F.col(f"`{c}`") for c in df.columns], "page_no", F.col("_bucket").cast("int").alias("batch_no"))
        count, planned = _move(numbered, store, name, rules, reject_store, options), sum(plan.rows[b] for b in some)
        if count != planned:
            raise ValueError(f"{name} has {count} rows where {planned} were planned: its source has changed")
        target = read_tables(spark, store, [name])[name]
        written = target.where(F.col("batch_no").isin(some)).groupBy(F.col("batch_no").cast("int").alias("b"), F.col("page_no").alias("p")).agg(
            F.count("*").alias("n"))
        part = plan.pages(spark, some)
        moved = part.join(written, (part.batch_no == written.b) & (part.page_no == written.p), "left").select(
            "batch_no", "page_no", "source_rows", F.coalesce("n", F.lit(0)).alias("target_rows"),
            F.lit(started).cast("timestamp_ntz").alias("task_start_time"), F.lit(now()).cast("timestamp_ntz").alias("task_end_time"))
        append(moved.coalesce(1), ledger, name + PAGES)
    done = _arrived(spark, store, ledger, name).select(
        F.col("batch_no").alias("b"), F.col("page_no").alias("p"), "target_rows", "task_start_time", "task_end_time")
    log = pages.join(done, (pages.batch_no == done.b) & (pages.page_no == done.p), "left").groupBy("page_no").agg(
        F.sum("source_rows").alias("source_table_rows"), F.coalesce(F.sum("target_rows"), F.lit(0)).alias("target_table_rows"),
        F.min("task_start_time").alias("task_start_time"), F.max("task_end_time").alias("task_end_time"))
    columns = [c.split()[0] for c in LOG_DDL.split(", ")]
    return log.withColumns({"table_name": F.lit(name), "type": F.lit("TABLE"), "detail": F.lit("")}).select(*columns)


def _ranges(layout: _Layout, batches: Sequence[int]):
    """The batches as ranges of the key, which a scan can use to skip data."""
    runs: list[list[int]] = []
    for b in batches:
        if runs and runs[-1][1] == b - 1:
            runs[-1][1] = b
        else:
            runs.append([b, b])
    if len(runs) > MOST_RANGES:
        runs = [[batches[0], batches[-1]]]
    found = F.lit(False)
    for low, high in runs:
        found = found | layout.between(low, high)
    return found
