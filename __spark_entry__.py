
from __future__ import annotations

import logging
import sys
from collections.abc import Callable
from functools import reduce, wraps
from importlib import import_module
from pathlib import Path
from types import ModuleType

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import tableflow as tf  # noqa: E402
from oracle_queries import (  # noqa: E402
    CATALOGUE,
    CONSTRAINT_TYPE,
    DEFINITION_TEXT,
    INDEX_FACTS,
    NAME_LINES,
    ORACLES,
    TABLES,
    TRIGGER_TEXT,
    TRIGGERS,
    VIEW_TEXT,
)
from tableflow.operators.mapping import ColumnRule  # noqa: E402
from tableflow.operators.paging import page_count, page_range  # noqa: E402
from tableflow.session import own_folder  # noqa: E402
from tableflow.sources.store import key_cuts, range_predicates  # noqa: E402

def _optional(name: str) -> ModuleType | None:
    """A part that may be absent, or lack what it needs: the other queries work without it."""
    try:
        return import_module(name)
    except Exception as error:  # whatever its import meets
        logging.getLogger(__name__).warning("%s is left out: %s: %s", name, type(error).__name__, error)
        return None


llm = _optional("tableflow.llm.queries")
corpus_pipeline = _optional("corpus_pipeline")

SMALL = "/root/testdata/sf0.001"


def _store(sf: str) -> tf.Store:
    return tf.parquet_store(sf, ".parquet")


def _t(spark: SparkSession, sf: str, name: str, *columns: str) -> DataFrame:
    return tf.read_table(spark, _store(sf), name, columns or None)


def _all(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {name: _t(spark, sf, name) for name in TABLES}


def _scratch(spark: SparkSession, label: str) -> tf.Store:
    return tf.parquet_store(tf.fresh_path(spark, label))


def _rules(df: DataFrame, **other: ColumnRule) -> list[ColumnRule]:
    """A rule for every column: its own type, or the one named."""
    return [other.get(f.name) or ColumnRule(f.name, f.dataType.simpleString()) for f in df.schema]


# ---- sources and sinks ---------------------------------------------------------------

def scan_counts(spark, sf):
    return tf.row_counts(spark, _all(spark, sf))


def range_scan(spark, sf):
    cuts = key_cuts(_t(spark, sf, "orders", "o_orderkey"), "o_orderkey", 8)
    rows = tf.read_pages(spark, _store(sf), "orders", range_predicates("o_orderkey", cuts))
    return rows.groupBy("o_orderstatus").agg(F.count("*").alias("row_count"))


def range_scan_text(spark, sf):
    """Rows by language, and how many of the ranges of (lang, source, doc_id) they lie in: one each."""
    docs, keys = _t(spark, sf, "documents", "lang", "source", "doc_id"), ["lang", "source", "doc_id"]
    ranges = tf.tuple_predicates(keys, tf.tuple_cuts(docs, keys, 16))
    hits = reduce(Column.__add__, [F.expr(p).cast("bigint") for p in ranges])
    return docs.groupBy("lang").agg(F.count("*").alias("row_count"), F.sum(hits).alias("range_count"))


def name_list(spark, sf):
    lines = _t(spark, sf, "orders").selectExpr(NAME_LINES + " AS value")
    return tf.name_list(lines).groupBy("name").agg(F.count("*").alias("lines"))


def restrict_to_list(spark, sf):
    lines = spark.createDataFrame([(" SRC3 ",), ("",), ("Src7,other",), ("   ",), ("nosuch",)], "value string")
    return tf.restrict_to_list(_t(spark, sf, "documents", "doc_id", "source"), "source", tf.name_list(lines))


def load_append(spark, sf):
    store, customer = _scratch(spark, "append"), _t(spark, sf, "customer")
    tf.replace(customer, store, "customer")
    tf.append(customer, store, "customer")
    return tf.read_table(spark, store, "customer", ["c_custkey"]).agg(
        F.count("*").alias("row_count"), F.sum("c_custkey").alias("key_sum"))


def load_truncate(spark, sf):
    store = _scratch(spark, "truncate")
    tf.replace(_t(spark, sf, "orders"), store, "orders")
    some = _t(spark, sf, "orders").where("o_orderstatus = 'F'").select("o_orderstatus", "o_orderkey")
    tf.truncate_load(some, store, "orders")
    return tf.read_table(spark, store, "orders").groupBy("o_orderstatus").agg(
        F.count("*").alias("row_count"), F.sum("o_orderkey").alias("key_sum"), F.count("o_totalprice").alias("prices"))


def save_csv(spark, sf):
    path = tf.fresh_path(spark, "csv")
    tf.save_csv(run_summary(spark, sf), path)
    return spark.read.schema("kind string, total bigint, success bigint, failed bigint").csv(path, header=True)


def save_log(spark, sf):
    """A compare result kept twice and read back."""
    store = _scratch(spark, "log")
    for _ in range(2):
        tf.save_log(compare_counts(spark, sf), store, "log")
    return tf.read_table(spark, store, "log").groupBy("source_table_name", "is_success").agg(F.count("*").alias("kept"))


def read_types(spark, sf):
    types = {"l_extendedprice": "decimal(12,1)", "l_quantity": "int", "l_orderkey": "string"}
    rows = tf.read_table(spark, _store(sf), "lineitem", ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"], types)
    return rows.withColumn("l_extendedprice", F.col("l_extendedprice").cast("double"))


def column_catalogue(spark, sf):
    return tf.column_catalogue(spark, _store(sf), TABLES).select(
        "table_name", "column_id", "column_name", "data_type", "data_precision", "data_scale")


def measured_catalogue(spark, sf):
    return tf.measured_catalogue(spark, _all(spark, sf)).select(
        "table_name", "column_name", "char_length", "avg_col_len")


# ---- profile and mapping -------------------------------------------------------------

# The catalogue has one column description per line item.

def _catalogue(spark, sf, *more):
    return _t(spark, sf, "lineitem").selectExpr(*CATALOGUE, *more)


MAPPED = ("table_name", "column_id", "column_name", "target_type", "spark_type", "max_length", "target_default", "rule")


def map_types(spark, sf):
    return tf.map_types(_catalogue(spark, sf)).select(*MAPPED)


def map_types_measured(spark, sf):
    """Types of all tables, chosen from lengths and ranges read from their data."""
    tables = _all(spark, sf)
    profile = reduce(DataFrame.unionByName, [
        tf.number_widths(df).withColumn("table_name", F.lit(name)) for name, df in tables.items()])
    return tf.map_types(tf.measured_catalogue(spark, tables), profile=profile).select(
        "table_name", "column_id", "column_name", "target_type", "max_length", "rule")


def map_notes(spark, sf):
    """Nullability and comments go through the mapping into a target's schema."""
    described = _catalogue(spark, sf, "l_linestatus").withColumn(
        "comments", F.concat(F.lit('line "'), "l_linestatus", F.lit('"')))
    return tf.map_types(described).select("table_name", "column_id", "column_name", "nullable", "comments")


def map_types_compat(spark, sf):
    return tf.map_types(_catalogue(spark, sf), compat=True).select(*MAPPED)


def clean_defaults(spark, sf):
    return (tf.clean_defaults(_catalogue(spark, sf)).groupBy("data_type", "data_default", "target_default")
            .agg(F.count("*").alias("row_count")))


def clean_defaults_compat(spark, sf):
    return (tf.clean_defaults(_catalogue(spark, sf), compat=True)
            .groupBy("data_type", "data_default", "target_default").agg(F.count("*").alias("row_count")))


def fit_row_width(spark, sf):
    widths = (_t(spark, sf, "lineitem").groupBy(
        F.concat(F.lit("T"), "l_orderkey").alias("table_name"), F.concat(F.lit("C"), "l_partkey").alias("column_name"))
        .agg(F.max("l_quantity").cast("int").alias("width")))
    return tf.fit_row_width(_catalogue(spark, sf), widths).select(
        "table_name", "column_id", "column_name", "fitted_length", "narrowed")


def fit_row_width_least(spark, sf):
    widths = (_t(spark, sf, "lineitem").groupBy(
        F.concat(F.lit("T"), "l_orderkey").alias("table_name"), F.concat(F.lit("C"), "l_partkey").alias("column_name"))
        .agg(F.max("l_quantity").cast("int").alias("width")))
    return tf.fit_row_width_least(_catalogue(spark, sf), widths, 9_000).select(
        "table_name", "column_id", "column_name", "fitted_length", "narrowed", "fits")


def text_widths(spark, sf):
    return reduce(DataFrame.unionByName, [
        tf.text_widths(df).select(F.lit(name).alias("table_name"), "*") for name, df in _all(spark, sf).items()])


def profile_merged(spark, sf):
    """Profiles of the documents by source: those of some sources are kept, those of the others come later."""
    docs = _t(spark, sf, "documents")
    first = tf.materialise(tf.profile_parts(docs.where("source < 'src5'"), "source"), "profile")
    return tf.merged_profile(tf.profile_again(docs, "source", first)).drop("distinct_estimate", "quartiles")


def number_widths(spark, sf):
    every = [tf.number_widths(df).select(
        F.lit(name).alias("table_name"), "column_name", "avg_length", F.col("min_value").cast("double").alias("min_value"),
        F.col("max_value").cast("double").alias("max_value"), "max_scale", "inexact") for name, df in _all(spark, sf).items()]
    return reduce(DataFrame.unionByName, every)


def _event_rules(events: DataFrame) -> list[ColumnRule]:
    return _rules(events, event_id=ColumnRule("event_id", "bigint", nullable=False), ts=ColumnRule("ts", "timestamp_ntz"),
                  event_type=ColumnRule("event_type", "string", max_length=6), value=ColumnRule("value", "decimal(4,2)"))


def conform_rows(spark, sf):
    events = _t(spark, sf, "events")
    good, _ = tf.conform(events, _event_rules(events))
    return good.withColumns({"ts": F.col("ts").cast("string"), "value": F.col("value").cast("double")})


def reject_rows(spark, sf):
    events = _t(spark, sf, "events")
    _, bad = tf.conform(events, _event_rules(events))
    return bad.withColumn("ts", F.col("ts").cast("string"))


def conform_fractions(spark, sf):
    """Fractions do not become whole numbers: such rows are rejected, with the reason."""
    lineitem = _t(spark, sf, "lineitem")
    rules = _rules(lineitem, l_extendedprice=ColumnRule("l_extendedprice", "bigint"), l_discount=ColumnRule("l_discount", "int"))
    good, bad = tf.conform(lineitem, rules)
    keys = ["l_orderkey", "l_linenumber", F.col("l_extendedprice").cast("double").alias("price")]
    return good.select(*keys, F.lit(None).cast("string").alias("reject_reason")).unionByName(bad.select(*keys, "reject_reason"))


def common_columns(spark, sf):
    src = _catalogue(spark, sf)
    tgt = _t(spark, sf, "lineitem").where("l_linestatus = 'O'").select(
        F.concat(F.lit(" t"), "l_orderkey").alias("table_name"), F.concat(F.lit("c"), "l_partkey").alias("column_name"))
    return tf.common_columns(src, tgt).select("table_name", "column_id", "column_name")


def load_common_columns(spark, sf):
    store = _scratch(spark, "common")
    shape = "O_ORDERPRIORITY string, o_comment string, o_orderkey bigint, o_custkey bigint"
    tf.replace(spark.createDataFrame([], shape), store, "orders")
    tf.load_common_columns(_t(spark, sf, "orders"), store, "orders")
    return tf.read_table(spark, store, "orders").select(
        "o_orderkey", "o_custkey", F.col("O_ORDERPRIORITY").alias("o_orderpriority"), "o_comment")


# ---- paging and transfer -------------------------------------------------------------

def page_plan(spark, sf):
    return tf.page_bounds(scan_counts(spark, sf), 1000)


def page_rows(spark, sf):
    paged = tf.with_pages(_t(spark, sf, "orders", "o_orderkey"), ["o_orderkey"], 1000, unique=True, buckets=24)
    return paged.groupBy("page_no").agg(
        F.count("*").alias("row_count"), F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key"))


def page_rows_copies(spark, sf):
    """Three keys hold all rows, and rows repeat: the hot groups are counted, not sorted."""
    rows = _t(spark, sf, "lineitem", "l_returnflag", "l_linestatus")
    paged = tf.with_pages(rows, ["l_returnflag", "l_linestatus"], 1000, buckets=32)
    return paged.groupBy("page_no", "l_returnflag", "l_linestatus").agg(
        F.count("*").alias("row_count"), F.min("row_no").alias("first_row"), F.max("row_no").alias("last_row"))


def page_slice(spark, sf):
    lineitem = _t(spark, sf, "lineitem")
    rows = tf.page_slice(lineitem, lineitem.columns, 5001, 6000, buckets=40)
    return rows.withColumn("l_shipdate", F.col("l_shipdate").cast("date").cast("string"))


def transfer_log(spark, sf):
    log = tf.transfer(_t(spark, sf, "orders"), _scratch(spark, "transfer"), "orders", ["o_orderkey"], 1000, unique=True,
                      buckets=24)
    return log.select("table_name", "page_no", "source_table_rows", "target_table_rows", "type")


def transfer_resumed(spark, sf):
    """A transfer that ends after some batches, goes on, loses pages, and goes on again."""
    orders, target, ledger = _t(spark, sf, "orders"), _scratch(spark, "resumed"), _scratch(spark, "ledger")
    how = {"page_size": 1000, "ledger": ledger, "batches": 8}
    tf.transfer_resumed(orders, target, "orders", ["o_orderkey"], limit=3, **how)
    pages = tf.materialise(tf.read_table(spark, ledger, "orders_pages"))
    tf.replace(pages.where("batch_no <> 1"), ledger, "orders_pages")
    log = tf.transfer_resumed(orders, target, "orders", ["o_orderkey"], **how)
    there = tf.read_table(spark, target, "orders").groupBy(F.col("page_no").alias("p")).agg(
        F.sum("o_orderkey").alias("key_sum"), F.min("o_orderkey").alias("first_key"))
    return log.join(there, F.col("page_no") == F.col("p")).select("page_no", "source_table_rows", "target_table_rows", "key_sum", "first_key")


def page_numbers(spark, sf):
    """First and last row of pages given as text: numbers, 0 and texts that are none."""
    asked = _t(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderstatus"))
        .otherwise((F.col("o_orderkey") % 50).cast("string")).alias("page"))
    bounds = page_range(F.col("page"), F.lit("1000"))
    return asked.select("o_orderkey", bounds["start_row"].alias("start_row"), bounds["end_row"].alias("end_row"))


def page_counts_compat(spark, sf):
    return scan_counts(spark, sf).select(
        "table_name", page_count(F.col("row_count"), 1000).alias("pages"),
        page_count(F.col("row_count"), 1000, compat=True).alias("pages_compat"))


def _logs(spark, sf):
    """Log of three transfers; rows of part and orders that do not fit are left out."""
    store = _scratch(spark, "transfer")
    moves = {"customer": ("c_custkey", {}), "orders": ("o_orderkey", {"o_totalprice": ColumnRule("o_totalprice", "decimal(7,2)")}),
             "part": ("p_partkey", {"p_name": ColumnRule("p_name", "string", max_length=9)})}
    return reduce(DataFrame.unionByName, [
        tf.transfer(df := _t(spark, sf, name), store, name, [key], 500, unique=True, rules=_rules(df, **other), buckets=8)
        for name, (key, other) in moves.items()])


def transfer_status(spark, sf):
    return tf.transfer_status(_logs(spark, sf)).select(
        "table_name", "source_table_rows", "target_table_rows", "is_success")


def transfer_report(spark, sf):
    missing = spark.createDataFrame([("absent",)], "table_name string")
    return tf.transfer_report(tf.materialise(_logs(spark, sf), "log"), missing, numbered=True)


def copy_log(spark, sf):
    rejected, target = _scratch(spark, "rejected"), _scratch(spark, "copy")
    events = _t(spark, sf, "events")
    log = tf.copy_table(events, target, "events", rules=_event_rules(events), reject_store=rejected)
    found = tf.read_table(spark, rejected, "events").agg(F.count("*").alias("rejected_rows"))
    written = tf.read_table(spark, target, "events").agg(F.count("*").alias("written_rows"))
    counts = log.select("table_name", "source_table_rows", "target_table_rows")
    return counts.join(found.withColumn("table_name", F.lit("events")), "table_name").join(
        written.withColumn("table_name", F.lit("events")), "table_name")


def task_elapsed(spark, sf):
    tasks = _t(spark, sf, "events", "user_id", "ts").groupBy("user_id").agg(
        F.min("ts").alias("task_start_time"), F.max("ts").alias("task_end_time"))
    return tf.elapsed(tasks).select("user_id", "run_time")


def zoned_elapsed(spark, sf):
    """Times of a zone, each an instant, in place of wall clock times."""
    tasks = _t(spark, sf, "events", "user_id", "ts").groupBy("user_id").agg(
        *[F.concat(end("ts").cast("string"), F.lit("Z")).cast("timestamp").alias(name)
          for end, name in ((F.min, "task_start_time"), (F.max, "task_end_time"))])
    later = tasks.withColumn("task_end_time", F.col("task_end_time") + F.expr("INTERVAL 90 SECONDS"))
    return tf.elapsed(later).select("user_id", "run_time")


def _plan(spark, sf, mode, **more):
    tables = [
        tf.TablePlan("customer", ["c_custkey"], ["c_custkey"]),
        tf.TablePlan("orders", ["o_orderkey"], ["o_orderkey"], not_null=["o_custkey"],
                     references=[tf.Reference(["o_custkey"], "customer", ["c_custkey"])]),
        tf.TablePlan("lineitem", primary_key=["l_orderkey", "l_linenumber"],
                     references=[tf.Reference(["l_orderkey"], "orders", ["o_orderkey"])]),
        tf.TablePlan("absent"),
    ]
    return tf.Plan(_store(sf), _scratch(spark, mode), tables, mode=mode, **more)


def run_full(spark, sf):
    """Report, compare and summary of one run, a line each."""
    done = tf.run(spark, _plan(spark, sf, "full"))
    parts = {"report": done.report.drop("id"), "compare": done.compare, "summary": done.summary}

    def lines(part: str, df: DataFrame) -> DataFrame:
        shown = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in df.columns]
        return df.select(F.lit(part).alias("part"), F.concat_ws("|", *shown).alias("line"))

    return reduce(DataFrame.unionByName, [lines(part, df) for part, df in parts.items()])


def run_failing(spark, sf):
    """A table that is not there, one whose values do not fit, and a key that no table has."""
    tables = [tf.TablePlan("customer", primary_key=["nosuch"]), tf.TablePlan("orders", primary_key=["o_orderkey"]), tf.TablePlan("absent")]
    described = tf.catalogue_of(spark, {t.name: _t(spark, sf, t.name) for t in tables[:2]}).withColumn(
        "data_type", F.when(F.col("column_name") == "o_totalprice", "NUMBER").otherwise(F.col("data_type")))
    done = tf.run(spark, tf.Plan(_store(sf), _scratch(spark, "failing"), tables, catalogue=described,
                                 reject_store=_scratch(spark, "rejects")))
    report = done.report.select(F.lit("TABLE").alias("kind"), F.col("table_name").alias("name"), "target_table_rows",
                                F.col("run_detail").alias("outcome"))
    checks = done.status.where("kind = 'CONSTRAINT INDEX'").select(
        "kind", "name", F.lit(None).cast("bigint").alias("target_table_rows"), F.col("status").alias("outcome"))
    return report.unionByName(checks)


def run_decimals(spark, sf):
    """A number whose target has fewer places: what would be rounded is a reject, and the compare tells."""
    described = tf.catalogue_of(spark, {"orders": _t(spark, sf, "orders")})
    price = F.col("column_name") == "o_totalprice"
    described = described.withColumns({"data_type": F.when(price, "NUMBER").otherwise(F.col("data_type")),
                                       "data_precision": F.when(price, 12).otherwise(F.col("data_precision")),
                                       "data_scale": F.when(price, 1).otherwise(F.col("data_scale"))})
    target, lost = _scratch(spark, "decimals"), _scratch(spark, "rejects")
    done = tf.run(spark, tf.Plan(_store(sf), target, [tf.TablePlan("orders", order=["o_orderkey"], primary_key=["o_orderkey"])],
                                 catalogue=described, reject_store=lost))
    rows = done.compare.select(F.col("source_table_name").alias("name"), "source_rows", "target_rows", F.col("is_success").alias("outcome"))
    kept = tf.read_table(spark, lost, "orders").groupBy(F.col("reject_reason").alias("name")).agg(F.count("*").alias("source_rows"))
    return rows.unionByName(kept.select("name", "source_rows", F.lit(0).cast("bigint").alias("target_rows"), F.lit("rejected").alias("outcome")))


def run_metadata(spark, sf):
    """Tables made without rows: the columns they have."""
    plan = _plan(spark, sf, "metadata")
    tf.run(spark, plan)
    return tf.column_catalogue(spark, plan.target, ["customer", "orders", "lineitem"]).select(
        "table_name", "column_id", "column_name", "data_type")


def run_views(spark, sf):
    """Views by name on both sides, beside the tables."""
    views = _t(spark, sf, "documents").selectExpr("concat('v', doc_id) AS view_name", "concat('select nvl(', source, ',0)') AS text")
    there = _t(spark, sf, "labels").where("quality = 1").selectExpr("concat('V', doc_id) AS view_name")
    plan = tf.Plan(_store(sf), _scratch(spark, "views"), [tf.TablePlan("region")], views=views, target_views=there)
    return tf.run(spark, plan).compare


def run_listed(spark, sf):
    return tf.run(spark, _plan(spark, sf, "listed", names=[" Orders ", "", "lineitem,x"])).report.drop("id")


def run_data(spark, sf):
    plan = _plan(spark, sf, "data", names=["orders", "customer"], reject_store=_scratch(spark, "rejects"))
    for name, shape in {"orders": "o_orderkey bigint, extra int, o_totalprice decimal(7,2)", "customer": "c_custkey bigint"}.items():
        tf.replace(spark.createDataFrame([], shape), plan.target, name)
    done = tf.run(spark, plan)
    return done.compare


# ---- keys and references -------------------------------------------------------------

def ordered_list(spark, sf):
    return tf.ordered_list(_t(spark, sf, "lineitem"), ["l_orderkey"], "l_partkey", ["l_linenumber", "l_partkey"],
                           name="part_list")


def ordered_parts(spark, sf):
    """Three lists of all line items, one with half of them, in parts of 1,000."""
    return tf.ordered_parts(_t(spark, sf, "lineitem"), ["l_returnflag"], "l_partkey", ["l_shipdate", "l_orderkey"], 1_000,
                            name="part_list")


def key_columns(spark, sf):
    lineitem, orders = _t(spark, sf, "lineitem"), _t(spark, sf, "orders")
    columns = lineitem.selectExpr("concat('T', l_suppkey) AS table_name", "concat('I', l_orderkey) AS index_name",
                                  "concat('C', l_partkey) AS column_name", "l_linenumber AS column_position")
    indexes = orders.selectExpr("concat('I', o_orderkey) AS index_name", *INDEX_FACTS)
    constraints = orders.where("o_totalprice > 200000").selectExpr(
        "concat('I', o_orderkey) AS constraint_name", CONSTRAINT_TYPE)
    return tf.key_columns(columns, indexes, constraints)


def foreign_keys(spark, sf):
    lineitem, orders = _t(spark, sf, "lineitem"), _t(spark, sf, "orders")
    constraints = orders.selectExpr(
        "concat('K', o_orderkey) AS constraint_name", "concat('T', o_custkey) AS table_name", CONSTRAINT_TYPE,
        "concat('K', o_custkey) AS r_constraint_name")
    columns = lineitem.selectExpr("concat('K', l_orderkey) AS constraint_name",
                                  "concat('C', l_partkey) AS column_name", "l_linenumber AS position")
    return tf.foreign_keys(constraints, columns)


def check_primary_key(spark, sf):
    return tf.check_primary_key(_t(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def check_unique(spark, sf):
    twice = tf.check_unique(_t(spark, sf, "documents", "text"), ["text"], wide_keys=True)
    return twice.select(F.md5("text").alias("text_md5"), "row_count")


def check_not_null(spark, sf):
    labelled = _t(spark, sf, "orders").join(
        _t(spark, sf, "labels"), F.col("o_orderkey") == F.col("doc_id"), "left")
    return tf.check_not_null(labelled, ["o_orderkey", "o_custkey", "doc_id", "quality", "toxic"])


def _some_orders(spark, sf):
    return _t(spark, sf, "orders").where("o_orderstatus <> 'F'")


def orphan_rows(spark, sf):
    lost = tf.orphan_rows(_t(spark, sf, "lineitem"), _some_orders(spark, sf), ["l_orderkey"], ["o_orderkey"])
    return lost.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")


def orphan_summary(spark, sf):
    return tf.orphan_summary(_t(spark, sf, "lineitem"), _some_orders(spark, sf), ["l_orderkey"], ["o_orderkey"])


def assign_ids(spark, sf):
    customer = _t(spark, sf, "customer", "c_custkey", "c_name", "c_mktsegment")
    without = customer.withColumn("c_custkey", F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_custkey")))
    return tf.assign_ids(without, "c_custkey", ["c_name"], unique=True)


def assign_ids_again(spark, sf):
    """Ids of the customers and priorities of some orders, then of all: the first ones stay."""
    store, orders = _scratch(spark, "ids"), _t(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderpriority")
    keyed = orders.withColumn("o_orderpriority", F.when(F.col("o_orderkey") % 5 > 0, F.col("o_orderpriority")))
    keys = ["o_custkey", "o_orderpriority"]
    tf.known_ids(keyed.where("o_orderkey % 3 = 0"), store, "customer_ids", keys)
    return tf.assign_ids_again(keyed, store, "customer_ids", keys).select("o_orderkey", "id")


def _references(spark, sf):
    """References between tables named by customers: stars, chains, circles of three and of one."""
    orders = _t(spark, sf, "orders", "o_custkey").selectExpr("o_custkey AS c", "o_custkey DIV 50 AS b", "(o_custkey DIV 10) % 5 AS r")
    first = orders.selectExpr(
        "c", "CASE WHEN c % 10 <> 0 THEN c - c % 10 WHEN r = 0 THEN b DIV 2 * 50 WHEN r = 4 THEN c WHEN r = 3 THEN c - 20 ELSE c + 10 END AS p")
    second = orders.where("c % 10 = 0 AND r = 1").selectExpr("c", "b * 50 AS p")
    return first.unionByName(second).selectExpr("concat('T', c) AS child_table", "concat('T', p) AS parent_table")


def load_order(spark, sf):
    return tf.load_order(_references(spark, sf), _t(spark, sf, "customer").selectExpr("concat('T', c_custkey) AS table_name"))


def text_between(spark, sf):
    return tf.text_between(_t(spark, sf, "pages"), "html", "<title>", "</title>", "title").select("page_id", "title")


def _triggers(spark, sf):
    return _t(spark, sf, "orders").selectExpr(*TRIGGERS)


def identity_columns(spark, sf):
    return tf.identity_columns(_triggers(spark, sf))


def identity_count(spark, sf):
    return tf.identity_count(_triggers(spark, sf))


# ---- compare and report --------------------------------------------------------------

def compare_counts(spark, sf):
    source = _all(spark, sf)
    target = {name: df for name, df in source.items() if name != "region"}
    target["orders"] = target["orders"].where("o_orderstatus <> 'F'")
    return tf.compare_counts(tf.row_counts(spark, source), tf.row_counts(spark, target), exclude=["benchmark"])


def compare_failures(spark, sf):
    return tf.failures(compare_counts(spark, sf))


def compare_keys(spark, sf):
    urgent = _t(spark, sf, "orders").where("o_orderpriority = '1-URGENT'")
    return tf.compare_keys(_t(spark, sf, "customer"), urgent, ["c_custkey"], ["o_custkey"])


def compare_content(spark, sf):
    """All order lines against a copy in which some are lost, some added and some changed."""
    lines = _t(spark, sf, "lineitem")
    other = (lines.where("l_orderkey % 97 <> 0").unionByName(lines.where("l_orderkey % 103 = 0").withColumn("l_orderkey", -F.col("l_orderkey")))
             .withColumns({"l_quantity": F.when(F.col("l_partkey") % 101 == 0, F.col("l_quantity") + 1).otherwise(F.col("l_quantity")),
                           "l_linenumber": F.col("l_linenumber").cast("bigint")}))
    return tf.compare_content(lines, other, ["l_orderkey", "l_linenumber"])


def exists_in(spark, sf):
    events = _t(spark, sf, "events")
    return reduce(DataFrame.unionByName, [
        tf.exists_in(events, "event_type", kind, "user_id").withColumn("event_type", F.lit(kind))
        for kind in ("click", "nosuch")])


def object_status(spark, sf):
    return tf.object_status(_t(spark, sf, "orders").selectExpr(
        "o_orderpriority AS kind", "concat('customer ', o_custkey) AS name", "o_orderstatus AS status",
        "concat('order ', o_orderkey) AS message", "o_orderdate AS ts"))


def run_summary(spark, sf):
    return tf.run_summary(_t(spark, sf, "orders").selectExpr(
        "o_orderpriority AS kind", "concat('customer ', o_custkey) AS name",
        "CASE o_orderstatus WHEN 'F' THEN 'failed' ELSE 'end' END AS status"))


def count_by_kind(spark, sf):
    return tf.count_by_kind(_t(spark, sf, "part"), "p_type", "p_name", "small%")


# ---- text ----------------------------------------------------------------------------

def _digest(df: DataFrame, col: str) -> DataFrame:
    return df.select("doc_id", F.length(col).cast("bigint").alias("chars"), F.md5(col).alias("digest"))


def rewrite_text(spark, sf):
    rules = [("e", "E"), ("Ea", "ea"), ("--", "-- -- ")]
    return _digest(tf.rewrite_text(_t(spark, sf, "documents"), "text", rules), "text")


def rewrite_views(spark, sf):
    views = _t(spark, sf, "documents").withColumn("text", F.expr(VIEW_TEXT))
    return _digest(tf.rewrite_text(views, "text"), "text")


def rewrite_views_lexed(spark, sf):
    views = _t(spark, sf, "documents").withColumn("text", F.expr(VIEW_TEXT))
    return _digest(tf.rewrite_code(views, "text"), "text")


def normalise_text(spark, sf):
    texts = _t(spark, sf, "documents").withColumn("text", F.expr(TRIGGER_TEXT))
    return _digest(tf.normalise_text(texts, "text"), "text")


def strip_definition(spark, sf):
    texts = _t(spark, sf, "documents").withColumn("text", F.expr(DEFINITION_TEXT))
    return _digest(tf.strip_definition(texts, "text", " PCTFREE", "U"), "text")


def valid_only(spark, sf):
    return tf.valid_only(_t(spark, sf, "documents", "doc_id", "source"), _t(spark, sf, "labels"),
                         "doc_id", "doc_id", "quality = 1")


_QUERIES = (
    scan_counts, range_scan, range_scan_text, name_list, restrict_to_list, load_append, load_truncate, save_csv, save_log, read_types,
    column_catalogue, measured_catalogue, map_types, map_notes, map_types_measured, map_types_compat, clean_defaults,
    clean_defaults_compat, fit_row_width, fit_row_width_least, text_widths, number_widths, profile_merged,
    conform_rows, reject_rows, conform_fractions, common_columns, load_common_columns, page_plan, page_rows,
    page_rows_copies, page_slice, page_numbers, page_counts_compat, transfer_log, transfer_resumed, transfer_status, transfer_report, copy_log,
    task_elapsed, zoned_elapsed, run_full, run_failing, run_decimals, run_metadata, run_views, run_listed, run_data, ordered_list, ordered_parts, key_columns,
    foreign_keys,
    check_primary_key, check_unique, check_not_null, orphan_rows, orphan_summary, assign_ids, assign_ids_again, load_order, text_between,
    identity_columns, identity_count, compare_counts, compare_failures, compare_keys, compare_content, exists_in, object_status,
    run_summary, count_by_kind, rewrite_text, rewrite_views, rewrite_views_lexed, normalise_text, strip_definition, valid_only,
)


def _with_folder(query):
    @wraps(query)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        own_folder(spark)
        return query(spark, sf)

    return run


def entry(spark: SparkSession) -> DataFrame:
    """Compare all tables with a copy that lacks rows and a table."""
    return compare_counts(spark, SMALL)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {q.__name__: q for q in _QUERIES}
    if llm:
        found |= {q.__name__: q for q in llm.QUERIES}
    if corpus_pipeline:
        found["pipeline"] = corpus_pipeline.run
    return {name: _with_folder(query) for name, query in found.items()}


def oracle_sql() -> dict[str, str]:
    found = dict(ORACLES)
    if llm:
        found |= llm.ORACLES
    if corpus_pipeline and corpus_pipeline.ORACLE_SQL:
        found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
