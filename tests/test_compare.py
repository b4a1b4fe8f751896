import datetime as dt

from pyspark.sql import functions as F

import tableflow as tf
from tableflow.operators import compare

from collected import rows

COUNTS = "table_name string, row_count bigint"
LOG = "table_name string, source_table_rows bigint, target_table_rows bigint, type string, detail string"


def test_compare_counts(spark):
    src = spark.createDataFrame([("same", 5), ("less", 5), ("gone", 1), ("Case", 2), ("bad", None), ("run_compare", 9)], COUNTS)
    tgt = spark.createDataFrame([("SAME", 5), ("less", 4), ("cASE", 2), ("more", 1), ("bad", 0), ("run_log", 3)], COUNTS)
    out = tf.compare_counts(src, tgt, numbered=True)
    got = {r.source_table_name: (r.source_rows, r.target_table_name, r.target_rows, r.is_success) for r in out.collect()}
    assert got == {
        "SAME": (5, "SAME", 5, "Y"), "LESS": (5, "LESS", 4, "N"), "GONE": (1, "TABLE NOT EXIST", -1, "N"),
        "CASE": (2, "CASE", 2, "Y"), "BAD": (None, "BAD", 0, "N")}
    assert sorted(r.id for r in out.collect()) == [1, 2, 3, 4, 5]
    assert [r.source_table_name for r in tf.failures(out).collect()] == ["GONE", "BAD", "LESS"]


def test_compare_with_itself(spark):
    tables = {"a": spark.range(3), "b": spark.range(0)}
    counts = tf.row_counts(spark, tables)
    assert {r.is_success for r in tf.compare_counts(counts, counts).collect()} == {"Y"}


def test_row_counts_of_unreadable(spark):
    assert sorted(rows(tf.row_counts(spark, {"a": spark.range(3), "x": None}))) == [("a", 3), ("x", None)]
    assert rows(tf.row_counts(spark, {})) == []


def test_compare_keys(spark):
    src = spark.createDataFrame([("v1", 1), ("V2", 1)], "a string, b int")
    tgt = spark.createDataFrame([("V1", 1), ("V1", 1), ("v2", 2)], "a string, b int")
    assert sorted(rows(tf.compare_keys(src, tgt, ["a"]))) == [("V1", "V1", "Y"), ("V2", "V2", "Y")]
    assert sorted(rows(tf.compare_keys(src, tgt, ["a", "b"]))) == [("V1,1", "V1,1", "Y"), ("V2,1", "NOT EXISTS VIEW", "N")]


def test_exists_in(spark):
    df = spark.createDataFrame([("A", 1), ("A", 1), ("A", 2), ("B", 3)], "s string, t int")
    assert tf.exists_in(df, "s", "A").first().found == 1
    assert tf.exists_in(df, "s", "A", "t").first().found == 2
    assert tf.exists_in(df, "s", "C").first().found == 0


def test_transfer_report(spark):
    log = spark.createDataFrame(
        [("A", 100, 60, "TABLE", ""), ("A", 100, 40, "TABLE", None), ("B", 50, 50, "TABLE", ""), ("B", 0, 0, "TABLE", ""),
         ("C", 10, 7, "TABLE", ""), ("create index", 0, 0, "INDEX", "")], LOG)
    missing = spark.createDataFrame([("D",), ("D",)], "table_name string")
    assert sorted(rows(tf.transfer_report(log, missing).select(
        "id", "table_name", "source_table_rows", "target_table_rows", "run_detail"))) == [
        (1, "A", 100, 100, "SUCCESS"), (2, "B", 50, 50, "SUCCESS"), (3, "C", 10, 7, "TABLE INSERT FAIL"),
        (4, "D", 0, 0, "TABLE NOT EXIST")]


def test_transfer_status_and_elapsed(spark):
    t0, t1 = dt.datetime(2024, 3, 10, 1, 59, 59, 900000), dt.datetime(2024, 3, 10, 3, 0, 1, 100000)
    log = spark.createDataFrame([("A", 10, 4, "TABLE", t0, t0), ("A", 10, 6, "TABLE", t0, t1), ("B", 1, 0, "TABLE", t1, t1)],
                                "table_name string, source_table_rows bigint, target_table_rows bigint, type string, "
                                "task_start_time timestamp_ntz, task_end_time timestamp_ntz")
    out = tf.elapsed(tf.transfer_status(log)).select("table_name", "target_table_rows", "is_success", "run_time")
    assert sorted(rows(out)) == [("A", 10, "Y", 3602), ("B", 0, "N", 0)]
    zoned = spark.range(1).select(F.timestamp_seconds(F.lit(10)).alias("a"), F.timestamp_millis(F.lit(75900)).alias("b"))
    assert tf.elapsed(zoned, "a", "b").first().run_time == 65


def test_object_status_and_summary(spark):
    t = [dt.datetime(2024, 1, 1, 0, 0, i) for i in range(3)]
    log = spark.createDataFrame(
        [("TABLE", "A", "running", "", t[0]), ("TABLE", "A", "failed", "too wide", t[1]), ("TABLE", "A", "end", "narrowed", t[2]),
         ("TABLE", "B", "failed", "x", t[0]), ("TABLE", "B", "failed", "y", t[1]), ("VIEW", "V", "end", "", t[0])],
        "kind string, name string, status string, message string, ts timestamp_ntz")
    assert sorted(rows(tf.object_status(log))) == [
        ("TABLE", "A", "end", "narrowed"), ("TABLE", "B", "failed", "y"), ("VIEW", "V", "end", "")]
    assert sorted(rows(tf.run_summary(log))) == [("TABLE", 2, 1, 1), ("VIEW", 1, 1, 0)]
    assert sorted(rows(tf.run_summary(log.drop("ts")))) == [("TABLE", 2, 1, 1), ("VIEW", 1, 1, 0)]


def test_count_by_kind(spark):
    df = spark.createDataFrame(
        [("TABLE", "T1"), ("TABLE", "T2"), ("VIEW", "V"), ("TRIGGER", "BIN$abc"), ("TRIGGER", "TR")], "k string, n string")
    assert sorted(rows(tf.count_by_kind(df, "k", "n", "BIN$%"))) == [("TABLE", 2), ("TRIGGER", 1), ("VIEW", 1)]


def test_a_database_counts_its_own_tables(spark, monkeypatch):
    asked = {}

    def answer(_, __, queries):
        asked.update({q: spark.createDataFrame([(7,)], "row_count int") if "GONE" not in q else None for q in queries})
        return asked

    monkeypatch.setattr(compare, "read_tables", answer)
    counts = tf.store_counts(spark, tf.Store("jdbc", "jdbc:x:"), ["T", "GONE"])
    assert sorted(rows(counts)) == [("GONE", None), ("T", 7)]
    assert "(SELECT COUNT(*) AS row_count FROM T) c" in asked
