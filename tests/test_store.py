import pytest
from pyspark.sql import functions as F

import tableflow as tf
from tableflow.operators.mapping import ColumnRule
from tableflow import session
from tableflow.sources import store as sources
from tableflow.sources.store import jdbc_range_options, jdbc_read_options, jdbc_write_options, key_cuts, range_predicates, recover, target_schema

from collected import rows


@pytest.fixture
def store(spark, tmp_path):
    return tf.parquet_store(str(tmp_path / "store"))


def test_write_modes(spark, store):
    a, b = spark.range(3), spark.range(10, 12)
    tf.replace(a, store, "t")
    tf.append(b, store, "t")
    assert sorted(r[0] for r in tf.read_table(spark, store, "t").collect()) == [0, 1, 2, 10, 11]
    tf.truncate_load(b, store, "t")
    assert sorted(r[0] for r in tf.read_table(spark, store, "t").collect()) == [10, 11]
    assert target_schema(spark, store, "nosuch") is None


def test_tables_of_a_database(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS flow")
    store = tf.Store("tables", "flow")
    tf.replace(spark.range(3), store, "t")
    tf.append(spark.range(2), store, "t")
    assert tf.read_table(spark, store, "t").count() == 5
    tf.truncate_load(spark.range(1), store, "t")
    assert rows(tf.read_table(spark, store, "t")) == [(0,)]


def test_read_with_columns_and_types(spark, store):
    tf.replace(spark.createDataFrame([("1", "12.345", 7)], "a string, d string, x int"), store, "t")
    df = tf.read_table(spark, store, "t", ["d", "a"], {"d": "decimal(10,3)"})
    assert df.dtypes == [("d", "decimal(10,3)"), ("a", "string")]


def test_jdbc_options():
    store = tf.Store("jdbc", "jdbc:x://h/db", options={"user": "u", "fetchsize": "5"})
    options = jdbc_read_options(store, "T", {"N": "decimal(38,10)", "C": "string"})
    assert options == {
        "url": "jdbc:x://h/db", "dbtable": "T", "fetchsize": "5", "preferTimestampNTZ": "true", "user": "u",
        "customSchema": "`N` decimal(38,10), `C` string"}


def test_jdbc_write_options():
    store = tf.Store("jdbc", "jdbc:x://h/db", options={"numPartitions": "8"})
    assert jdbc_write_options(store, "T", 500, {"truncate": "true"}) == {
        "url": "jdbc:x://h/db", "dbtable": "T", "batchsize": "500", "numPartitions": "8", "truncate": "true"}


@pytest.mark.parametrize("cuts", [[], [10.0], [5.0, 7.5, 60.0]])
def test_range_predicates_are_a_partition(spark, cuts):
    df = spark.range(100).select(F.when(F.col("id") % 9 > 0, F.col("id")).alias("k"))
    counts = [df.where(p).count() for p in range_predicates("k", cuts)]
    assert sum(counts) == 100 and len(counts) == len(cuts) + 1
    if cuts:
        overlap = " + ".join(f"int(coalesce({p}, false))" for p in range_predicates("k", cuts))
        assert df.where(f"{overlap} <> 1").count() == 0


def test_key_cuts_follow_the_data(spark, store):
    df = spark.range(1000).select(F.pow("id", F.lit(3)).cast("bigint").alias("k"))
    cuts = key_cuts(df, "k", 4)
    sizes = [df.where(p).count() for p in range_predicates("k", cuts)]
    assert len(sizes) == 4 and max(sizes) < 300
    tf.replace(df, store, "t")
    assert tf.read_pages(spark, store, "t", range_predicates("k", cuts)).count() == 1000
    assert tf.read_ranges(spark, store, "t", "k", 4).count() == 1000


def test_copy_keeps_rejects(spark, store):
    df = spark.createDataFrame([(1, "a"), (2, "toolong"), (3, None)], "i int, s string")
    rules = [ColumnRule("i", "bigint"), ColumnRule("s", "string", max_length=3, nullable=False)]
    rejected = tf.parquet_store(store.location + "_rejects")
    log = tf.copy_table(df, store, "t", rules=rules, reject_store=rejected).first()
    assert (log.source_table_rows, log.target_table_rows) == (3, 1)
    assert rows(tf.read_table(spark, store, "t")) == [(1, "a")]
    assert sorted(rows(tf.read_table(spark, rejected, "t"))) == [(2, "toolong", "s:length"), (3, None, "s:null")]


def test_transfer_logs_every_page(spark, store):
    df = spark.range(25).withColumn("s", F.when(F.col("id").between(10, 19), "long").otherwise("x"))
    rules = [ColumnRule("id", "bigint"), ColumnRule("s", "string", max_length=1)]
    log = tf.transfer(df, store, "t", ["id"], 10, unique=True, rules=rules)
    assert sorted((r.page_no, r.source_table_rows, r.target_table_rows) for r in log.collect()) == [
        (1, 25, 10), (2, 25, 0), (3, 25, 5)]
    assert tf.transfer_status(log).first().is_success == "N"
    empty = tf.transfer(spark.range(0), store, "e", ["id"], 10).collect()
    assert [(r.table_name, r.source_table_rows, r.target_table_rows) for r in empty] == [("e", 0, 0)]


def test_load_common_columns(spark, store):
    tf.replace(spark.createDataFrame([("old", 1)], "B string, extra int"), store, "t")
    src = spark.createDataFrame([(1, "x"), (2, "y")], "a int, b string")
    log = tf.load_common_columns(src, store, "t").first()
    assert (log.source_table_rows, log.target_table_rows) == (2, 2)
    assert sorted(rows(tf.read_table(spark, store, "t"))) == [("x", None), ("y", None)]
    assert tf.load_common_columns(src, store, "nosuch") is None


def test_logs_are_kept(spark, store, tmp_path):
    log = spark.createDataFrame([("a", 1)], "name string, n int")
    tf.save_log(log, store, "log")
    tf.save_log(log, store, "log")
    assert tf.read_table(spark, store, "log").count() == 2
    tf.save_csv(log, str(tmp_path / "csv"))
    assert rows(spark.read.csv(str(tmp_path / "csv"), header=True)) == [("a", "1")]


def test_shared_folder_comes_from_the_session(spark):
    assert tf.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert tf.fresh_path(spark, "x") != tf.fresh_path(spark, "x")
    df = tf.materialise(spark.range(5))
    assert df.count() == 5 and "Range" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_a_table_is_written_whole_before_it_replaces_what_it_is_read_from(spark, store):
    tf.replace(spark.range(5), store, "t")
    tf.truncate_load(tf.read_table(spark, store, "t").where("id > 2"), store, "t")
    assert sorted(rows(tf.read_table(spark, store, "t"))) == [(3,), (4,)]


def test_a_failed_load_leaves_the_old_table(spark, store):
    tf.replace(spark.createDataFrame([(1, "old")], "a int, b string"), store, "t")
    bad = spark.createDataFrame([("x1",), ("5",)], "a string").selectExpr("CAST(a AS INT) AS a")
    for load in (tf.truncate_load, tf.replace):
        with pytest.raises(Exception):
            load(bad, store, "t")
        assert rows(tf.read_table(spark, store, "t")) == [(1, "old")]


def test_truncate_keeps_the_definition(spark, store):
    tf.replace(spark.createDataFrame([(1, "x")], "a bigint, b string"), store, "t")
    tf.truncate_load(spark.createDataFrame([(2,)], "A int"), store, "t")
    out = tf.read_table(spark, store, "t")
    assert out.dtypes == [("a", "bigint"), ("b", "string")] and rows(out) == [(2, None)]
    with pytest.raises(ValueError):
        tf.truncate_load(spark.createDataFrame([(2,)], "c int"), store, "t")


def test_common_columns_keep_what_does_not_fit(spark, store):
    tf.replace(spark.createDataFrame([(0, "old")], "a int, b string"), store, "t")
    kept = tf.parquet_store(store.location + "_kept")
    src = spark.createDataFrame([("x1", 1.5), ("5", 2.0), ("2.5", 3.0)], "a string, other double")
    log = tf.load_common_columns(src, store, "t", reject_store=kept).first()
    assert (log.source_table_rows, log.target_table_rows) == (3, 1)
    assert rows(tf.read_table(spark, store, "t")) == [(5, None)]
    assert sorted((r.a, r.other) for r in tf.read_table(spark, kept, "t").collect()) == [("2.5", 3.0), ("x1", 1.5)]


def test_ranges_of_a_database_read():
    store = tf.Store("jdbc", "jdbc:x://h/db")
    options = jdbc_range_options(store, "T", "id", 6, (1, 90), {"N": "decimal(5,0)"})
    assert {k: options[k] for k in ("dbtable", "partitionColumn", "numPartitions", "lowerBound", "upperBound", "customSchema")} == {
        "dbtable": "T", "partitionColumn": "id", "numPartitions": "6", "lowerBound": "1", "upperBound": "90", "customSchema": "`N` decimal(5,0)"}
    assert "partitionColumn" not in jdbc_range_options(store, "T", "id", 6, (None, None))


def test_staged_data_goes_on_request(spark, tmp_path):
    df = tf.materialise(spark.range(5), folder=str(tmp_path))
    assert df.count() == 5 and len(list(tmp_path.iterdir())) == 1
    kept = dict(session._STAGED)
    session._STAGED[spark.sparkContext.applicationId] = [p for p in session._STAGED[spark.sparkContext.applicationId] if str(tmp_path) in p]
    assert session.remove_staged(spark) == 1 and not list(tmp_path.iterdir())
    session._STAGED.update(kept)


def test_empty_tables_are_logged(spark, store):
    empty = spark.createDataFrame([], "a int, b string")
    rules = [ColumnRule("a", "bigint"), ColumnRule("b", "string", max_length=3)]
    for log in (tf.copy_table(empty, store, "x"), tf.copy_table(empty, store, "y", rules=rules)):
        assert (log.first().source_table_rows, log.first().target_table_rows) == (0, 0)


class Stopped(Exception):
    pass


@pytest.mark.parametrize("mode", ["replace", "truncate_load"])
@pytest.mark.parametrize("renames", [0, 1, 2, 3])
def test_a_swap_that_stops_is_finished(spark, store, monkeypatch, mode, renames):
    """Stopped after so many renames, a read and the next load find one whole table; reads alone suffice."""
    tf.replace(spark.range(3), store, "t")
    whole = sources._moved
    left = [renames]

    def some(system, source, target, name):
        if not left[0]:
            raise Stopped
        left[0] -= 1
        whole(system, source, target, name)

    monkeypatch.setattr(sources, "_moved", some)
    try:
        getattr(tf, mode)(spark.range(10, 15), store, "t")
        stopped = False
    except Stopped:
        stopped = True
    monkeypatch.setattr(sources, "_moved", whole)
    assert stopped == (renames < 2)
    # Before anything has moved, the old table is there; after that, the new one.
    expected = [(0,), (1,), (2,)] if renames == 0 else [(n,) for n in range(10, 15)]
    assert sorted(rows(tf.read_table(spark, store, "t"))) == expected
    assert target_schema(spark, store, "t") is not None
    tf.append(spark.range(20, 21), store, "t")
    assert sorted(rows(tf.read_table(spark, store, "t"))) == [(n,) for n in range(10, 15)] + [(20,)]
    tf.replace(spark.range(2), store, "t")
    assert sorted(rows(tf.read_table(spark, store, "t"))) == [(0,), (1,)]
    assert recover(spark, store, "t") == "none"


def test_a_lost_staged_folder_brings_the_old_table_back(spark, store, tmp_path):
    tf.replace(spark.range(3), store, "t")
    folder = tmp_path / "store"
    (folder / "t").rename(folder / "_t-1-old")
    (folder / "_t-intent").write_text("_t-1")
    assert rows(tf.read_table(spark, store, "t").orderBy("id")) == [(0,), (1,), (2,)]
    assert sorted(p.name for p in folder.iterdir() if not p.name.startswith(".")) == ["t"]


def test_a_load_that_fails_before_its_swap_changes_nothing(spark, store):
    tf.replace(spark.range(3), store, "t")
    with pytest.raises(Exception):
        tf.replace(spark.range(3).selectExpr("raise_error('no') AS id"), store, "t")
    assert tf.read_table(spark, store, "t").count() == 3
