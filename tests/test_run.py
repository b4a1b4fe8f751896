import pytest
from pyspark.sql import functions as F

import tableflow as tf
from tableflow.plans import migrate

from collected import rows


@pytest.fixture
def stores(spark, tmp_path):
    source, target = tf.parquet_store(str(tmp_path / "s")), tf.parquet_store(str(tmp_path / "t"))
    tf.replace(spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, name string"), source, "parent")
    tf.replace(spark.createDataFrame([(10, 1), (11, 9), (11, 1)], "id bigint, parent_id bigint"), source, "child")
    return source, target


TABLES = [
    tf.TablePlan("parent", ["id"], ["id"], unique_keys=[["name"]]),
    tf.TablePlan("child", primary_key=["id"], not_null=["parent_id"],
                 references=[tf.Reference(["parent_id"], "parent", ["id"])]),
]


def test_full(spark, stores):
    views = spark.createDataFrame([("V", "select nvl(a,0)"), ("W", "x")], "view_name string, text string")
    objects = spark.createDataFrame([("V", "VIEW", "VALID"), ("W", "VIEW", "INVALID")],
                                    "object_name string, object_type string, status string")
    out = tf.run(spark, tf.Plan(*stores, TABLES, views=views, objects=objects))
    assert sorted(rows(out.report.select("table_name", "source_table_rows", "target_table_rows", "run_detail"))) == [
        ("child", 3, 3, "SUCCESS"), ("parent", 2, 2, "SUCCESS")]
    assert {r.is_success for r in out.compare.collect()} == {"Y"}
    assert rows(out.violations["child primary key"].select("id", "row_count")) == [(11, 2)]
    assert rows(out.violations["child parent_id"]) == [(9, 1)]
    assert sorted(rows(out.summary)) == [("CONSTRAINT INDEX", 4, 3, 1), ("FOREIGN KEY", 1, 0, 1), ("TABLE", 2, 2, 0)]
    assert rows(out.views) == [("V", "select ifnull(a,0)")]


def test_missing_table_does_not_stop_the_run(spark, stores):
    out = tf.run(spark, tf.Plan(*stores, [*TABLES, tf.TablePlan("absent")]))
    assert {r.table_name: r.run_detail for r in out.report.collect()} == {
        "parent": "SUCCESS", "child": "SUCCESS", "absent": "TABLE NOT EXIST"}
    assert {r.source_table_name: r.is_success for r in out.compare.collect()}["ABSENT"] == "N"


def test_listed(spark, stores):
    out = tf.run(spark, tf.Plan(*stores, TABLES, mode="listed", names=[" Child,x", ""]))
    assert [r.table_name for r in out.report.collect()] == ["child"]
    names = tf.name_list(spark.createDataFrame([("child,x",), (" ",)], "value string"))
    assert [t.name for t in tf.Plan(*stores, TABLES, mode="listed", names=names).chosen()] == ["child"]
    status = {r.name: (r.status, r.message) for r in out.status.collect()}
    assert status["child parent_id"] == ("failed", "TABLE NOT EXIST")


def test_data_only(spark, stores):
    source, target = stores
    tf.replace(spark.createDataFrame([("old", 1)], "NAME string, extra int"), target, "parent")
    out = tf.run(spark, tf.Plan(source, target, TABLES, mode="data", names=["parent", "child"]))
    assert sorted(rows(tf.read_table(spark, target, "parent"))) == [("a", None), ("b", None)]
    assert {r.table_name: r.run_detail for r in out.report.collect()} == {"parent": "SUCCESS", "child": "TABLE NOT EXIST"}


def test_metadata_only(spark, stores):
    source, target = stores
    out = tf.run(spark, tf.Plan(source, target, TABLES, mode="metadata"))
    made = tf.read_table(spark, target, "parent")
    assert made.count() == 0 and made.dtypes == [("id", "bigint"), ("name", "string")]
    assert [r.rule for r in out.mapping.where("table_name = 'parent'").orderBy("column_id").collect()] == ["bigint", "varchar"]


def test_modes_exclude_each_other(spark, stores):
    with pytest.raises(ValueError):
        tf.run(spark, tf.Plan(*stores, TABLES, mode="metadata", names=["parent"]))
    with pytest.raises(ValueError):
        tf.run(spark, tf.Plan(*stores, TABLES, mode="listed"))
    with pytest.raises(ValueError):
        tf.run(spark, tf.Plan(*stores, TABLES, mode="other"))


def test_wide_tables_are_narrowed(spark, stores):
    source, target = stores
    described = tf.catalogue_of(spark, {"parent": tf.read_table(spark, source, "parent")}).withColumn(
        "char_length", F.when(F.col("data_type") == "VARCHAR2", 70_000)).withColumn(
        "comments", F.concat(F.lit("the "), "column_name"))
    out = tf.run(spark, tf.Plan(source, target, TABLES[:1], catalogue=described))
    assert {r.column_name: r.max_length for r in out.mapping.collect()} == {"id": None, "name": 2}
    assert rows(out.status.where("name = 'parent'").select("status", "message")) == [("end", "narrowed")]
    made = tf.read_table(spark, target, "parent")
    assert made.count() == 2 and made.schema["name"].metadata == {"comment": "the name"}


def test_measured_types(spark, stores):
    source, target = stores
    tf.replace(spark.createDataFrame([(1, 3_000_000_000, 0.5, "x")], "a bigint, b bigint, c double, d string"), source, "m")
    tf.replace(spark.createDataFrame([("x",)], "d string"), source, "n")
    out = tf.run(spark, tf.Plan(source, target, [tf.TablePlan("m"), tf.TablePlan("n")], measure=True))
    assert tf.read_table(spark, target, "m").dtypes == [("a", "int"), ("b", "bigint"), ("c", "double"), ("d", "string")]
    assert {r.run_detail for r in out.report.collect()} == {"SUCCESS"}


def test_identity_log_and_unmapped_columns(spark, stores, tmp_path):
    source, target = stores
    tf.replace(spark.createDataFrame([(7, "a", [1.0]), (None, "c", None), (None, "b", [2.0])],
                                     "id bigint, name string, v array<double>"), source, "x")
    logs = tf.parquet_store(str(tmp_path / "logs"))
    table = tf.TablePlan("x", order=["name"], primary_key=["id"], identity="id")
    out = tf.run(spark, tf.Plan(source, target, [table], log_store=logs))
    assert sorted(rows(tf.read_table(spark, target, "x", ["id", "name", "v"])), key=str) == [
        (7, "a", [1.0]), (8, "b", [2.0]), (9, "c", None)]
    assert not out.violations
    assert rows(out.status.where("kind = 'COLUMN'").select("name", "status", "message")) == [
        ("x.v", "unmapped", "ARRAY<DOUBLE>")]
    assert rows(out.summary.where("kind = 'AUTO INCREMENT COL'")) == [("AUTO INCREMENT COL", 1, 1, 0)]
    assert rows(tf.read_table(spark, logs, "RUN_LOG", ["table_name", "target_table_rows"])) == [("x", 3)]
    assert rows(tf.read_table(spark, logs, "RUN_COMPARE", ["source_table_name", "is_success"])) == [("X", "Y")]
    empty = tf.run(spark, tf.Plan(source, target, [table], mode="metadata"))
    assert tf.read_table(spark, target, "x").dtypes == [("id", "bigint"), ("name", "string"), ("v", "array<double>")]
    assert empty.report.first().run_detail == "SUCCESS"


def test_fractions_end_in_the_reject_store(spark, stores, tmp_path):
    source, target = stores
    tf.replace(spark.createDataFrame([(1, 1.7), (2, 2.5), (3, 4.0)], "id bigint, price double"), source, "p")
    described = tf.catalogue_of(spark, {"p": tf.read_table(spark, source, "p")}).withColumn("data_type", F.lit("NUMBER"))
    kept = tf.parquet_store(str(tmp_path / "kept"))
    out = tf.run(spark, tf.Plan(source, target, [tf.TablePlan("p")], catalogue=described, reject_store=kept))
    assert [r.run_detail for r in out.report.collect()] == ["TABLE INSERT FAIL"] and [r.is_success for r in out.compare.collect()] == ["N"]
    assert sorted(rows(tf.read_table(spark, target, "p"))) == [(3, 4)]
    assert sorted((r.id, r.reject_reason) for r in tf.read_table(spark, kept, "p").collect()) == [(1, "price:scale"), (2, "price:scale")]


def test_a_run_survives_what_tables_and_checks_meet(spark, stores, tmp_path):
    source, target = stores
    damaged = tmp_path / "s" / "damaged"
    tf.replace(spark.range(3), source, "damaged")
    for part in damaged.glob("part-*"):
        part.write_bytes(part.read_bytes()[:-40] + b"x" * 40)
    tf.replace(spark.createDataFrame([(5,)], "id bigint"), target, "damaged")
    logs = tf.parquet_store(str(tmp_path / "logs"))
    tables = [tf.TablePlan("damaged"), tf.TablePlan("parent", primary_key=["nosuch"], not_null=["name"])]
    out = tf.run(spark, tf.Plan(source, target, tables, log_store=logs))
    detail = {r.table_name: r.run_detail for r in out.report.collect()}
    assert detail["parent"] == "SUCCESS" and detail["damaged"] in ("TABLE NOT EXIST",) or detail["damaged"].startswith("TABLE INSERT FAIL ")
    states = {r.name: r.status for r in out.status.collect()}
    assert states["parent primary key"] == "failed" and states["parent not null"] == "end" and states["damaged"] == "failed"
    assert rows(tf.read_table(spark, target, "damaged")) == [(5,)]
    assert {r.table_name for r in tf.read_table(spark, logs, "RUN_LOG").collect()} == {"damaged", "parent"}


def test_a_failing_table_is_not_called_missing(spark, stores):
    source, target = stores
    tf.replace(spark.createDataFrame([(1, 2)], "id bigint, ID2 bigint"), source, "t")
    tf.replace(spark.createDataFrame([([1],)], "id array<int>"), target, "t")
    out = tf.run(spark, tf.Plan(source, target, [tf.TablePlan("t")], mode="data"))
    assert [r.run_detail[:17] for r in out.report.collect()] == ["TABLE INSERT FAIL"]


def test_narrowed_columns_have_one_width(spark, stores):
    source, target = stores
    described = tf.catalogue_of(spark, {"parent": tf.read_table(spark, source, "parent")}).withColumn(
        "char_length", F.when(F.col("data_type") == "VARCHAR2", 70_000))
    out = tf.run(spark, tf.Plan(source, target, TABLES[:1], catalogue=described, mode="metadata"))
    assert {r.column_name: (r.target_type, r.max_length) for r in out.mapping.collect()}["name"] == ("VARCHAR(2)", 2)


def test_an_end_beats_a_start_at_one_time(spark):
    log = spark.createDataFrame([("TABLE", "a", "running", "", 1), ("TABLE", "a", "end", "", 1), ("TABLE", "b", "running", "", 1)],
                                "kind string, name string, status string, message string, ts int")
    assert {r.name: r.status for r in tf.object_status(log).collect()} == {"a": "end", "b": "running"}


def test_database_tables_are_read_in_ranges(spark, stores, monkeypatch):
    asked = []
    monkeypatch.setattr(migrate, "read_ranges", lambda spark, store, name, key, parts, types=None: asked.append((name, key, parts, types)))
    monkeypatch.setattr(migrate, "read_table", lambda spark, store, name, types=None: asked.append((name, types)))
    store = tf.Store("jdbc", "jdbc:x://h/db")
    migrate._read(spark, store, tf.TablePlan("t", split_key="id", parts=5), {"n": "decimal(5,0)"})
    migrate._read(spark, store, tf.TablePlan("u"))
    migrate._read(spark, stores[0], tf.TablePlan("v", split_key="id"))
    assert asked == [("t", "id", 5, {"n": "decimal(5,0)"}), ("u", None), ("v", None)]
