"""Transfers that stop and go on."""

import shutil

import pytest

import tableflow as tf
from collected import rows
from tableflow.operators import resume
from tableflow.operators.mapping import ColumnRule


class Stopped(Exception):
    pass


@pytest.fixture
def stores(tmp_path):
    return {n: tf.parquet_store(str(tmp_path / n)) for n in ("target", "ledger", "rejects")}


@pytest.fixture
def source(spark):
    return spark.range(1, 1001).selectExpr("id AS k", "concat('t', id % 7) AS t", "id * 1.5 AS x").repartition(5)


def moved(log):
    return [(r.page_no, r.source_table_rows, r.target_table_rows) for r in log.orderBy("page_no").collect()]


def whole(spark, store):
    return sorted((r.k, r.page_no) for r in tf.read_table(spark, store, "t").collect())


PAGES = [(n + 1, 70 if n < 14 else 20, 70 if n < 14 else 20) for n in range(15)]
ROWS = [(k, (k - 1) // 70 + 1) for k in range(1, 1001)]


@pytest.mark.parametrize("after", ["write", "ledger"])
def test_a_stop_leaves_no_page_twice(spark, stores, source, monkeypatch, after):
    how = {"keys": ["k"], "page_size": 70, "ledger": stores["ledger"], "batches": 6, "at_once": 2}
    real, calls = getattr(resume, "append" if after == "ledger" else "_move"), []

    def stopping(*args):
        out = real(*args)
        calls.append(args)
        if len(calls) == 2:
            raise Stopped
        return out

    monkeypatch.setattr(resume, "append" if after == "ledger" else "_move", stopping)
    with pytest.raises(Stopped):
        tf.transfer_resumed(source, stores["target"], "t", **how)
    seen = []
    monkeypatch.setattr(resume, "append" if after == "ledger" else "_move", real)
    move = resume._move
    monkeypatch.setattr(resume, "_move", lambda rows, *a: seen.append(n := move(rows, *a)) or n)
    assert moved(tf.transfer_resumed(source, stores["target"], "t", **how)) == PAGES
    assert whole(spark, stores["target"]) == ROWS and 0 < sum(seen) < 1000
    seen.clear()
    assert moved(tf.transfer_resumed(source, stores["target"], "t", **how)) == PAGES and not seen


def test_lost_pages_come_back(spark, stores, source, tmp_path, monkeypatch):
    how = {"keys": ["k"], "page_size": 70, "ledger": stores["ledger"], "batches": 6}
    tf.transfer_resumed(source, stores["target"], "t", **how)
    shutil.rmtree(tmp_path / "target" / "t" / "batch_no=2")
    seen, move = [], resume._move
    monkeypatch.setattr(resume, "_move", lambda rows, *a: seen.append(n := move(rows, *a)) or n)
    assert moved(tf.transfer_resumed(source, stores["target"], "t", **how)) == PAGES
    assert whole(spark, stores["target"]) == ROWS and sum(seen) < 300


def test_limit_rules_and_rejects(spark, stores, source):
    rules = [ColumnRule("k", "bigint"), ColumnRule("t", "string", max_length=2), ColumnRule("x", "int")]
    how = {"keys": ["k"], "page_size": 100, "ledger": stores["ledger"], "rules": rules, "reject_store": stores["rejects"], "batches": 4}
    part = moved(tf.transfer_resumed(source, stores["target"], "t", limit=1, **how))
    assert sum(r[1] for r in part) == 1000 and 0 < sum(r[2] for r in part) < 500
    assert moved(tf.transfer_resumed(source, stores["target"], "t", **how)) == [(n, 100, 50) for n in range(1, 11)]
    assert tf.read_table(spark, stores["rejects"], "t").groupBy("reject_reason").count().collect()[0][:] == ("x:scale", 500)
    assert tf.read_table(spark, stores["target"], "t").count() == 500


def test_a_changed_source_is_an_error(spark, stores, source):
    how = {"keys": ["k"], "page_size": 100, "ledger": stores["ledger"], "batches": 4}
    tf.transfer_resumed(source, stores["target"], "t", limit=1, **how)
    with pytest.raises(ValueError, match="changed"):
        tf.transfer_resumed(source.where("k <> 990"), stores["target"], "t", **how)
    with pytest.raises(ValueError, match="pages of 100"):
        tf.transfer_resumed(source, stores["target"], "t", ["k"], 50, stores["ledger"])


def test_nothing_and_composite_keys(spark, stores):
    none = spark.createDataFrame([], "k int, t string")
    assert moved(tf.transfer_resumed(none, stores["target"], "none", ["k"], 10, stores["ledger"])) == []
    df = spark.range(300).selectExpr("CAST(id % 3 AS int) AS a", "IF(id < 3, NULL, concat('k', id)) AS b", "timestamp_seconds(id) AS c")
    log = tf.transfer_resumed(df, stores["target"], "t", ["a", "b"], 25, stores["ledger"], batches=5)
    assert moved(log) == [(n, 25, 25) for n in range(1, 13)]
    assert sorted(map(str, rows(tf.read_table(spark, stores["target"], "t").select("a", "b", "c")))) == sorted(map(str, rows(df)))
