"""Content compare, stable ids and load order."""

import random

import pytest

import tableflow as tf
from collected import rows

SHAPE = "k int, v string, d int"


def differences(a, b, **how):
    return sorted(((r.k, r.difference, r.source_rows, r.target_rows) for r in tf.compare_content(a, b, ["k"], **how).collect()), key=str)


def test_content(spark):
    base = [(k, f"v{k % 5}", k) for k in range(200)] + [(None, "n", 1), (7, "v2", 7), (8, None, None)]
    a = spark.createDataFrame(base, SHAPE)
    assert differences(a, a.repartition(7)) == []
    other = [r for r in base if r[0] not in (3, 4)] + [(500, "x", 1), (None, "n", 1), (9, "v4", 9)]
    other = [(k, "new" if k == 20 else v, d) for k, v, d in other]
    b = spark.createDataFrame(other, SHAPE)
    expected = [(3, "lost", 1, 0), (4, "lost", 1, 0), (500, "added", 0, 1), (None, "changed", 1, 2), (9, "changed", 1, 2), (20, "changed", 1, 1)]
    assert differences(a, b) == differences(a, b, levels=(1, 2)) == differences(a, b, levels=(20,)) == sorted(expected, key=str)
    assert differences(a, b.limit(0)) == sorted({(k, "lost", sum(x[0] == k for x in base), 0) for k, *_ in base}, key=str)
    assert differences(a.limit(0), b.limit(0)) == []


def test_repeated_rows_do_not_cancel(spark):
    a = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "k int, v string")
    b = spark.createDataFrame([(1, "b"), (1, "b"), (2, "")], "k int, v string")
    assert differences(a, b) == [(1, "changed", 2, 2), (2, "changed", 1, 1)]


def test_forms(spark):
    """The same values in other types and under names in another case are the same."""
    a = spark.sql("SELECT id AS k, CAST(id AS decimal(10,2)) AS d, id * 0.5D AS f, CAST('2020-01-01' AS date) AS t, id AS only_here FROM range(50)")
    b = spark.sql("SELECT CAST(id AS int) AS K, CAST(id AS int) AS D, CAST(id * 0.5D AS float) AS F, TIMESTAMP_NTZ'2020-01-01' AS T FROM range(50)")
    assert differences(a, b) == []
    assert differences(a, b.withColumn("F", b.F + 1.0), columns=["d", "t"]) == []
    assert len(differences(a, b.withColumn("F", b.F + 1.0))) == 50


def test_a_hot_key(spark):
    a = spark.range(30_000).selectExpr("CAST(IF(id % 3 = 0, 1, id) AS int) AS k", "id AS v")
    assert differences(a, a.where("v <> 600")) == [(1, "changed", 10_001, 10_000)]


def test_ids_stay(spark, tmp_path):
    store = tf.parquet_store(str(tmp_path))
    first = spark.createDataFrame([("b", 1), ("a", 1), ("a", 1), (None, 2)], "x string, y int")
    found = {(r.x, r.y): r.id for r in tf.assign_ids_again(first, store, "map", ["x", "y"]).collect()}
    assert sorted(found.values()) == [1, 2, 3]
    more = first.unionByName(spark.createDataFrame([("A", 1), (None, None), ("c", 9)], first.schema))
    for _ in range(2):
        again = tf.assign_ids_again(more, store, "map", ["x", "y"])
        assert again.count() == 7
        ids = {(r.x, r.y): r.id for r in again.collect()}
        assert {k: ids[k] for k in found} == found and sorted(ids.values()) == [1, 2, 3, 4, 5, 6]
    assert tf.read_table(spark, store, "map").count() == 6
    assert tf.assign_ids_again(first.limit(0), store, "other", ["x"]).collect() == []


def plain_order(pairs):
    nodes = {n for p in pairs for n in p}
    reach = {n: {b for a, b in pairs if a == n} for n in nodes}
    for k in nodes:
        for a in nodes:
            if k in reach[a]:
                reach[a] |= reach[k]
    root = {n: max([n, *(m for m in reach[n] if n in reach[m])]) for n in nodes}
    level = dict.fromkeys(nodes, 0)
    for _ in nodes:
        for a, b in pairs:
            if root[a] != root[b]:
                high = max(level[b], level[a] + 1)
                for n in nodes:
                    if root[n] == root[b]:
                        level[n] = max(level[n], high)
    return sorted((n, level[n], root[n] if n in reach[n] else None, n in reach[n]) for n in nodes)


@pytest.mark.parametrize("seed", range(4))
def test_load_order(spark, seed):
    made = random.Random(seed)
    pairs = {(f"t{made.randrange(18)}", f"t{made.randrange(18)}") for _ in range(10 + 6 * seed)}
    df = spark.createDataFrame([(b, a) for a, b in pairs] + [(None, "t1"), ("t1", None)], "child_table string, parent_table string")
    assert sorted(rows(tf.load_order(df.unionByName(df)))) == plain_order(pairs)


def test_load_order_of_nothing(spark):
    none = spark.createDataFrame([], "child_table string, parent_table string")
    assert rows(tf.load_order(none)) == []
    assert rows(tf.load_order(none, spark.createDataFrame([("t",), (None,)], "table_name string"))) == [("t", 0, None, False)]
