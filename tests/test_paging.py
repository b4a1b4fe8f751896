from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tableflow.operators import paging
from tableflow.operators.paging import expand_counts, number_rows, page_bounds, page_count, page_range, page_slice, with_pages

from collected import rows


def _check_order(df, keys, buckets, unique=False):
    """Numbers are 1..n, keys ascend with them (nulls first), and no row is lost or changed."""
    out = number_rows(df, keys, unique, buckets=buckets)
    got = out.orderBy("row_no").collect()
    assert [r["row_no"] for r in got] == list(range(1, len(got) + 1))
    wanted = [tuple(r) for r in df.select(*keys).orderBy(*keys).collect()]
    assert [tuple(r[k] for k in keys) for r in got] == wanted
    assert sorted(map(str, rows(out.drop("row_no")))) == sorted(map(str, rows(df)))


def test_large_buckets_get_a_task_each(spark, monkeypatch):
    monkeypatch.setattr(paging, "ROWS_PER_TASK", 10)
    df = spark.range(5000).select((F.col("id") * 37 % 5003).alias("k"), F.lit(1).alias("v"))
    _check_order(df, ["k"], 40)
    plan = number_rows(df, ["k"], True, buckets=40)._jdf.queryExecution().executedPlan().toString()
    assert "direct_shuffle_partition_id" in plan and "hashpartitioning" not in plan


def test_unique_key_in_many_buckets(spark):
    _check_order(spark.range(5000).select((F.col("id") * 37 % 5003).alias("k")), ["k"], 40, unique=True)


def test_one_key_holds_a_third_of_the_rows(spark):
    df = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 100).alias("k"), F.col("id").alias("v"))
    _check_order(df, ["k"], 32)


def test_copies_of_one_row_are_a_third(spark):
    df = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 900)).alias("k"),
        F.when(F.col("id") % 3 == 0, 1.5).otherwise(F.col("id") % 7).alias("v"))
    _check_order(df, ["k"], 24)
    plan = number_rows(df, ["k"], buckets=24)._jdf.queryExecution().optimizedPlan().toString()
    assert "explode" in plan  # the copies are generated from a count


def test_copies_with_null_fields(spark):
    df = spark.range(4000).select(
        F.when(F.col("id") % 3 > 0, F.col("id") % 40).alias("k"), F.when(F.col("id") % 3 > 0, F.lit("v")).alias("s"))
    _check_order(df, ["k"], 24)
    _check_order(df, ["s", "k"], 24)


def test_nulls_first_and_mixed_types(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 4 > 0, F.col("id") % 50).alias("a"),
        F.expr("make_date(2024, 1 + CAST(id % 12 AS int), 1 + CAST(id % 28 AS int))").alias("b"),
        F.expr("timestamp_ntz '2024-03-10 02:30:00.000001' + make_dt_interval(0, 0, CAST(id % 7 AS int), 0)").alias("c"),
        (F.col("id") % 11).cast("decimal(10,3)").alias("d"), F.concat(F.lit("é'\""), F.col("id") % 3).alias("e"))
    _check_order(df, ["a", "b", "c", "d", "e"], 30)
    _check_order(df, ["e", "d"], 30)
    _check_order(df, ["c"], 30)


def test_all_rows_equal(spark):
    _check_order(spark.range(2000).select(F.lit(1).alias("k"), F.lit("x").alias("v")), ["k"], 16)


def test_empty_and_single(spark):
    assert rows(with_pages(spark.range(0), ["id"], 10)) == []
    assert rows(with_pages(spark.range(1), ["id"], 10)) == [(0, 1, 1)]


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(-3, 3)), st.sampled_from(["a", "b", ""])), max_size=60),
       st.integers(2, 9), st.integers(1, 12))
def test_pages_partition_the_table(spark, data, buckets, size):
    df = spark.createDataFrame(data, "k int, v string")
    _check_order(df, ["k"], buckets)
    pages = with_pages(df, ["k"], size, buckets=buckets).groupBy("page_no").count().orderBy("page_no").collect()
    whole, rest = divmod(len(data), size)
    assert [r["count"] for r in pages] == [size] * whole + ([rest] if rest else [])


def test_slice_reads_only_its_buckets(spark, tmp_path):
    spark.range(20000).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    out = page_slice(df, ["id"], 5001, 5010, unique=True, buckets=50)
    assert sorted(rows(out)) == [(i - 1, i) for i in range(5001, 5011)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(id" in plan and "LessThan(id" in plan
    assert rows(page_slice(df, ["id"], 20001, 20010, unique=True, buckets=50)) == []


def test_slice_across_copies(spark):
    df = spark.range(3000).select(F.when(F.col("id") < 1500, 5).otherwise(F.col("id")).alias("k"))
    out = page_slice(df, ["k"], 1400, 1600, buckets=12)
    assert sorted(rows(out)) == sorted((5 if n <= 1500 else n - 1, n) for n in range(1400, 1601))


@pytest.mark.parametrize("n, compat, ours", [
    (0, 1, 0), (1, 1, 1), (6, 2, 1), (7, 2, 1), (10, 2, 1), (11, 2, 2), (26, 4, 3)])
def test_page_count(spark, n, compat, ours):
    one = spark.range(1)
    assert one.select(page_count(F.lit(n), 10, True)).first()[0] == compat
    assert one.select(page_count(F.lit(n), 10)).first()[0] == ours


@pytest.mark.parametrize("page, bounds", [("1", (1, 10)), ("3", (21, 30)), ("0", (0, 9)), ("x", (0, 9))])
def test_page_range(spark, page, bounds):
    assert tuple(spark.range(1).select(page_range(F.lit(page), F.lit(10)).alias("r")).first().r) == bounds


def test_page_bounds(spark):
    counts = spark.createDataFrame([("a", 25), ("b", 0), ("c", 10)], "table_name string, row_count bigint")
    assert sorted(rows(page_bounds(counts, 10))) == [
        ("a", 1, 1, 10), ("a", 2, 11, 20), ("a", 3, 21, 30), ("c", 1, 1, 10)]


def test_expand_counts_in_blocks(spark):
    df = spark.createDataFrame([("a", 200_000), ("b", 1), ("c", 0)], "k string, n bigint")
    out = expand_counts(df, "n", "i").groupBy("k").agg(F.count("*"), F.min("i"), F.max("i"), F.count_distinct("i"))
    assert sorted(rows(out)) == [("a", 200_000, 1, 200_000, 200_000), ("b", 1, 1, 1, 1)]


def test_decimal_and_double_keys(spark):
    df = spark.createDataFrame(
        [(Decimal(i % 7) / 3, float("nan") if i % 5 == 0 else i / 3) for i in range(400)], "a decimal(20,9), b double")
    out = number_rows(df, ["b", "a"], buckets=8).orderBy("row_no")
    assert [str(r.b) for r in out.collect()] == [str(r.b) for r in df.orderBy("b").collect()]


def test_array_columns_break_ties(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("label", "embedding")
    out = number_rows(vectors.unionByName(vectors), ["label"], buckets=6).orderBy("row_no").collect()
    assert [r.row_no for r in out] == list(range(1, len(out) + 1))
    assert [r.label for r in out] == sorted(r.label for r in out)


def test_long_keys_bound_the_sample(spark, monkeypatch):
    df = spark.range(2000).select(F.concat(F.repeat(F.lit("x"), 500), F.col("id") % 700).alias("k"), "id")
    monkeypatch.setattr(paging, "SAMPLE_BYTES", 40_000)
    _check_order(df, ["k"], 40)
    assert len(paging._layout(df, ["k"], False, 40).counts) <= 20


def test_odd_characters_in_keys(spark):
    odd = ["", " ", "\n", "\t\"", "\\", "\u2028", "😀", "\x01", "é", "ß", "a'b", "[{}]", "null", "NaN"]
    df = spark.createDataFrame([(a + b, i) for i, (a, b) in enumerate((a, b) for a in odd for b in odd)], "k string, i int")
    for buckets in (5, 60):
        _check_order(df, ["k"], buckets)


def test_one_exchange_of_the_rows(spark, tmp_path):
    spark.range(5000).selectExpr("id", "id % 7 AS v").write.parquet(str(tmp_path / "t"))
    df = number_rows(spark.read.parquet(str(tmp_path / "t")), ["id"], unique=True, buckets=20)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("FileScan") == 1


def test_numbers_do_not_change_when_computed_again(spark):
    df = spark.range(3000).select((F.col("id") * 7 % 3001).alias("k"), (F.col("id") % 5).alias("v"))
    out = number_rows(df, ["v"], buckets=16)
    again = number_rows(df, ["v"], buckets=9).repartition(5)
    assert out.exceptAll(out.repartition(3)).isEmpty()
    assert out.exceptAll(again).isEmpty()  # the number is a matter of the order, not of the buckets
