import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

import tableflow as tf
from tableflow.functions.rounding import to_second
from tableflow.operators.mapping import ColumnRule

from collected import rows

RULES = [ColumnRule("a", "int"), ColumnRule("b", "string", max_length=3, nullable=False), ColumnRule("d", "decimal(3,1)")]


def test_reasons(spark):
    df = spark.createDataFrame(
        [("1", "abc", "1.5"), ("x", "abcd", "1.5"), ("2", None, "1234"), (None, "", "12.34")], "a string, b string, d string")
    good, bad = tf.conform(df, RULES)
    assert sorted(rows(good), key=str) == [(1, "abc", Decimal("1.5")), (None, "", Decimal("12.3"))]
    assert sorted(rows(bad), key=str) == [("2", None, "1234", "b:null;d:type"), ("x", "abcd", "1.5", "a:type;b:length")]


def test_exact_scale_and_empty_text(spark):
    df = spark.createDataFrame([("1", "", "12.34"), ("1", "é€ß", "2.5")], "a string, b string, d string")
    good, bad = tf.conform(df, RULES, exact_scale=True, empty_as_null=True)
    assert rows(good) == [(1, "é€ß", Decimal("2.5"))]
    assert rows(bad) == [("1", "", "12.34", "b:null;d:scale")]


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.one_of(st.none(), st.text("12x.-", max_size=4)), st.one_of(st.none(), st.text("ab", max_size=5)),
                          st.one_of(st.none(), st.text("0123.", max_size=5))), max_size=30))
def test_good_and_rejects_are_the_input(spark, data):
    df = spark.createDataFrame(data, "a string, b string, d string")
    good, bad = tf.conform(df, RULES)
    assert good.count() + bad.count() == len(data)
    kept = sorted(map(str, rows(bad.drop("reject_reason"))))
    assert all(k in sorted(map(str, data)) for k in kept)


def test_rounding_to_the_second(spark):
    times = ["2024-03-10 02:30:00.499999", "2024-03-10 02:30:00.5", "2023-12-31 23:59:59.75", "1899-12-31 23:59:59.2"]
    df = spark.createDataFrame([(t,) for t in times], "t string")
    ntz = df.select(to_second(F.col("t").cast("timestamp_ntz")).cast("string")).collect()
    assert [r[0] for r in ntz] == [
        "2024-03-10 02:30:00", "2024-03-10 02:30:01", "2024-01-01 00:00:00", "1899-12-31 23:59:59"]
    zoned = df.limit(3).select(to_second(F.timestamp_micros(F.lit(1_500_000))).alias("t")).first()
    assert zoned.t.timestamp() == 2


def test_seconds_can_be_kept(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 0, 700000),)], "t timestamp_ntz")
    rule = [ColumnRule("t", "timestamp_ntz")]
    assert tf.conform(df, rule)[0].first().t == dt.datetime(2024, 1, 1, 0, 0, 1)
    assert tf.conform(df, rule, whole_seconds=False)[0].first().t == dt.datetime(2024, 1, 1, 0, 0, 0, 700000)


def test_align(spark):
    df = spark.createDataFrame([(1, "x", 2.0)], "A int, b string, gone double")
    target = T.StructType.fromDDL("B string, extra bigint, a bigint")
    out = tf.align(df, target)
    assert rows(out) == [("x", None, 1)] and out.columns == ["B", "extra", "a"]


def test_names_match_in_any_case(spark):
    good, bad = tf.conform(spark.createDataFrame([(1, "x")], "Id int, NAME string"),
                           [ColumnRule("ID", "bigint"), ColumnRule("name", "string", max_length=3)])
    assert good.columns == ["ID", "name"] and rows(good) == [(1, "x")] and bad.count() == 0


def test_fractions_do_not_become_whole_numbers(spark):
    df = spark.createDataFrame([(Decimal("1.70"), 3.99, "2.50"), (Decimal("2.00"), 4.0, "3")], "a decimal(10,2), b double, c string")
    rules = [ColumnRule("a", "bigint"), ColumnRule("b", "int"), ColumnRule("c", "int")]
    good, bad = tf.conform(df, rules)
    assert rows(good) == [(2, 4, 3)]
    assert [r.reject_reason.split(";")[:2] for r in bad.collect()] == [["a:scale", "b:scale"]]


def test_exact_scale_of_long_numbers(spark):
    long = Decimal("1234567890123456789012345")
    df = spark.createDataFrame([(long, Decimal("1.25"), 0.5), (long, Decimal("1.20"), 0.55)], "a decimal(30,0), b decimal(10,2), c double")
    rules = [ColumnRule("a", "decimal(38,5)"), ColumnRule("b", "decimal(10,1)"), ColumnRule("c", "decimal(3,1)")]
    good, bad = tf.conform(df, rules, exact_scale=True)
    assert good.count() == 0 and [r.reject_reason for r in bad.orderBy("b", ascending=False).collect()] == ["b:scale", "c:scale"]


def test_each_column_is_ruled_kept_or_an_error(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    with pytest.raises(ValueError, match="B"):
        tf.conform(df, [ColumnRule("a", "int")])
    assert tf.conform(df, [ColumnRule("a", "int")], ["b"])[0].columns == ["a", "b"]


def test_numbers_that_are_no_decimals_are_counted(spark):
    df = spark.createDataFrame([(1e-12,), (1e30,), (0.25,), (-3.5,), (float("nan"),), (None,)], "x double")
    r = tf.number_widths(df).first()
    assert (r.min_value, r.max_value, r.max_scale, r.inexact) == (Decimal("-3.5"), Decimal("0.25"), 2, 3)
