import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import tableflow as tf
from tableflow.operators.mapping import ROW_WIDTH_LIMIT, exact_types
from tableflow.sources.catalogue import CATALOGUE_DDL

from collected import rows

# type, length, precision, scale, average, default -> compat type, compat default, our type, our max, our default
CASES = [
    ("VARCHAR2", 50, None, None, 10, None, "VARCHAR(50)", None, "string", 50, None),
    ("NVARCHAR2", 100, None, None, 10, "'a b'", "VARCHAR(100)", "'AB'", "string", 100, "'a b'"),
    ("VARCHAR2", 32, None, None, 10, "SYS_GUID()", "VARCHAR(32)", "", "string", 32, None),
    ("VARCHAR2", 20, None, None, 10, "USER", "VARCHAR(20)", "", "string", 20, None),
    ("VARCHAR2", 10000, None, None, 10, None, "TINYTEXT", "null", "string", 10000, None),
    ("CHAR", 1, None, None, 2, "'Y'", "CHAR(1)", "'Y'", "string", 1, "'Y'"),
    ("NCHAR", 4, None, None, 8, None, "CHAR(4)", None, "string", 4, None),
    ("UROWID", 18, None, None, 8, None, "VARCHAR(18)", None, "string", 18, None),
    ("DATE", 0, None, None, 8, "sysdate", "DATETIME", "current_timestamp()", "timestamp_ntz", None, "current_timestamp()"),
    ("DATE", 0, None, None, 8, "SYSDATE", "DATETIME", "", "timestamp_ntz", None, "current_timestamp()"),
    ("DATE", 0, None, None, 8, "( (SYSDATE) )", "DATETIME", "current_timestamp()", "timestamp_ntz", None,
     "current_timestamp()"),
    ("TIMESTAMP(6)", 0, None, 6, 11, "systimestamp", "DATETIME", "", "timestamp_ntz", None, None),
    ("TIMESTAMP(0)", 0, None, 0, 11, None, "DATETIME", "", "timestamp_ntz", None, None),
    ("TIMESTAMP(3)", 0, None, 3, 11, None, "TIMESTAMP(3)(0)", None, "timestamp_ntz", None, None),
    ("NUMBER", 0, 5, 2, 4, "0.5", "DECIMAL(5,2)", "0.5", "decimal(5,2)", None, "0.5"),
    ("NUMBER", 0, 2, 5, 4, None, "DECIMAL(2,5)", None, "decimal(5,5)", None, None),
    ("NUMBER", 0, 20, 0, 6, None, "BIGINT", None, "bigint", None, None),
    ("NUMBER", 0, 10, 0, 5, "(7)", "INT", "7", "int", None, "7"),
    ("NUMBER", 0, 10, 0, 3, "''", "INT", "", "int", None, None),
    ("NUMBER", 0, 10, 0, 3, "-1", "INT", "1", "int", None, "-1"),
    ("NUMBER", 0, 10, 0, 3, "1.5", "INT", "1", "int", None, "1.5"),
    ("NUMBER", 0, 10, 0, 3, "NULL", "INT", "NULL", "int", None, None),
    ("NUMBER", 0, None, None, 8, None, "BIGINT", None, "bigint", None, None),
    ("NUMBER", 0, None, None, None, None, "INT", None, "bigint", None, None),
    ("NUMBER", 0, None, 0, 6, "12", "BIGINT", "12", "bigint", None, "12"),
    ("NUMBER", 0, None, 0, 2, None, "INT", None, "int", None, None),
    ("NUMBER", 0, 5, -2, 4, None, None, None, "decimal(38,0)", None, None),
    ("NUMBER", 0, None, 2, 4, None, None, None, "decimal(38,2)", None, None),
    ("NUMBER", 0, 38, 35, 9, None, "DECIMAL(38,29)", None, "decimal(38,29)", None, None),
    ("CLOB", 0, None, None, 90, "'x'", "LONGTEXT", "", "string", None, None),
    ("NCLOB", 0, None, None, 90, None, "LONGTEXT", "", "string", None, None),
    ("LONG", 0, None, None, 90, None, "LONGTEXT", "", "string", None, None),
    ("BLOB", 0, None, None, 90, None, "LONGBLOB", "", "binary", None, None),
    ("RAW", 0, None, None, 90, None, "LONGBLOB", "", "binary", None, None),
    ("LONG RAW", 0, None, None, 90, None, "LONGBLOB", "", "binary", None, None),
    ("FLOAT", 0, 126, None, 5, None, "FLOAT(0)", None, "double", None, None),
    ("XMLTYPE", 0, None, None, 5, None, "XMLTYPE(0)", None, None, None, None),
]


def _catalogue(spark, cases, table="T"):
    return spark.createDataFrame(
        [(table, i, f"C{i}", c[0], c[1], c[2], c[3], i % 2 == 0, f'note "{i}"', c[5], c[4])
         for i, c in enumerate(cases)], CATALOGUE_DDL)


def test_every_rule(spark):
    got = tf.map_types(_catalogue(spark, CASES)).orderBy("column_id").collect()
    for case, row in zip(CASES, got, strict=True):
        assert (row.spark_type, row.max_length, row.target_default) == case[8:11], case


def test_every_rule_compat(spark):
    got = tf.map_types(_catalogue(spark, CASES), compat=True).orderBy("column_id").collect()
    for case, row in zip(CASES, got, strict=True):
        assert (row.target_type, row.target_default) == case[6:8], case
        assert (row.rule == "dropped") == (case[6] is None)


def test_default_without_digits(spark):
    cases = [("NUMBER", 0, 10, 0, 3, "SEQ.NEXTVAL"), ("VARCHAR2", 5, None, None, 3, None)]
    catalogue = _catalogue(spark, cases, "A").unionByName(_catalogue(spark, cases[1:], "B"))
    compat = tf.map_types(catalogue, compat=True).select("table_name", "target_type", "rule")
    assert sorted(rows(compat), key=str) == [
        ("A", None, "table_lost"), ("A", None, "table_lost"), ("B", "VARCHAR(5)", "varchar")]
    ours = tf.map_types(catalogue).where("table_name = 'A'").orderBy("column_id").collect()
    assert [(r.spark_type, r.target_default) for r in ours] == [("int", None), ("string", None)]


def test_profile_keeps_values_in_range(spark):
    cases = [("NUMBER", 0, 20, 0, 6, None), ("NUMBER", 0, None, None, 3, None), ("NUMBER", 0, 10, 0, 3, None)]
    profile = spark.createDataFrame(
        [("T", "C0", "0", "99999999999999999999", 0), ("T", "C1", "0", "5", 3), ("T", "C2", "-3000000000", "1", 0)],
        "table_name string, column_name string, lo string, hi string, max_scale int").selectExpr(
        "table_name", "column_name", "CAST(lo AS decimal(38,10)) min_value", "CAST(hi AS decimal(38,10)) max_value",
        "max_scale")
    got = tf.map_types(_catalogue(spark, cases), profile=profile).orderBy("column_id")
    assert [r.spark_type for r in got.collect()] == ["decimal(20,0)", "decimal(38,3)", "bigint"]


def test_schema_keeps_nullability_and_comments(spark):
    mapped = tf.map_types(_catalogue(spark, CASES[:2]))
    schema = tf.schema_of(tf.column_rules(mapped, "t"))
    assert schema == T.StructType([
        T.StructField("C0", T.StringType(), True, {"comment": "note 0"}),
        T.StructField("C1", T.StringType(), False, {"comment": "note 1"})])


def test_fit_row_width(spark):
    wide = [("VARCHAR2", 4000, None, None, 9, None)] * 20
    catalogue = _catalogue(spark, wide, "W").unionByName(_catalogue(spark, [("VARCHAR2", 50, None, None, 9, None)], "N"))
    lengths = [0, 1, 3, 5, 7, 10] + [10] * 14
    data = spark.createDataFrame([tuple("x" * n for n in lengths)], ", ".join(f"C{i} string" for i in range(20)))
    widths = tf.text_widths(data).select(F.lit("W").alias("table_name"), "column_name", "width")
    out = tf.fit_row_width(catalogue, widths).orderBy("table_name", "column_id").collect()
    assert [r.fitted_length for r in out if r.table_name == "W"][:6] == [100, 2, 4, 8, 10, 15]
    assert [(r.fitted_length, r.narrowed) for r in out if r.table_name == "N"] == [(50, False)]
    assert sum(r.fitted_length for r in out if r.table_name == "W") < ROW_WIDTH_LIMIT


def test_text_widths(spark):
    df = spark.createDataFrame([("é" * 3, None, 1), ("ab", None, 2)], "a string, b string, n int")
    assert rows(tf.text_widths(df)) == [("a", 3, 4), ("b", 0, 100)]
    assert rows(tf.text_widths(df.limit(0))) == [("a", 0, 100), ("b", 0, 100)]


def test_number_widths(spark):
    df = spark.createDataFrame([(1, "2.50"), (-100, "0.125"), (None, None)], "a bigint, d string").withColumn(
        "d", F.col("d").cast("decimal(10,4)"))
    got = {r.column_name: r for r in tf.number_widths(df).collect()}
    assert (got["a"].avg_length, got["a"].min_value, got["a"].max_value, got["a"].max_scale) == (2.5, -100, 1, 0)
    assert (float(got["d"].min_value), float(got["d"].max_value), got["d"].max_scale) == (0.125, 2.5, 3)


@pytest.mark.parametrize("kind, expected", [
    ("int", ("NUMBER", 10, 0)), ("bigint", ("NUMBER", 19, 0)), ("decimal(7,2)", ("NUMBER", 7, 2)),
    ("string", ("VARCHAR2", None, None)), ("timestamp_ntz", ("TIMESTAMP(6)", None, None)),
    ("double", ("BINARY_DOUBLE", None, None)), ("binary", ("BLOB", None, None)), ("date", ("DATE", None, None))])
def test_catalogue_of(spark, kind, expected):
    df = spark.createDataFrame([], f"c {kind}")
    row = tf.catalogue_of(spark, {"t": df}).first()
    assert (row.data_type, row.data_precision, row.data_scale) == expected
    assert (row.table_name, row.column_id, row.column_name, row.nullable) == ("t", 1, "c", True)


def test_common_columns(spark):
    src = tf.catalogue_of(spark, {"orders": spark.createDataFrame([], "a int, b int, c int")})
    tgt = tf.catalogue_of(spark, {"ORDERS": spark.createDataFrame([], "C string, A int, z int")})
    assert [r.column_name for r in tf.common_columns(src, tgt).orderBy("column_id").collect()] == ["a", "c"]


def test_column_catalogue_of_a_store(spark, tmp_path):
    store = tf.parquet_store(str(tmp_path))
    tf.replace(spark.createDataFrame([], "a int, b decimal(9,3)"), store, "t")
    found = tf.column_catalogue(spark, store, ["t"]).orderBy("column_id").collect()
    assert [(r.column_name, r.data_type, r.data_precision, r.data_scale) for r in found] == [
        ("a", "NUMBER", 10, 0), ("b", "NUMBER", 9, 3)]


def test_measured_catalogue(spark):
    df = spark.createDataFrame([("ab", 100, [1]), ("é", 5, None)], "s string, n int, a array<int>")
    found = {r.column_name: r for r in tf.measured_catalogue(spark, {"t": df}).collect()}
    assert (found["s"].char_length, found["s"].avg_col_len) == (2, 2)
    assert (found["n"].char_length, found["n"].avg_col_len) == (None, 2)
    assert (found["a"].data_type, found["a"].avg_col_len) == ("ARRAY<INT>", None)


def test_exact_types(spark):
    mapped = tf.map_types(_catalogue(spark, [CASES[0], CASES[14], CASES[17], ("BLOB", 0, None, None, 9, None)]))
    assert exact_types(tf.column_rules(mapped, "T")) == {"C1": "decimal(5,2)", "C3": "binary"}


def test_places_of_doubles_agree_with_decimals(spark):
    values = [0.0, -0.0, 1e-7, 1.5e-9, 1e-11, 123456789.125, 1.25e7, 1e22, 1e30, float("nan"), float("inf"), 1 / 3, 2e-3,
              1.0000000001, 1.00000000005, 100.0, None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    near = F.col("x").try_cast("decimal(38,10)")
    exact = F.when(near.cast("double") == F.col("x"), near)
    places = F.length(F.rtrim(F.split_part(exact.cast("string"), F.lit("."), F.lit(2)), F.lit("0")))
    plain = df.agg(F.min(exact), F.max(exact), F.max(places), F.count_if(F.col("x").isNotNull() & exact.isNull())).first()
    found = tf.number_widths(df).select("min_value", "max_value", "max_scale", "inexact").first()
    assert tuple(found) == tuple(plain)
