"""Ranges over several keys, lists in parts, merged profiles, fewest columns narrowed, code rewritten."""

import datetime as dt

import tableflow as tf
from pyspark.sql import functions as F

from collected import rows


def _hits(df, predicates):
    return df.select(*[F.expr(p).alias(f"r{i}") for i, p in enumerate(predicates)]).collect()


def test_ranges_of_texts_times_and_nulls(spark):
    texts = [None, "", "a", "a'b", "a\\", "b", "é", "日本"]
    days = [None, dt.date(2020, 1, 1), dt.date(2021, 2, 3)]
    times = [None, dt.datetime(2020, 1, 1, 3, 4, 5, 678901), dt.datetime(2024, 7, 1)]
    data = [(t, d, m, n) for t in texts for d in days for m in times for n in (None, 1.5, 2.0)]
    df = spark.createDataFrame(data, "t string, d date, m timestamp, n double").repartition(5).withColumn("n", F.col("n").cast("decimal(5,2)"))
    for keys in (["t", "d", "m", "n"], ["n", "t"], ["m"], ["d", "m"]):
        cuts = tf.tuple_cuts(df, keys, 9)
        predicates = tf.tuple_predicates(keys, cuts)
        assert 1 < len(predicates) <= 9 and len(predicates) == len(cuts) + 1
        assert all([bool(x) for x in r].count(True) == 1 and None not in r for r in _hits(df, predicates))


def test_ranges_are_about_equal(spark):
    df = spark.range(40_000).select(F.concat(F.lit("k"), F.col("id") % 1000).alias("a"), F.col("id").alias("b"))
    predicates = tf.tuple_predicates(["a", "b"], tf.tuple_cuts(df, ["a", "b"], 8))
    sizes = df.agg(*[F.count_if(F.expr(p)) for p in predicates]).first()
    assert len(sizes) == 8 and sum(sizes) == 40_000 and max(sizes) < 6500 and min(sizes) > 3500


def test_ranges_of_one_key_and_of_nothing(spark):
    same = spark.createDataFrame([("x",)] * 50, "t string")
    predicates = tf.tuple_predicates(["t"], tf.tuple_cuts(same, ["t"], 4))
    assert len(predicates) == 2 and all(sum(r) == 1 for r in _hits(same, predicates))
    assert tf.tuple_predicates(["t"], tf.tuple_cuts(same.limit(0), ["t"], 4)) == ["1 = 1"]


def test_parts_join_to_the_list(spark):
    data = [("hot", i % 700, f"v{i}") for i in range(2_000)] + [(None, i, "n") for i in range(25)]
    data += [("one", 1, None), ("one", 2, "x"), ("gone", 1, None)]
    df = spark.createDataFrame(data, "g string, v int, value string").repartition(7)
    parts = tf.ordered_parts(df, ["g"], "value", ["v"], 100).collect()
    assert all(p.row_count <= 100 for p in parts) and max(p.part for p in parts) == 19
    whole = {}
    for p in sorted(parts, key=lambda p: p.part):
        whole.setdefault(p.g, []).append(p.value_list)
    expected = {}
    for g, v, value in sorted((d for d in data if d[2]), key=lambda d: (str(d[0]), d[1], d[2])):
        expected.setdefault(g, []).append(value)
    assert {g: ",".join(v) for g, v in whole.items()} == {g: ",".join(v) for g, v in expected.items()}
    assert tf.ordered_parts(df.limit(0), ["g"], "value", ["v"]).count() == 0


def test_fewest_columns_are_narrowed(spark):
    catalogue = spark.createDataFrame(
        [("W", i + 1, f"C{i}", "VARCHAR2" if i < 4 else "CHAR", n) for i, n in enumerate([4000, 3000, 3000, 10, 500])]
        + [("N", 1, "C0", "VARCHAR2", 4000), ("X", 1, "C0", "CHAR", 9000), ("X", 2, "C1", "VARCHAR2", 200)],
        "table_name string, column_id int, column_name string, data_type string, char_length int")
    widths = spark.createDataFrame([("W", "C0", 3900), ("W", "C1", 50), ("W", "C2", 50), ("W", "C3", 99), ("X", "C1", 1)],
                                   "table_name string, column_name string, width int")

    def fitted(limit):
        out = tf.fit_row_width_least(catalogue, widths, limit).orderBy("table_name", "column_id").collect()
        return {t: [(r.fitted_length, r.narrowed, r.fits) for r in out if r.table_name == t] for t in "WNX"}

    assert [n for _, n, _ in fitted(8000)["W"]] == [False, True, False, False, False]
    assert [n for _, n, _ in fitted(7000)["W"]] == [False, True, True, False, False]
    all_of_them = fitted(4000)
    assert all_of_them["W"] == [(3900, True, False), (50, True, False), (50, True, False), (10, False, False), (500, False, False)]
    assert all_of_them["N"] == [(4000, False, True)]
    assert all_of_them["X"] == [(9000, False, False), (1, True, False)]
    assert tf.fit_row_width_least(catalogue.limit(0), widths).count() == 0


def test_only_code_is_rewritten(spark):
    def one(text):
        return tf.rewrite_code(spark.createDataFrame([(text,)], "t string"), "t").first().t

    assert one("nvl(a,'nvl(') || nvl(b, 'it''s nvl(') --nvl(\nnvl(") == "ifnull(a,'nvl(') || ifnull(b, 'it''s nvl(') -- nvl(\nifnull("
    assert one("/* nvl( ' */ nvl(\"nvl(\") -- ok 'nvl(\n- nvl( / 2") == "/* nvl( ' */ ifnull(\"nvl(\") -- ok 'nvl(\n- ifnull( / 2"
    assert one(r"unistr('\0030')||'unistr(''\0031'')'||unistr('\0032')") == r"0||'unistr(''\0031'')'||unistr('\0032')"
    assert one("'open nvl(") == "'open nvl(" and one("/* nvl(") == "/* nvl(" and one("") == "" and one(None) is None
    long = "nvl(" + "x" * 300_000 + "'" + "y" * 300_000 + "''nvl('" + "/*" + "* " * 100_000 + "*/nvl("
    assert one(long) == "if" + "null(" + long[4:-4] + "ifnull("


def test_merged_profiles_equal_a_full_pass(spark, tmp_path):
    data = [(None if i % 7 == 0 else f"p{i % 5}", i, None if i % 3 else i / 4, "é" * (i % 9), None) for i in range(4000)]
    df = spark.createDataFrame(data, "p string, n long, d double, t string, e int")
    first = tf.profile_parts(df.where("p IN ('p1', 'p2')"), "p")
    first.write.parquet(str(tmp_path / "state"))
    known = spark.read.parquet(str(tmp_path / "state"))
    state = tf.profile_again(df, "p", known)
    assert sorted(r.part or "" for r in state.select("part").distinct().collect()) == ["", "p0", "p1", "p2", "p3", "p4"]
    assert tf.profile_again(df, "p", state).count() == state.count()
    merged = {r.column_name: r for r in tf.merged_profile(state).collect()}
    table = df.toPandas()
    assert (merged["n"].min_number, merged["n"].max_number) == (0, 3999)
    assert (merged["d"].min_number, merged["d"].max_number) == (table.d.min(), table.d.max())
    assert merged["d"].null_count == int(table.d.isna().sum()) and merged["e"].null_count == 4000
    assert merged["e"].min_number is None and merged["e"].quartiles is None
    assert (merged["t"].min_text, merged["t"].max_length, merged["t"].row_count) == ("", 8, 4000)
    assert abs(merged["n"].distinct_estimate - 4000) < 160 and abs(merged["n"].quartiles[1] - 2000) < 120
    assert tf.profile_parts(df.limit(0), "p").count() == 0
