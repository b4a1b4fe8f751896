from pyspark.sql import functions as F

import tableflow as tf

from collected import rows


def test_primary_key(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 3), (None, 3)], "a int, b int")
    wanted = [(1, 1, 2, "duplicate"), (None, 3, 2, "null")]
    for wide in (False, True):
        assert sorted(rows(tf.check_primary_key(df, ["a", "b"], wide)), key=str) == wanted


def test_unique_ignores_nulls(spark):
    df = spark.createDataFrame([("x",), ("x",), ("y",), (None,), (None,)], "a string")
    for wide in (False, True):
        assert rows(tf.check_unique(df, ["a"], wide)) == [("x", 2)]


def test_hot_copies_collapse_before_the_exchange(spark):
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    assert rows(tf.check_unique(df, ["k"])) == [("hot", 3000)]
    plan = tf.check_unique(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan


def test_not_null_in_one_pass(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "a int, `b c` string")
    out = tf.check_not_null(df)
    assert rows(out) == [("a", 1), ("b c", 2)]


def test_orphans(spark):
    child = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (3, "e"), (3, "f")], "pk int, v string")
    parent = spark.createDataFrame([(1,), (4,)], "id int")
    assert sorted(rows(tf.orphan_rows(child, parent, ["pk"], ["id"]))) == [(2, "c"), (3, "e"), (3, "f")]
    assert sorted(rows(tf.orphan_summary(child, parent, ["pk"], ["id"]))) == [(2, 1), (3, 2)]
    plan = tf.orphan_summary(child, parent, ["pk"], ["id"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join LeftOuter") < plan.index("Aggregate [pk")  # counted below the join
    self_child = spark.createDataFrame([(1, None), (2, 1), (3, 9)], "id int, up int")
    assert rows(tf.orphan_rows(self_child, self_child, ["up"], ["id"])) == [(3, 9)]


def test_assign_ids(spark):
    df = spark.range(2000).select(
        F.when(F.col("id") % 7 > 0, F.col("id")).alias("n"), F.concat(F.lit("k"), F.col("id") % 13).alias("k"))
    out = tf.assign_ids(df, "n", ["k"])
    kept = df.where("n IS NOT NULL")
    assert out.join(kept, ["n", "k"], "left_semi").count() == kept.count()
    stats = out.agg(F.count("*"), F.count_distinct("n"), F.max("n")).first()
    missing = 2000 - kept.count()
    assert tuple(stats) == (2000, 2000, 1999 + missing)
    assert out.schema["n"].dataType == df.schema["n"].dataType
    empty = spark.createDataFrame([(None, "a"), (None, "b")], "n int, k string")
    assert sorted(rows(tf.assign_ids(empty, "n", ["k"]))) == [(1, "a"), (2, "b")]


def test_ordered_list(spark):
    df = spark.createDataFrame([("g", 2, "b"), ("g", 1, "a"), ("g", 10, "z"), ("h", 1, None), ("h", 2, "q'")],
                               "g string, p int, v string")
    assert sorted(rows(tf.ordered_list(df, ["g"], "v", ["p"]))) == [("g", "a,b,z"), ("h", "q'")]
    parts = tf.ordered_list(df, ["g"], "v", ["p"], sep="','", chunk=F.floor(F.col("p") / 2))
    assert sorted(rows(parts)) == [("g", "a','b','z"), ("h", "q'")]


def test_key_columns(spark):
    columns = spark.createDataFrame(
        [("T", "PK", "B", 2), ("T", "PK", "A", 1), ("T", "U1", "A", 1), ("T", "X1", "B", 1), ("T", "F1", "S", 1),
         ("T", "M1", "C", 1), ("T", "R1", "D", 1), ("O", "X2", "A", 1)],
        "table_name string, index_name string, column_name string, column_position int")
    indexes = spark.createDataFrame(
        [("PK", "UNIQUE", "NORMAL"), ("U1", "UNIQUE", "NORMAL"), ("X1", "NONUNIQUE", "NORMAL"),
         ("F1", "NONUNIQUE", "FUNCTION-BASED NORMAL"), ("M1", "NONUNIQUE", "BITMAP"), ("R1", "NONUNIQUE", "NORMAL"),
         ("X2", "NONUNIQUE", "NORMAL")], "index_name string, uniqueness string, index_type string")
    constraints = spark.createDataFrame([("PK", "P"), ("R1", "R"), ("C9", "C")],
                                        "constraint_name string, constraint_type string")
    names = tf.name_list(spark.createDataFrame([(" t ",)], "value string"))
    assert sorted(rows(tf.key_columns(columns, indexes, constraints, names))) == [
        ("T", "M1", "C", "BITMAP"), ("T", "PK", "A,B", "PRIMARY KEY"), ("T", "R1", "D", "FOREIGN KEY"),
        ("T", "U1", "A", "UNIQUE"), ("T", "X1", "B", "PLAIN")]
    assert tf.key_columns(columns, indexes, constraints).count() == 6


def test_foreign_keys(spark):
    constraints = spark.createDataFrame(
        [("FK", "CHILD", "R", "PK"), ("PK", "PARENT", "P", None), ("FX", "CHILD", "R", "GONE")],
        "constraint_name string, table_name string, constraint_type string, r_constraint_name string")
    columns = spark.createDataFrame(
        [("FK", "Y", 2), ("FK", "X", 1), ("PK", "P", 1), ("PK", "Q", 2)],
        "constraint_name string, column_name string, position int")
    assert sorted(rows(tf.foreign_keys(constraints, columns))) == [
        ("FK", "CHILD", "X,Y", "PARENT", "P,Q"), ("FX", "CHILD", None, None, None)]


def test_identity_columns(spark):
    body = "BEGIN SELECT S.NEXTVAL INTO :NEW.ID FROM DUAL; END;"
    triggers = spark.createDataFrame(
        [("A", "BEFORE EACH ROW", body), ("A", "BEFORE EACH ROW", body), ("B", "AFTER EACH ROW", body),
         ("C", "BEFORE EACH ROW", "BEGIN SELECT 1 INTO :NEW.ID FROM DUAL; END;"),
         ("D", "BEFORE EACH ROW", "begin\n select s.nextval into:new.key_no from sys.dual ; end;"),
         ("E", "BEFORE EACH ROW", "BEGIN :NEW.ID := S.NEXTVAL; END;")],
        "table_name string, trigger_type string, trigger_body string")
    assert sorted(rows(tf.identity_columns(triggers))) == [("A", "ID"), ("D", "KEY_NO")]
    assert tf.identity_count(triggers).first()[0] == 4
