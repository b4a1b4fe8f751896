import tableflow as tf
from tableflow.functions.text import java_quoted

from collected import rows


def _one(spark, text):
    return spark.createDataFrame([(text,)], "t string")


def test_rewrite_views(spark):
    assert tf.rewrite_text(_one(spark, "select nvl(a,0) -- c"), "t").first().t == "select ifnull(a,0) -- --  c"
    text = r"unistr('\0030')||unistr('\0031')||unistr('\0032')||unistr('\0033')"
    assert tf.rewrite_text(_one(spark, text), "t").first().t == r"0||1||unistr('\0032')||3"


def test_replacements_are_applied_in_order(spark):
    rules = [("e", "E"), ("Ea", "ea")]
    assert tf.rewrite_text(_one(spark, "eaeb$1\\"), "t", rules).first().t == "eaEb$1\\"


def test_normalise(spark):
    assert tf.normalise_text(_one(spark, "into:new.id from sys.dual ;"), "t").first().t == "INTO :NEW.ID FROM DUAL;"
    assert tf.normalise_text(_one(spark, "a\nb SYS.DUAL"), "t").first().t == "AB DUAL"


def test_strip_definition(spark):
    text = 'CREATE INDEX "U"."I" ON "U"."T" (UPPER("N")) PCTFREE 10'
    assert tf.strip_definition(_one(spark, text), "t", " PCTFREE", "U").first().t == "CREATE INDEX I ON T (UPPER(N))"
    assert tf.strip_definition(_one(spark, "no marker"), "t", " PCTFREE", "U").first().t is None
    assert tf.strip_definition(_one(spark, 'a\n"b" u.c pctfree PCTFREE'), "t", " pctfree", "U").first().t == "ab c"
    assert tf.strip_definition(_one(spark, 'x "S"."P" '), "t", schema="S").first().t == "x P"
    assert tf.strip_definition(_one(spark, "aXb a.b"), "t", schema="a").first().t == "aXb b"


def test_quoting_a_pattern():
    assert java_quoted("A.$#(") == r"A\.\$\#\("


def test_between(spark):
    df = spark.createDataFrame([("a<x>1</x></x>",), ("</x><x>2",), ("<x></x>",), (None,), ("é<x>é</x>",)], "t string")
    assert [r.found for r in tf.text_between(df, "t", "<x>", "</x>").collect()] == ["1", None, "", None, "é"]


def test_valid_only(spark):
    defs = spark.createDataFrame([("V1",), ("V2",)], "view_name string")
    objects = spark.createDataFrame([("V1", "VALID"), ("V1", "VALID"), ("V2", "INVALID")], "object_name string, status string")
    assert rows(tf.valid_only(defs, objects, "view_name", "object_name", "status = 'VALID'")) == [("V1",)]


def test_name_list(spark, tmp_path):
    path = tmp_path / "names.txt"
    path.write_text("orders\n\n  \n Lineitem ,x\n,skipped\n")
    assert rows(tf.read_name_list(spark, str(path))) == [("ORDERS",), ("LINEITEM",)]
    df = spark.createDataFrame([("orders ",), ("part",)], "n string")
    names = tf.read_name_list(spark, str(path))
    assert rows(tf.restrict_to_list(df, "n", names)) == [("orders ",)]
    assert tf.restrict_to_list(df, "n", None).count() == 2
