import pytest
from pyspark.sql import functions as F

import tableflow as tf
from tableflow.joins import divisible_join

from collected import rows

# Small thresholds, so that small tables meet what large ones do.
SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
}


@pytest.fixture
def small(spark):
    before = {name: spark.conf.get(name, None) for name in SMALL}
    for name, value in SMALL.items():
        spark.conf.set(name, value)
    yield spark
    for name, value in before.items():
        spark.conf.set(name, value) if value is not None else spark.conf.unset(name)


def _final_plan(df):
    whole = df.agg(F.count("*"), *[F.max(c) for c in df.columns])
    whole.collect()
    plan = whole._jdf.queryExecution().executedPlan().toString()
    return plan[:plan.index("Initial Plan")]


def test_a_key_with_a_third_of_the_rows_is_split(small):
    third = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k")
    left = small.range(300_000, numPartitions=8).select(third, F.md5(F.col("id").cast("string")).alias("v"))
    right = small.range(300_000, numPartitions=8).repartition(8).select((F.col("id") * 2).alias("p"))
    names = right.select(F.col("p").cast("string").alias("name"))
    text_left = left.withColumn("k", F.col("k").cast("string"))
    assert "skew=true" in _final_plan(tf.orphan_rows(left, right, ["k"], ["p"]))
    assert "skew=true" in _final_plan(tf.restrict_to_list(text_left, "k", names))
    assert "skew=true" in _final_plan(tf.valid_only(left, right, "k", "p", "p > 5"))


def test_same_result_as_a_plain_join(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (1, "d")], "k int, v string")
    right = spark.createDataFrame([(1,), (None,), (3,)], "p int").distinct()
    wide = right.select(F.col("p").cast("bigint").alias("p"))
    for how in ("left_semi", "left", "left_anti"):
        wanted = sorted(map(str, rows(left.join(right, left["k"] == right["p"], how))))
        assert sorted(map(str, rows(divisible_join(left, right, [left["k"]], [right["p"]], how)))) == wanted
        assert sorted(map(str, rows(divisible_join(left, wide, [left["k"]], [wide["p"]], how)))) == wanted
