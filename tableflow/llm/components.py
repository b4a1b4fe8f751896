"""Connected components of links between numbers, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableflow.joins import divisible_join
from tableflow.session import materialise

_SHAPE = "a long, b long"


def _star(links: DataFrame) -> DataFrame:
    """Each a with its least b: rows (a, b, least)."""
    least = links.groupBy(F.col("a").alias("of")).agg(F.min("b").alias("least"))
    return divisible_join(links, least, [links.a], [least.of], "inner").select("a", "b", "least")


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the least node of its component) for each node that has a link.

    ``links`` has two columns of long numbers; nulls, links to oneself and repeats change nothing.
    In turns, each node ties its larger neighbours to its least one, then its smaller ones. Each
    turn is written to the shared folder, so that a lost executor repeats that turn alone. A node
    with very many links is one row for each task before the exchange, and its links are divided
    by the adaptive join.
    """
    x, y = (F.col(f"`{c}`").cast("long") for c in links.columns[:2])
    now = materialise(links.select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b"))
                      .where(x.isNotNull() & y.isNotNull() & (x != y)).distinct(), "links")
    before = None
    while True:
        found = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if found == before or not found[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        before = found
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = (_star(both).where("b > a").select(F.col("b").alias("a"), F.least("a", "least").alias("b")).distinct())
        large = materialise(large, "links")
        small = _star(large).select(
            F.explode(F.array(F.struct("a", F.col("least").alias("b")), F.struct(F.col("b").alias("a"), F.col("least").alias("b")))).alias("x"))
        now = materialise(small.select("x.a", "x.b").where("a <> b").distinct(), "links")
