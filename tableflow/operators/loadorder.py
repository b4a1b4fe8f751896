"""The order in which tables can be loaded: levels of the graph of their references, cycles as one step."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..joins import divisible_join
from ..session import materialise


def _spread(links: DataFrame, values: DataFrame, name: str, best, within: DataFrame | None = None) -> DataFrame:
    """Carry ``values`` (node, value) along links (a to b), each node keeping the best, until nothing changes.

    With ``within`` (node, kind), only along links whose ends are of one kind.
    """
    if within is not None:
        ends = within.toDF("at", "kind")
        links = divisible_join(links, ends, [links.a], [ends["at"]], "inner").select("a", "b", F.col("kind").alias("one"))
        links = divisible_join(links, ends, [links.b], [ends["at"]], "inner").where("one = kind").select("a", "b")
        links = materialise(links, name)
    now, moved = values.toDF("node", "value"), values.toDF("node", "value")
    while True:
        # Only what changed in the last turn can change its neighbours.
        given = divisible_join(links, moved, [links.a], [moved.node], "inner").groupBy(F.col("b").alias("to")).agg(best("value").alias("offered"))
        both = divisible_join(now, given, [now.node], [given["to"]], "left")
        better = best_of(best, F.col("value"), F.col("offered"))
        after = materialise(both.select("node", better.alias("value"), (~better.eqNullSafe(F.col("value"))).alias("changed")), name)
        now, moved = after.select("node", "value"), after.where("changed").select("node", "value")
        if moved.isEmpty():
            return now


def best_of(best, one, other):
    return F.greatest(one, other) if best is F.max else F.least(one, other)


def strong_components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the largest node of its cycle group) of all nodes of ``links`` (a, b).

    Nodes on no cycle are peeled off from both ends first. In what is left, each node takes the largest label that
    reaches it; the nodes from which a label's own node can be reached inside its colour are one
    component, which leaves the graph. Each turn settles every colour's component at once.
    """
    links = materialise(links.toDF("a", "b").where("a IS NOT NULL AND b IS NOT NULL").distinct(), "links")
    nodes = materialise(links.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "nodes")
    links = links.where("a <> b")
    done = nodes.select("node", F.col("node").alias("root")).where(F.lit(False))
    while True:
        # A node without a link in, or out, is a component of its own.
        while True:
            inner = links.select("a").distinct().join(links.select(F.col("b").alias("a")).distinct(), "a", "left_semi")
            ends = inner.select(F.col("a").alias("n"))
            kept = divisible_join(links, ends, [links.a], [ends.n], "left_semi")
            kept = materialise(divisible_join(kept, ends, [kept.b], [ends.n], "left_semi"), "links")
            before, after = links.count(), kept.count()
            links = kept
            if before == after:
                break
        if not after:
            return nodes.join(done, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
        left = materialise(links.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "nodes")
        colours = _spread(links, left.select("node", F.col("node").alias("value")), "colours", F.max)
        back = links.select(F.col("b").alias("a"), F.col("a").alias("b"))
        seeds = colours.select("node", F.when(F.col("node") == F.col("value"), F.col("value")).alias("value"))
        reached = _spread(back, seeds, "reached", F.max, colours)
        found = materialise(reached.where("value IS NOT NULL").select("node", F.col("value").alias("root")), "found")
        done = materialise(done.unionByName(found), "done")
        gone = found.select(F.col("node").alias("n"))
        links = divisible_join(links, gone, [links.a], [gone.n], "left_anti")
        links = materialise(divisible_join(links, gone, [links.b], [gone.n], "left_anti"), "links")


def load_order(references: DataFrame, tables: DataFrame | None = None) -> DataFrame:
    """``table_name, load_level, cycle, in_cycle`` of every table.

    ``references`` has ``child_table`` and ``parent_table``, as ``foreign_keys`` gives them; ``tables``
    (table_name) adds those without references. A table's level is one more than the highest level of the
    tables it refers to, 0 without any: all tables of a level can be loaded at a time, after those below.
    Tables that refer to each other in a circle share a level and a ``cycle``, the largest name among
    them; they load together, with their keys checked afterwards. A reference of a table to itself is
    such a circle of one; nulls and repeated references change nothing. The turns grow with the
    longest chain of references, not with the number of tables.
    """
    pairs = references.select(F.col("parent_table").alias("a"), F.col("child_table").alias("b"))
    pairs = materialise(pairs.where("a IS NOT NULL AND b IS NOT NULL").distinct(), "references")
    parts = materialise(strong_components(pairs), "parts")
    to = parts.toDF("n", "root")
    links = divisible_join(pairs, to, [pairs.a], [to.n], "inner").select(F.col("root").alias("a"), "b")
    links = materialise(divisible_join(links, to, [links.b], [to.n], "inner").select("a", F.col("root").alias("b"))
                        .where("a <> b").distinct(), "links")
    levels = parts.select(F.col("root").alias("part")).distinct().withColumn("level", F.lit(0))
    raised = levels
    while True:
        # Without circles, a part's level is settled once no part below it rises any more.
        given = (divisible_join(links, raised, [links.a], [raised.part], "inner")
                 .groupBy(F.col("b").alias("to")).agg((F.max("level") + 1).alias("least")))
        both = divisible_join(levels, given, [levels.part], [given["to"]], "left")
        after = materialise(both.select("part", F.greatest("level", "least").alias("level"),
                                        F.coalesce(F.col("least") > F.col("level"), F.lit(False)).alias("rose")), "levels")
        levels, raised = after.select("part", "level"), after.where("rose").select("part", "level")
        if raised.isEmpty():
            break
    itself = pairs.where("a = b").select(F.col("a").alias("own")).distinct()
    size = parts.groupBy(F.col("root").alias("of")).agg(F.count("*").alias("members"))
    found = (parts.join(levels, parts.root == levels.part).join(size, parts.root == size.of)
             .join(itself, parts.node == itself.own, "left"))
    circle = (F.col("members") > 1) | F.col("own").isNotNull()
    found = found.select(F.col("node").alias("table_name"), F.col("level").cast("int").alias("load_level"),
                         F.when(circle, F.col("root")).alias("cycle"), circle.alias("in_cycle"))
    if tables is None:
        return found
    names = tables.select("table_name").where("table_name IS NOT NULL").distinct()
    alone = names.join(found, "table_name", "left_anti").select(
        "table_name", F.lit(0).alias("load_level"), F.lit(None).cast("string").alias("cycle"), F.lit(False).alias("in_cycle"))
    return found.unionByName(alone)
