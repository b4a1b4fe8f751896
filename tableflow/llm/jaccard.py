"""Texts linked by the Jaccard similarity of their word shingles, through R-trees of count vectors.

Shingles are hashed into groups, so a set is a point that counts its members by group. Similar sets
differ in few shingles, at most a share of both sizes that the threshold fixes; with more groups
than that, some groups have to be equal. So the tree's top is a partition into cells: the sets that
have a certain group, with its content, in common.

* A set's groups are ordered from the rarest content on. It takes part in the cells of as many groups
  as may differ, and one more; a pair that is similar meets in one of these at least. Groups that no other
  set shares count among them, so most sets take part in none.
* Cells of the same members are one cell.
* In each cell all members are compared with the one that shares most, by the bound and then by
  their whole sets. Where that leaves more than one component, the cell's points become R-trees,
  joined under the bound; pairs that survive are verified by their whole sets. A large cell is cut
  into blocks: what is outside its largest component meets all of it, block by block.

Nothing is sampled or capped: a pair of similarity at or above the threshold is linked or connected
already. Shingles and sets are named by hashes of 64 bits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableflow.joins import divisible_join
from tableflow.llm.common import ids_column, prepare
from tableflow.llm.components import components
from tableflow.llm.rtree import RTree, joined, needed
from tableflow.session import materialise

SHINGLE = 5
PERCENT = 80
SEED = 42
LOAD = 3.2  # shingles in a group, at the upper end of a class of sizes
SMALL = 64  # sets below this size get finer groups
FINE = 8
TILE = 2_048
DIMS = (16, 8_192)  # coordinates of points, about 4 to 8 for each shingle
SEEN = 1 << 20

_ENTRIES = "array<struct<class: int, slack: int, cells: array<long>>>"
_SKETCH = f"text_key long, doc_id long, size long, node long, entries {_ENTRIES}"


def shingles(text: str, shingle: int = SHINGLE) -> np.ndarray:
    """The distinct hashes of a text's shingles, ascending. A text of fewer words is one shingle, one without words none."""
    data = text.encode().lower()  # A-Z alone change; words are parted at 0x20 and 0x09 to 0x0D
    words = data.split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = (ends - np.diff(ends, prepend=0))[:len(words) - shingle + 1].tolist()
    ends = (ends[shingle - 1:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends, strict=True)], np.uint64))


def _mix(x: np.ndarray) -> np.ndarray:
    """Numbers spread over 64 bits."""
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def _groups(found: np.ndarray, count: int) -> np.ndarray:
    """The group of each shingle."""
    return ((found >> np.uint64(32)) * np.uint64(count) >> np.uint64(32)).astype(np.int64)


def classes_of(size: int, percent: int = PERCENT) -> list[tuple[int, int]]:
    """The classes of sizes (powers of two) a set takes part in, and the shingles by which it may differ in each.

    A set meets smaller ones in their class, where that is the one below its own.
    """
    own = size.bit_length() - 1
    found = [(own, (size + size * 100 // percent) * (100 - percent) // (100 + percent))]
    largest = (1 << own) - 1  # of the class below
    if largest and largest * 100 >= size * percent:
        found.append((own - 1, (size + largest) * (100 - percent) // (100 + percent)))
    return found


def group_count(level: int, load: float = LOAD) -> int:
    """Groups of the sets of a class: ``load`` shingles each in the largest ones, fewer in small sets."""
    largest = 2 << level
    return max(1, math.ceil(largest * FINE * LOAD / load if largest <= SMALL else largest / load))


def cells(found: np.ndarray, level: int, load: float = LOAD) -> np.ndarray:
    """Names of a set's groups, each with its content."""
    group = _groups(found, group_count(level, load))  # ascending, as the hashes are
    first = np.flatnonzero(np.diff(group, prepend=-1))
    content = np.add.reduceat(_mix(found), first)
    return _mix(content + _mix(group[first].astype(np.uint64) + np.uint64(level << 40)))


def entries_of(found: np.ndarray, percent: int = PERCENT, load: float = LOAD) -> list[tuple[int, int, np.ndarray]]:
    """Class, slack and cells: of the shared cells as many as ``slack`` may be left out."""
    out = []
    for level, differing in classes_of(len(found), percent):
        names = cells(found, level, load)
        out.append((level, len(names) - differing - 1, names.view(np.int64)))
    return out


def vector(found: np.ndarray, level: int) -> np.ndarray:
    """The point of a set among sets of a class: its shingles by group."""
    dims = min(max(1 << (level + 3), DIMS[0]), DIMS[1])
    counts = np.bincount(_groups(_mix(found), dims), minlength=dims)
    return counts.astype(np.uint8 if counts.max() < 256 else np.uint32)


def _points(level: int, stored: pd.Series) -> np.ndarray:
    """Points as they were before they were stored; those of a class have the same number of coordinates."""
    dims = min(max(1 << (level + 3), DIMS[0]), DIMS[1])
    return np.array([np.frombuffer(x, np.uint8 if len(x) == dims else np.uint32) for x in stored])


def similar(one: np.ndarray, other: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether the sets' overlap is ``percent`` of their union or more; the bound goes first."""
    sizes = len(one) + len(other)
    least = int(needed(sizes, percent))
    if min(len(one), len(other)) < least:
        return False
    level = max(len(one), len(other)).bit_length() - 1
    if np.minimum(vector(one, level), vector(other, level)).sum(dtype=np.int64) < least:
        return False
    return len(np.intersect1d(one, other, assume_unique=True)) >= least


def _node(found: np.ndarray) -> int:
    """The name of a set."""
    return xxhash.xxh3_64_intdigest(found.tobytes()) - (1 << 63)


def _sketches(texts: DataFrame, shingle: int, percent: int, load: float) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()  # copies a task meets again have no entries of their own
        for batch in batches:
            out = []
            for key, doc, text in zip(batch["text_key"], ids_column(batch["doc_id"]), batch["text"], strict=True):
                found = shingles(text, shingle)
                if not len(found):
                    out.append((key, doc, 0, None, None))
                    continue
                node = _node(found)
                parts = None
                if node not in seen:
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(node)
                    parts = [{"class": level, "slack": slack, "cells": names} for level, slack, names in entries_of(found, percent, load)]
                out.append((key, doc, len(found), node, parts))
            keys, ids, sizes, nodes, entries = zip(*out, strict=True) if out else [()] * 5
            yield pd.DataFrame({"text_key": keys, "doc_id": pd.array(ids, "Int64"), "size": sizes, "node": pd.array(nodes, "Int64"),
                                "entries": pd.Series(entries, dtype="object")})

    return texts.mapInPandas(run, _SKETCH)


def _sets(texts: DataFrame, shingle: int) -> DataFrame:
    """The sets of the nodes wanted, once each, from (text_key, node, text); copies of a text are passed over."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()
        for batch in batches:
            out = []
            for key, node, text in zip(batch["text_key"], batch["node"], batch["text"], strict=True):
                if key not in seen:
                    found = shingles(text, shingle)
                    if _node(found) == node:
                        out.append((node, found.tobytes()))
                        if len(seen) >= SEEN:
                            seen.clear()
                        seen.add(key)
            yield pd.DataFrame(out, columns=["node", "found"])

    return texts.mapInPandas(run, "node long, found binary").groupBy("node").agg(F.first("found").alias("found"))


def _shared_cells(sketches: DataFrame) -> DataFrame:
    """(cell, level, node, share) for each cell with members to compare; ``share`` is larger the more of a set is shared."""
    entries = sketches.where("entries IS NOT NULL").select("node", F.inline("entries"))
    rows = entries.select("node", F.expr("class * 1000000000L + slack").alias("kind"), F.explode("cells").alias("cell"))
    # One exchange serves both sides: the counts keep a column of each kind, so that both read the same.
    rows = rows.repartition("cell")
    counts = (rows.groupBy(F.col("cell").alias("of")).agg(F.count("*").alias("n"), F.min("node").alias("low"), F.max("node").alias("high"),
                                                         F.max("kind").alias("most"))
              .where("low <> high AND most IS NOT NULL").select("of", "n"))
    common = materialise(rows.join(counts.hint("shuffle_hash"), rows.cell == counts.of).select("cell", "n", "node", "kind").distinct(), "cells")
    each = common.groupBy("node", "kind").agg(F.sort_array(F.collect_list(F.struct("n", "cell"))).alias("shared"))
    share = F.size("shared") - F.col("kind") % 1_000_000_000
    taken = each.where(share > 0).select("node", F.expr("CAST(kind DIV 1000000000L AS INT)").alias("level"), share.cast("long").alias("share"),
                                         F.explode(F.slice("shared", 1, share.cast("int"))).alias("x"))
    taken = materialise(taken.select(F.col("x.cell").alias("cell"), "level", "node", "share"), "cells")
    named = taken.groupBy("cell").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"),
                                      F.max(F.struct("share", "node")).alias("best")).where("n > 1")
    one = named.groupBy("n", "x", "y").agg(F.min(F.struct("cell", "best.node")).alias("c")).select(
        F.col("c.cell").alias("of"), F.col("c.node").alias("centre"))
    return materialise(divisible_join(taken, one, [taken.cell], [one.of], "inner").select("cell", "level", "node", "centre"), "cells")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The ``pairs`` (a, b) that are similar, by their whole sets."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            near = np.array([similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent)
                             for x, y in zip(batch["one"], batch["other"], strict=True)], bool)
            yield batch.loc[near, ["a", "b"]]

    ones = sets.select(F.col("node").alias("of"), F.col("found").alias("one"))
    others = sets.select(F.col("node").alias("at"), F.col("found").alias("other"))
    known = divisible_join(pairs, others, [pairs.b], [others["at"]], "inner")
    return divisible_join(known, ones, [known.a], [ones.of], "inner").select("a", "b", "one", "other").mapInPandas(run, "a long, b long")


def _runs(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Groups of rows sorted by ``keys``."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        code = batch[keys].to_numpy()
        cuts = [0, *(np.flatnonzero((code[1:] != code[:-1]).any(axis=1)) + 1).tolist(), len(batch)]
        for a, z in zip(cuts, cuts[1:], strict=False):
            if held and (held[0][keys].iloc[0].to_numpy() != code[a]).any():
                yield pd.concat(held) if len(held) > 1 else held[0]
                held = []
            held.append(batch.iloc[a:z])
    if held:
        yield pd.concat(held) if len(held) > 1 else held[0]


def _surviving(members: DataFrame, sets: DataFrame, percent: int, tile: int = TILE) -> DataFrame:
    """Pairs of different components that the R-trees of their cells leave, from (cell, level, node, label)."""
    points = members.select(F.col("node").alias("at"), F.col("level").alias("of_level")).distinct()

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [np.frombuffer(x, np.uint64) for x in batch["found"]]
            yield pd.DataFrame({"at": batch["at"], "of_level": batch["of_level"], "size": [len(x) for x in found],
                                "point": [vector(x, n).tobytes() for x, n in zip(found, batch["of_level"], strict=True)]})

    points = materialise(points.join(sets, points["at"] == sets.node).select("at", "of_level", "found")
                         .mapInPandas(placed, "at long, of_level int, size long, point binary"), "points")
    by_label = members.groupBy("cell", "label").agg(F.count("*").alias("n"))
    plan = by_label.groupBy(F.col("cell").alias("of")).agg(F.max(F.struct("n", "label")).alias("main"), F.sum("n").alias("n"))
    plan = plan.select("of", F.col("main.label").alias("main"), F.ceil(F.col("n") / tile).cast("int").alias("tiles"),
                       F.greatest(F.ceil((F.col("n") - F.col("main.n")) / tile), F.lit(1)).cast("int").alias("blocks"))
    known = divisible_join(members, plan, [members.cell], [plan.of], "inner")
    place = F.xxhash64("node")
    left = known.where("label <> main").select("cell", "level", "node", "label", F.pmod(place, "blocks").cast("int").alias("block"),
                                               F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile"), F.lit(0).alias("side"))
    right = known.select("cell", "level", "node", "label", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
                         F.pmod(place, "tiles").cast("int").alias("tile"), (F.col("label") != F.col("main")).cast("int").alias("rest"))
    both = left.withColumn("rest", F.lit(1)).unionByName(right.withColumn("side", F.lit(1)))
    full = both.join(points, (both.node == points["at"]) & (both.level == points.of_level))

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in _runs(batches, ["cell", "block", "tile"]):
            one, other = group[group["side"] == 0], group[group["side"] == 1]
            if not len(one) or not len(other):
                continue
            trees = [RTree(_points(int(g["level"].iloc[0]), g["point"]), g["size"].to_numpy(), g["label"].to_numpy()) for g in (one, other)]
            i, j = joined(*trees, percent)
            a, b = one["node"].to_numpy()[i], other["node"].to_numpy()[j]
            keep = (other["rest"].to_numpy()[j] == 0) | (a < b)  # pairs of the rest are met from either side
            if keep.any():
                yield pd.DataFrame({"a": np.minimum(a, b)[keep], "b": np.maximum(a, b)[keep]})

    spread = full.select("cell", "block", "tile", "side", "rest", "level", "node", "label", "size", "point")
    return spread.repartition("cell", "block", "tile").sortWithinPartitions("cell", "block", "tile").mapInPandas(walk, "a long, b long").distinct()


def _proposed(sketches: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b): the set of each class's document and the other sets of the class, from (doc_id, component_id)."""
    rows = sketches.where("node IS NOT NULL").select("doc_id", "node")
    members = classes.where("doc_id <> component_id").join(rows, "doc_id").select("component_id", F.col("node").alias("b")).distinct()
    heads = rows.select(F.col("doc_id").alias("of"), F.col("node").alias("a"))
    return members.join(heads, members.component_id == heads.of).where("a <> b").select("a", "b").distinct()


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The ``pairs`` (a, b) that are not of one component yet."""
    known = pairs.join(roots.toDF("n", "one"), pairs.a == F.col("n"), "left").join(roots.toDF("m", "other"), pairs.b == F.col("m"), "left")
    return known.where(F.coalesce("one", "a") != F.coalesce("other", "b")).select("a", "b")


def links(sketches: DataFrame, texts: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, proposed: DataFrame | None = None) -> DataFrame:
    """``node`` and ``root`` of each set that is similar to another: the component it belongs to.

    ``proposed`` pairs (a, b) are verified first; what they connect is not compared again.
    """
    members = _shared_cells(sketches)
    wanted = members.select(F.col("node").alias("at")).distinct()
    first = sketches.where("entries IS NOT NULL").groupBy("node").agg(F.min("text_key").alias("first"))
    first = first.join(wanted, first.node == wanted["at"]).select("node", "first")
    chosen = divisible_join(texts, first, [texts.text_key], [first["first"]], "inner").select("text_key", "node", "text")
    sets = materialise(_sets(chosen, shingle), "sets")

    pairs = members.where("node <> centre").select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct()
    if proposed is not None:  # a similar pair shares a cell, so its sets are among these
        settled = materialise(_verified(materialise(proposed, "pairs"), sets, percent), "links")
        pairs = _apart(pairs, materialise(components(settled), "roots"))
    found = materialise(_verified(materialise(pairs, "pairs"), sets, percent), "links")
    if proposed is not None:
        found = found.unionByName(settled)
    roots = materialise(components(found), "roots")
    labelled = members.join(roots.toDF("n", "root"), members.node == F.col("n"), "left").select(
        "cell", "level", "node", F.coalesce("root", "node").alias("label"))
    labelled = materialise(labelled, "members")
    still = (labelled.groupBy(F.col("cell").alias("of")).agg(F.min("label").alias("low"), F.max("label").alias("high"))
             .where("low <> high").select("of"))
    left = materialise(divisible_join(labelled, still, [labelled.cell], [still.of], "left_semi"), "members")
    pairs = materialise(_surviving(left, sets, percent), "pairs")
    return components(found.unionByName(_verified(pairs, sets, percent)))


def near_sets(texts: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, load: float = LOAD,
              classes: DataFrame | None = None) -> DataFrame:
    """doc_id, size and root of each row of (doc_id, text): rows of one root are copies or linked.

    The root of a text without words is null. ``classes`` (doc_id, component_id; the ids then are unique)
    are near copies by another method: each text is first compared with that of its class's document.
    """
    prepare(texts.sparkSession)
    texts = texts.withColumn("text_key", F.xxhash64("text"))
    sketches = materialise(_sketches(texts, shingle, percent, load), "sketches")
    # A set with no more groups than may differ would meet nobody: then all groups are halved.
    while sketches.select(F.inline("entries")).where("slack < 0").take(1):
        load /= 2
        sketches = materialise(_sketches(texts, shingle, percent, load), "sketches")
    proposed = None if classes is None else _proposed(sketches, classes)
    roots = materialise(links(sketches, texts.select("text_key", "text"), shingle, percent, proposed), "roots")
    rows = sketches.select("doc_id", "size", "node")
    return divisible_join(rows, roots.toDF("n", "root"), [rows.node], [F.col("n")], "left").select(
        "doc_id", "size", F.coalesce("root", "node").alias("root"))


def near_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                   percent: int = PERCENT, load: float = LOAD) -> DataFrame:
    """doc_id, n_shingles and component_id, the least doc_id reachable over links of ``percent`` or more.

    One row for each input row; repeated rows and equal sets are linked. A text of fewer words than a
    shingle is one shingle. A null text counts as empty; a text without words has no shingles, no links and
    its own id as component. A null doc_id stays null and lends its component no name. A text of any
    length is one set. An empty table gives no rows; other columns stay behind, whatever their names.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rooted = materialise(near_sets(texts, shingle, percent, load), "rooted")
    names = rooted.where("root IS NOT NULL").groupBy(F.col("root").alias("of")).agg(F.min("doc_id").alias("component_id"))
    named = divisible_join(rooted, names, [rooted.root], [names.of], "left")
    own = F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return named.select("doc_id", F.col("size").alias("n_shingles"), own.alias("component_id"))
