"""Repeated runs of lines, found by distributed prefix doubling and deleted but for the first copy.

Each line gets an id; the texts are sequences of ids. Round k ranks all positions by their next
2**k lines, from two ranks of the round before. Positions that share no such run with another
drop out, so the rounds shrink to what repeats. A class of positions of one rank is an interval
of the suffix array within which the longest common prefix has 2**k lines at least; its first
position is where the run is kept.

A run counts if its lines hold ``min_chars`` characters. Whatever lies in a counting run that has
an earlier copy lies in a smallest such window, one that loses the size with its last line or with
its first; so these windows are looked up. One of m lines, 2**k <= m < 2**(k + 1), is named
exactly by m and the ranks of its first and its last 2**k lines.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tableflow.joins import divisible_join
from tableflow.llm.common import prepare
from tableflow.session import fresh_path, materialise

MIN_CHARS = 150
LINE_BITS = 28  # a position is a document's number, then a line's in so many bits


def ranked(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """``df`` with the rank of each row (from 0, without gaps) in the order of ``keys``, which are unique."""
    shards = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = materialise(df.repartitionByRange(shards, *keys).sortWithinPartitions(*keys)
                         .withColumn("at", F.monotonically_increasing_id()), "ranked")
    shard = F.shiftrightunsigned("at", 33)
    counts = placed.groupBy(shard.alias("shard")).agg(F.count("*").alias("n"))
    # One row for each partition, so this window is small at any size.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return placed.withColumn("shard", shard).join(starts, "shard").withColumn(
        name, F.col("start") + F.col("at").bitwiseAND((1 << 33) - 1)).drop("shard", "start", "at")


def windows(sizes: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Lines of the smallest window of ``least`` characters that starts, and that ends, at each line; 0 if none."""
    total = np.concatenate([[0], np.cumsum(sizes)])
    here = np.arange(len(sizes))
    to = np.searchsorted(total, total[:-1] + least, "left")  # the first end that reaches the size
    since = np.searchsorted(total, total[1:] - least, "right") - 1  # the last start that leaves it
    return np.where(to <= len(sizes), to - here, 0), np.where(since >= 0, here + 1 - since, 0)


def _sketches(staged: DataFrame, least: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch["text"]:
                lines = text.split("\n")
                sizes = np.fromiter(map(len, lines), np.int64, len(lines))
                after, before = windows(sizes, least)
                ids = np.frombuffer(b"".join([xxhash.xxh3_128_digest(x.encode()) for x in lines]), "<i8").reshape(-1, 2)
                rows.append((ids[:, 0], ids[:, 1], after, before))
            yield pd.DataFrame(rows, columns=["high", "low", "after", "before"]).assign(uid=batch["uid"])

    return staged.select("uid", "text").where("text IS NOT NULL").mapInPandas(
        run, "uid long, high array<long>, low array<long>, after array<long>, before array<long>")


def _classes(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` that share ``keys`` with another, with ``rank`` and ``first``, the least position of the class."""
    own = [f"of_{k}" for k in keys]
    found = (rows.groupBy(*[F.col(k).alias(o) for k, o in zip(keys, own, strict=True)])
             .agg(F.count("*").alias("n"), F.min("pos").alias("first")).where("n > 1").drop("n"))
    found = materialise(ranked(found, own, "rank"), "classes")
    return divisible_join(rows, found, [rows[k] for k in keys], [found[o] for o in own], "inner").select(
        rows["pos"], found["rank"], found["first"])


def repeated_windows(lines: DataFrame) -> DataFrame:
    """Windows (pos, m) that have an earlier copy.

    ``lines`` has pos, high and low (the line's id), after and before (lines of the smallest
    window that starts, and that ends, at the line; 0 if none).
    """
    wanted = materialise(lines.select(F.explode(F.array(
        F.struct("pos", F.col("after").alias("m")),
        F.struct((F.col("pos") - F.col("before") + 1).alias("pos"), F.col("before").alias("m")))).alias("x"))
        .select("x.*").where("m > 0").distinct(), "windows")
    most = wanted.agg(F.max("m")).first()[0] or 0
    ranks = materialise(_classes(lines, ["high", "low"]), "ranks")
    hits, step = [wanted.where(F.lit(False))], 1
    while step <= most:
        here = wanted.where(F.col("m").between(step, 2 * step - 1))
        starts = here.join(ranks, "pos")
        hits.append(starts.where((F.col("m") == step) & (F.col("first") < F.col("pos"))).select("pos", "m"))
        if step > 1:
            ends = ranks.select((F.col("pos")).alias("end_pos"), F.col("rank").alias("end_rank"))
            odd = materialise(starts.where(F.col("m") > step).withColumn("end_pos", F.col("pos") + F.col("m") - step)
                              .join(ends, "end_pos").select("pos", "m", "rank", "end_rank"), "windows")
            least = odd.groupBy(*[F.col(c).alias(f"of_{c}") for c in ("m", "rank", "end_rank")]).agg(F.min("pos").alias("least"))
            hits.append(divisible_join(odd, least, [odd[c] for c in ("m", "rank", "end_rank")],
                                       [least[f"of_{c}"] for c in ("m", "rank", "end_rank")], "inner")
                        .where("least < pos").select("pos", "m"))
        if 2 * step > most:
            break
        nexts = ranks.select((F.col("pos") - step).alias("pos"), F.col("rank").alias("next_rank"))
        # Lines of one document have adjacent positions; a gap of line numbers lies between documents.
        ranks = materialise(_classes(ranks.select("pos", "rank").join(nexts, "pos"), ["rank", "next_rank"]), "ranks")
        step *= 2
    out = hits[0]
    for more in hits[1:]:
        out = out.unionByName(more)
    return out


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the lines of repeated runs, the first copy excepted, and two more columns.

    ``lines_before`` and ``lines_removed`` count a text's lines. A run has ``min_chars`` characters
    at least (line ends not counted) and lies in one document; copies may lie in another document
    or further on in the same one. First means least id (nulls before all), then input order.
    Lines are equal if all their characters are. A null text stays null and has no lines; the
    empty one has one line and never counts; a text left without lines becomes empty. All rows
    and columns stay.
    """
    spark = docs.sparkSession
    prepare(spark)
    if clash := {"lines_before", "lines_removed"} & {c.lower() for c in docs.columns}:
        raise ValueError(f"columns that line dedup adds are there already: {sorted(clash)}")
    path = fresh_path(spark, "lines")
    (docs.select(F.struct("*").alias("row"), F.col(f"`{text_col}`").alias("text"), F.col(f"`{id_col}`").alias("id"))
     .select(F.col("row").dropFields(f"`{text_col}`") if len(docs.columns) > 1 else F.lit(None).cast("string").alias("row"),
             "text", "id", F.monotonically_increasing_id().alias("uid"))
     .toDF("row", "text", "id", "uid").write.option("compression", "zstd").parquet(path))
    staged = spark.read.parquet(path)
    numbers = ranked(staged.select("id", "uid"), ["id", "uid"], "number").select("uid", "number")
    each = _sketches(staged, min_chars).join(numbers, "uid").select(
        "number", F.posexplode(F.arrays_zip("high", "low", "after", "before")).alias("line", "x"))
    # Every number of a document is followed by an empty line number, so that no run crosses documents.
    place = F.shiftleft(F.col("number"), LINE_BITS) + F.col("line")
    fits = (F.col("number") < 1 << 63 - LINE_BITS) & (F.col("line") < (1 << LINE_BITS) - 1)
    lines = materialise(each.select(
        F.when(fits, place).otherwise(F.raise_error(F.lit("too many documents, or lines in one"))).cast("long").alias("pos"), "x.*"), "lines")
    gone = (repeated_windows(lines).select(F.shiftrightunsigned("pos", LINE_BITS).alias("number"),
                                           F.col("pos").bitwiseAND((1 << LINE_BITS) - 1).alias("start"), "m")
            .groupBy("number").agg(F.collect_set(F.struct("start", "m")).alias("runs"))
            .join(numbers, "number").select("uid", F.col("runs.start").alias("starts"), F.col("runs.m").alias("sizes")))

    @F.pandas_udf("text string, removed long")
    def cut(texts: pd.Series, starts: pd.Series, sizes: pd.Series) -> pd.DataFrame:
        rows = []
        for text, first, size in zip(texts, starts, sizes, strict=True):
            if text is None:
                rows.append((None, 0))
                continue
            lines = text.split("\n")
            edges = np.zeros(len(lines) + 1, np.int64)
            np.add.at(edges, first, 1)
            np.add.at(edges, first + size, -1)
            stays = np.cumsum(edges)[:-1] == 0
            rows.append(("\n".join([x for x, keep in zip(lines, stays, strict=True) if keep]), int((~stays).sum())))
        return pd.DataFrame(rows, columns=["text", "removed"])

    # Texts without a repeated run do not go to Python.
    whole = staged.join(gone, "uid", "left").withColumn(
        "cut", cut(F.when(F.col("starts").isNotNull(), F.col("text")), "starts", "sizes"))
    new = F.when(F.col("starts").isNull(), F.col("text")).otherwise(F.col("cut.text"))
    count = F.when(F.col("text").isNull(), 0).otherwise(F.length("text") - F.length(F.replace("text", F.lit("\n"))) + 1)
    columns = [new.alias(c) if c.lower() == text_col.lower() else F.col("row")[c].alias(c) for c in docs.columns]
    return whole.select(*columns, count.cast("long").alias("lines_before"),
                        F.coalesce("cut.removed", F.lit(0)).cast("long").alias("lines_removed"))
