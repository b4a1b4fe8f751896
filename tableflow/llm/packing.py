"""Best-fit packing of token sequences by hierarchical residual packing.

Items are dealt to partitions by a hash, so that each has the whole mix of lengths however the
input is ordered. Each partition packs its own items best fit, longest first, and emits the bins it cannot
improve. The few that are least full go on as items of their own, with what they hold: groups
of partitions merge in a tree, each node packing best fit what its children passed on, until
one node is left. A node passes on ``carry`` bins at most; this bounds the memory of each node
and of the root at any number of rows, and drops nothing: further bins are emitted as they are.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableflow.llm.common import frames, ids_column, prepare, texts, word_tokens
from tableflow.session import fresh_path, materialise

CAPACITY = 4096
CARRY = 256
FAN_IN = 8
BLOCK = 200_000
TOP = 1 << 56  # sequence numbers: level, then node, then bin


def best_fit(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The bin of each item: longest first, each into the fullest bin that still has room."""
    bins = np.empty(len(sizes), np.int64)
    by_room: dict[int, list[int]] = {}
    rooms = 0  # bit r is set if a bin has room r
    count = 0
    for item in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[item])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            found = by_room[room]
            bin_no = found.pop()
            if not found:
                rooms &= ~(1 << room)
        else:
            room, bin_no, count = capacity, count, count + 1
        bins[item] = bin_no
        room -= size
        if room:
            by_room.setdefault(room, []).append(bin_no)
            rooms |= 1 << room
    return bins


def pack_once(rows: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """Best fit over the bins in ``rows`` (one row for each piece): new ``bin`` and ``offset``."""
    old, at = np.unique(rows["bin"].to_numpy(), return_inverse=True)
    fill = np.bincount(at, weights=rows["length"].to_numpy(), minlength=len(old)).astype(np.int64)
    new = best_fit(fill, capacity)
    order = np.argsort(new, kind="stable")
    ends = np.cumsum(fill[order])
    first = np.flatnonzero(np.diff(new[order], prepend=-1))
    base = np.empty(len(old), np.int64)
    base[order] = ends - fill[order] - np.repeat((ends - fill[order])[first], np.diff(np.append(first, len(old))))
    return rows.assign(bin=new[at], offset=rows["offset"].to_numpy() + base[at])


def split_open(rows: pd.DataFrame, capacity: int, carry: int) -> tuple[pd.DataFrame, pd.DataFrame]:
    """The bins to emit and the ``carry`` least full ones that are not full."""
    fill = np.bincount(rows["bin"].to_numpy(), weights=rows["length"].to_numpy())
    left = np.argsort(fill, kind="stable")[:carry]
    is_open = np.zeros(len(fill), bool)
    is_open[left[fill[left] < capacity]] = True
    stays = is_open[rows["bin"].to_numpy()]
    return rows[~stays], rows[stays]


def _numbered(rows: pd.DataFrame, level: int, node: int, start: int, is_open: bool) -> tuple[pd.DataFrame, int]:
    """Bins renamed so that no other node uses their numbers."""
    names, at = np.unique(rows["bin"].to_numpy(), return_inverse=True)
    named = rows.assign(bin=level * TOP + (node << 32) + start + at, node=np.int64(node), open=is_open)
    return named, start + len(names)


def pack(pieces: DataFrame, capacity: int = CAPACITY, carry: int = CARRY, fan_in: int = FAN_IN,
         block: int = BLOCK, length: str = "length") -> DataFrame:
    """Give each row of ``pieces`` a ``sequence_id`` and an ``offset`` in it.

    Rows keep their columns. Those of one sequence lie one after another without gaps and hold
    ``capacity`` tokens at most; a row of length 0 takes part without room of its own. A length
    that is null, negative or beyond ``capacity`` fails the job. No rows give none.
    """
    spark = pieces.sparkSession
    prepare(spark)
    own = pieces.columns
    if clash := {"sequence_id", "offset", "bin", "node", "open"} & {c.lower() for c in own}:
        raise ValueError(f"columns that packing adds are there already: {sorted(clash)}")
    shape = pieces.withColumns({"bin": F.lit(0).cast("long"), "offset": F.lit(0).cast("long"),
                                "node": F.lit(0).cast("long"), "open": F.lit(True)}).schema

    def local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        node, start, held = TaskContext.get().partitionId(), 0, None
        for batch in frames(batches, block):
            sizes = pd.to_numeric(batch[length])
            if sizes.isna().any() or (sizes < 0).any() or (sizes > capacity).any():
                raise ValueError("a piece must hold between 0 tokens and the capacity")
            rows = batch.rename(columns={length: "length"}).assign(bin=np.arange(len(batch)), offset=np.int64(0))
            if held is not None:
                rows = pd.concat([rows, held.assign(bin=held["bin"] + len(batch))], ignore_index=True)
            done, held = split_open(pack_once(rows, capacity), capacity, carry)
            done, start = _numbered(done, 0, node, start, False)
            yield done.rename(columns={"length": length})
        if held is not None:
            held, _ = _numbered(held, 0, node, start, True)
            yield held.rename(columns={"length": length})

    def merged(level: int, last: bool):
        def node_bins(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            rows = pack_once(rows.rename(columns={length: "length"}), capacity)
            done, held = split_open(rows, capacity, 0 if last else carry)
            done, start = _numbered(done, level, int(key[0]), 0, False)
            held, _ = _numbered(held, level, int(key[0]), start, True)
            return pd.concat([done, held], ignore_index=True).rename(columns={"length": length})[shape.names]
        return node_bins

    def written(df: DataFrame) -> DataFrame:
        path = fresh_path(spark, "packing")
        df.write.partitionBy("open").parquet(path)
        return spark.read.schema(shape).parquet(path)

    # Written first, so that no task needs one Python worker to cut texts and another to pack.
    staged = materialise(pieces.withColumn("node", F.monotonically_increasing_id()), "pieces")
    levels = [written(staged.repartition(F.xxhash64("node")).drop("node").mapInPandas(local, shape))]
    while True:
        left = levels[-1].where("open")
        nodes = left.agg(F.max("node")).first()[0]
        if nodes is None:
            break
        last, level = nodes < fan_in, len(levels)
        levels.append(written(left.groupBy(F.floor(F.col("node") / fan_in).alias("parent"))
                              .applyInPandas(merged(level, last), shape)))
        if last:
            break
    done = levels[0].where("NOT open")
    for level in levels[1:]:
        done = done.unionByName(level.where("NOT open"))
    return done.select(*own, F.col("bin").alias("sequence_id"), "offset")


def cut_pieces(docs: DataFrame, path: str, end_id: int, capacity: int = CAPACITY,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token pieces of each document: its ids and the end id, cut only where longer than ``capacity``.

    Columns: doc_id, piece (from 0), start (ids before it), length and ids_crc32 (of its ids as
    little-endian unsigned 32-bit integers). A null or empty text is the end id alone; repeated
    rows count each; a null id stays null.
    """
    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, end = word_tokens(path), np.array([end_id], "<u4")
        for batch in batches:
            rows = []
            for doc, ids in zip(ids_column(batch["doc_id"]), words.encode(batch["text"].tolist()), strict=True):
                ids = np.concatenate([ids, end])
                rows += [(doc, k, start, len(part := ids[start:start + capacity]), zlib.crc32(part))
                         for k, start in enumerate(range(0, len(ids), capacity))]
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            yield out.assign(doc_id=ids_column(out["doc_id"]))

    return texts(docs, id_col, text_col).mapInPandas(
        pieces, "doc_id long, piece int, start long, length long, ids_crc32 long")
