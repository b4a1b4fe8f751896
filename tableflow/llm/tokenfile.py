"""Documents' token ids in files: written in the order of their ids, read back in parallel.

A data set is a folder of two Parquet tables: ``table`` has the frequencies of the coder
(``rans.py``), ``blocks`` one row for each block, with its place, the documents it holds and
the encoded bytes. Blocks hold whole documents; one longer than a block fills blocks of its own.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tableflow.llm.common import ids_column, prepare, texts, word_tokens
from tableflow.llm.rans import BLOCK_IDS, Block, Table, decode_block, encode_block, frequencies
from tableflow.session import fresh_path

_BLOCKS = ("shard int, block long, n_ids long, first_doc long, first_part int, doc_ids array<long>, doc_sizes array<long>,"
           " words binary, states binary, mark_words array<long>, crc long, lanes int, every int")
_PARTS = "shard int, block long, doc_no long, part int, doc_id long, before long, n_ids long, ids_crc32 long"


def _encoded(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, end = word_tokens(path), np.array([end_id], "<u4")
        kind = "<u2" if max(words.size, end_id + 1) <= 1 << 16 else "<u4"
        for batch in batches:
            ids = [np.concatenate([x, end]).astype(kind) for x in words.encode(batch["text"].tolist())]
            yield pd.DataFrame({"doc_id": ids_column(batch["doc_id"]), "width": np.int32(np.dtype(kind).itemsize),
                                "ids": [x.tobytes() for x in ids]})

    return docs.mapInPandas(encode, "doc_id long, width int, ids binary")


def _ids(width: int, data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{width}").astype(np.uint32)


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts = np.zeros(0, np.int64)
    for batch in batches:
        for width, held in batch.groupby("width")["ids"]:
            more = np.bincount(_ids(width, b"".join(held)))
            if len(more) > len(counts):
                counts = np.pad(counts, (0, len(more) - len(counts)))
            counts[:len(more)] += more
    found = np.flatnonzero(counts)
    yield pd.DataFrame({"id": found, "n": counts[found]})


def write_tokens(docs: DataFrame, target: str, path: str, end_id: int, id_col: str = "doc_id",
                 text_col: str = "text", block_ids: int = BLOCK_IDS) -> None:
    """Write the ids of all documents to the folder ``target``, in ascending order of document id.

    ``path`` names the vocabulary; ``end_id`` closes each document. A null text counts as empty,
    null ids come first, rows of one id are ordered by their ids' bytes. The frequency table
    spans the whole input; it is bounded by the vocabulary, and the only thing tasks share.
    """
    spark = docs.sparkSession
    staged = fresh_path(spark, "ids")
    _encoded(texts(docs, id_col, text_col), path, end_id).write.option("compression", "zstd").parquet(staged)
    ids = spark.read.schema("doc_id long, width int, ids binary").parquet(staged)
    counted = ids.mapInPandas(_count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(int(counted["id"].max()) + 1 if len(counted) else 0, np.int64)
    counts[counted["id"].to_numpy(np.int64)] = counted["n"]
    freq = frequencies(counts)
    spark.createDataFrame(pd.DataFrame({"id": np.flatnonzero(freq), "freq": freq[freq > 0].astype(np.int64)}),
                          "id long, freq long").coalesce(1).write.parquet(f"{target}/table")

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table, shard = Table(freq), TaskContext.get().partitionId()
        held: list[tuple[int | None, np.ndarray]] = []
        size = number = docs_before = 0

        def row(first: int, part: int, parts: list[tuple[int | None, np.ndarray]]) -> dict:
            b = encode_block(np.concatenate([x for _, x in parts]), table)
            return {"shard": shard, "block": number, "n_ids": b.n_ids, "first_doc": first, "first_part": part,
                    "doc_ids": [d for d, _ in parts], "doc_sizes": [len(x) for _, x in parts], "words": b.words,
                    "states": b.states, "mark_words": b.mark_words, "crc": b.crc, "lanes": b.lanes, "every": b.every}

        def rows(found: list[dict]) -> pd.DataFrame:
            return pd.DataFrame(found)

        for batch in batches:
            for doc, width, data in zip(ids_column(batch["doc_id"]), batch["width"], batch["ids"], strict=True):
                doc, x = None if pd.isna(doc) else int(doc), _ids(width, data)
                if held and size + len(x) > block_ids:
                    yield rows([row(docs_before - len(held), 0, held)])
                    held, size, number = [], 0, number + 1
                if len(x) > block_ids:
                    for part, at in enumerate(range(0, len(x), block_ids)):
                        yield rows([row(docs_before, part, [(doc, x[at:at + block_ids])])])
                        number += 1
                else:
                    held.append((doc, x))
                    size += len(x)
                docs_before += 1
        if held:
            yield rows([row(docs_before - len(held), 0, held)])

    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (ids.repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id", "ids").mapInPandas(blocks, _BLOCKS)
     .write.option("compression", "none").parquet(f"{target}/blocks"))


def read_parts(spark: SparkSession, target: str, with_ids: bool = False) -> DataFrame:
    """Each document's ids from the files, a row for each block it lies in.

    ``before`` counts the ids ahead of it in its block; ``ids`` (on request) are little-endian
    unsigned 32-bit integers. A damaged block fails the job.
    """
    prepare(spark)
    stored = spark.read.schema("id long, freq long").parquet(f"{target}/table").toPandas()
    freq = np.zeros(int(stored["id"].max()) + 1 if len(stored) else 0, np.uint32)
    freq[stored["id"].to_numpy(np.int64)] = stored["freq"]

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = Table(freq)
        for batch in batches:
            for r in batch.itertuples(index=False):
                block = Block(r.n_ids, r.words, r.states, list(r.mark_words), r.crc, r.lanes, r.every)
                ids = decode_block(block, table).astype("<u4")
                ends = np.cumsum(r.doc_sizes)
                cut = [ids[a:b] for a, b in zip(ends - r.doc_sizes, ends, strict=True)]
                out = pd.DataFrame({
                    "shard": np.int32(r.shard), "block": np.int64(r.block), "doc_no": r.first_doc + np.arange(len(cut)),
                    "part": np.int32(r.first_part), "doc_id": ids_column(pd.Series(list(r.doc_ids), dtype="object")),
                    "before": ends - r.doc_sizes, "n_ids": [len(x) for x in cut], "ids_crc32": [zlib.crc32(x) for x in cut]})
                yield out.assign(ids=[x.tobytes() for x in cut]) if with_ids else out

    stored_blocks = spark.read.schema(_BLOCKS).parquet(f"{target}/blocks")
    return stored_blocks.mapInPandas(parts, _PARTS + ", ids binary" * with_ids)


def crc32_combine(first: int, second: int, size: int) -> int:
    """The CRC-32 of two byte strings in a row, from theirs and the length of the second."""
    def times(matrix: list[int], vector: int) -> int:
        out = 0
        for row in matrix:
            if vector & 1:
                out ^= row
            vector >>= 1
        return out

    # One zero bit after the text, as a matrix over its CRC; squared for each doubling of the bits.
    step = [0xEDB88320] + [1 << k for k in range(31)]
    bits = size * 8
    while bits:
        if bits & 1:
            first = times(step, first)
        step = [times(step, row) for row in step]
        bits >>= 1
    return first ^ second


def read_digests(spark: SparkSession, target: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32 of each document in the files."""
    @F.pandas_udf("long")
    def joined(parts: pd.Series) -> pd.Series:
        def one(rows) -> int:
            crc = rows[0]["ids_crc32"]
            for r in rows[1:]:
                crc = crc32_combine(crc, r["ids_crc32"], 4 * r["n_ids"])
            return crc
        return parts.map(one)

    blocks = spark.read.schema(_BLOCKS).parquet(f"{target}/blocks").groupBy("shard").agg(F.sum("n_ids").alias("n"))
    # One row for each partition written, so this window is small at any size.
    order = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = blocks.select("shard", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("shard_start"))
    in_shard = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (spark.read.schema(_BLOCKS).parquet(f"{target}/blocks")
              .select("shard", "block", F.coalesce(F.sum("n_ids").over(in_shard), F.lit(0)).alias("block_start"))
              .join(shards, "shard").select("shard", "block", (F.col("shard_start") + F.col("block_start")).alias("first")))
    parts = read_parts(spark, target).join(starts, ["shard", "block"])
    whole = parts.groupBy("shard", "doc_no").agg(
        F.min("doc_id").alias("doc_id"), F.min(F.col("first") + F.col("before")).alias("start"),
        F.sum("n_ids").alias("n_tokens"),
        F.sort_array(F.collect_list(F.struct("part", "n_ids", "ids_crc32"))).alias("parts"))
    return whole.select("doc_id", "start", "n_tokens", joined("parts").alias("ids_crc32"))
