"""Approximate nearest neighbours by counting collisions in windows around the query.

Unit vectors are projected on random lines. Per line, an index shard holds its vectors' places on
it in order. A query opens a window around its own place on each line; a vector that lies in
enough of the windows is verified against the original vectors. While its k-th best is farther
than the radius the windows stand for, they grow (virtual rehashing: a wider window replaces a
table of wider buckets). With ``LINES`` lines, a vector at that radius is missed in about 10 of
100 cases, a nearer one less often.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tableflow.llm.common import prepare
from tableflow.session import fresh_path, materialise

LINES = 64
WIDTH = 2.7  # of a window, in radii: a vector at the radius is in it with probability 0.82
COLLISIONS = 49  # of LINES
FIRST_RADIUS = 0.3
GROWTH = 1.25
SHARD_ROWS = 8_192
_APART = 1_000.0  # more than any two places differ
QUERY_ROWS = 512

_INDEX = "dim int, shard int, ids binary, vectors binary, places binary, order binary"
_FOUND = "query_id long, vec_id long, score double"


@lru_cache(maxsize=8)
def _directions(dim: int) -> np.ndarray:
    return np.random.default_rng(dim).standard_normal((dim, LINES))


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null, without nulls and non-finite numbers, not zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0)


def _vectors(rows: pd.DataFrame) -> np.ndarray:
    return np.array(rows["v"].tolist(), np.float64)


def _unit(vectors: np.ndarray) -> np.ndarray:
    largest = np.abs(vectors).max(axis=1, keepdims=True)  # first, so that squares neither vanish nor overflow
    scaled = vectors / largest
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def build(vectors: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The index, a row for each shard: ids, vectors, and per line the sorted places and whose they are."""
    shards = max(1, -(-vectors.count() // shard_rows))

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("id")
        found = _vectors(rows)
        places = (_unit(found) @ _directions(key[0])).T
        order = np.argsort(places, axis=1, kind="stable")
        return pd.DataFrame([(key[0], key[1], rows["id"].to_numpy(np.int64).tobytes(), found.tobytes(),
                              np.ascontiguousarray(np.take_along_axis(places, order, 1)).tobytes(), order.astype(np.int32).tobytes())],
                            columns=["dim", "shard", "ids", "vectors", "places", "order"])

    return (vectors.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int"))
            .groupBy("dim", "shard").applyInPandas(run, _INDEX))


def search_shard(ids: np.ndarray, unit: np.ndarray, vectors: np.ndarray, places: np.ndarray, order: np.ndarray,
                 query_ids: np.ndarray, queries: np.ndarray, k: int) -> list[tuple[int, int, float]]:
    """(query, vector, cosine) for the ``k`` nearest that each query finds in one shard."""
    out = []
    lines, size = places.shape
    units = _unit(queries)
    # All lines in one ascending array: places lie within +-_APART / 2 of their line's middle.
    middle = np.arange(lines) * _APART
    line = (places + middle[:, None]).ravel()
    centres = units @ _directions(queries.shape[1]) + middle
    flat, starts = order.ravel(), np.arange(lines) * size
    for q in range(len(query_ids)):
        low = high = None
        counts = np.zeros(size, np.int64)
        tried = ids == query_ids[q]  # never its own neighbour
        near, score = np.zeros(0, np.int64), np.zeros(0)
        radius = FIRST_RADIUS
        while True:
            half = radius * WIDTH / 2
            a = np.maximum(np.searchsorted(line, centres[q] - half, "left"), starts)
            z = np.minimum(np.searchsorted(line, centres[q] + half, "right"), starts + size)
            edges = [(a, z)] if low is None else [(a, low), (high, z)]
            low, high = a, z
            counts += np.bincount(np.concatenate([flat[i:j] for x, y in edges for i, j in zip(x.tolist(), y.tolist(), strict=True)]),
                                  minlength=size)
            new = np.flatnonzero((counts >= COLLISIONS) & ~tried)
            if len(new):
                tried[new] = True
                # Row by row, so that equal vectors have equal cosines.
                near = np.concatenate([near, new])
                score = np.concatenate([score, (unit[new] * units[q]).sum(axis=1)])
            if (low == starts).all() and (high == starts + size).all():
                break
            if len(near) >= k and 2 - 2 * np.partition(score, len(score) - k)[len(score) - k] <= radius * radius:
                break
            radius *= GROWTH
        best = np.lexsort((ids[near], -score))[:k]
        out += [(int(query_ids[q]), int(ids[near[b]]), float(score[b])) for b in best]
    return out


def nearest(vectors: DataFrame, queries: Column, k: int, id_col: str = "vec_id", vector_col: str = "embedding",
            shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank (from 1), vec_id and score: the ``k`` nearest found for each row that ``queries`` holds of.

    Nearness is the cosine in double precision, ties go to the smaller id. Every usable vector is
    indexed; only vectors of a query's own length are its candidates, and none with its own id.
    Rows with a null id take no part. A query without candidates has no rows. Blocks of queries
    meet each shard once; a block and a shard are what a task holds.
    """
    spark = vectors.sparkSession
    prepare(spark)
    vector, own = F.col(f"`{vector_col}`"), F.col(f"`{id_col}`")
    rows = materialise(vectors.where(own.isNotNull() & usable(vector)).select(
        own.cast("long").alias("id"), F.transform(vector, lambda x: x.cast("double")).alias("v"),
        F.size(vector).alias("dim"), F.coalesce(queries, F.lit(False)).alias("asks")), "vectors")
    index = materialise(build(rows.select("id", "v", "dim"), shard_rows), "index")
    asked = rows.where("asks")
    blocks = max(1, -(-asked.count() // query_rows))

    def block(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([(key[0], rows["id"].to_numpy(np.int64).tobytes(), _vectors(rows).tobytes())],
                            columns=["dim", "query_ids", "queries"])

    asked = (asked.withColumn("block", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks)))
             .groupBy("dim", "block").applyInPandas(block, "dim int, query_ids binary, queries binary"))
    places = index.groupBy("dim").agg(F.collect_list("shard").alias("shards"))
    pairs = asked.join(places, "dim").withColumn("shard", F.explode("shards")).drop("shards").join(index, ["dim", "shard"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                ids = np.frombuffer(r.ids, np.int64)
                found = np.frombuffer(r.vectors, np.float64).reshape(-1, r.dim)
                hits = search_shard(ids, _unit(found), found, np.frombuffer(r.places, np.float64).reshape(LINES, -1),
                                    np.frombuffer(r.order, np.int32).reshape(LINES, -1), np.frombuffer(r.query_ids, np.int64),
                                    np.frombuffer(r.queries, np.float64).reshape(-1, r.dim), k)
                yield pd.DataFrame(hits, columns=["query_id", "vec_id", "score"])

    # A row holds a shard: few rows at a time go to Python.
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    usual, path = spark.conf.get(key), fresh_path(spark, "found")
    spark.conf.set(key, "4")
    try:
        pairs.mapInPandas(run, _FOUND).write.parquet(path)
    finally:
        spark.conf.set(key, usual)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (spark.read.schema(_FOUND).parquet(path).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
