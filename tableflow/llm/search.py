"""Exact top-k search by BM25 over inverted indexes with block maxima, a shard at a time.

A shard is some thousand documents of one input partition, ordered by length, with their own inverted
index. Its documents are divided into blocks, and each long list keeps the largest weight it has in
each block. A query adds up its short lists; blocks whose sums and maxima do not reach the score to
beat are passed over with all their postings in long lists. In the other blocks long lists add up as
levels, shares rounded up to 16 bits in all, which bound each document's score: only what may be among
the best is scored whole. A task holds the queries, and shards pass by; the score to beat rises from
one to the next. Scores use the number and lengths of all documents and the global document
frequencies, so the best of each task merge into the exact answer.

A word's share of a score is rounded to a millionth, and scores are sums of whole millionths:
they do not depend on the order of adding, and equal texts tie exactly. Words are known by
64-bit hashes; two of a billion distinct words share one with a probability of 3 in 100.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tableflow.joins import divisible_join
from tableflow.llm.common import ids_column, prepare
from tableflow.llm.simhash import _ranges as ranges
from tableflow.session import fresh_path, materialise

K1 = 1.2
B = 0.75
UNIT = 1_000_000
SHARD_ROWS = 16_384
BLOCK_ROWS = 512
QUERY_ROWS = 4_096
HELD_ROWS = 8 * QUERY_ROWS  # queries that a task holds
MORE = 1.25  # small shards meet the queries as one of up to so many times the usual rows
TASK_SHARDS = 16
TASKS = 3  # for each core, where there are as many shards
LONG_SHARE = 16  # a list is long from one document in so many on
LONG_SPACE = 8  # all long lists have so many levels for each posting of the shard at most
LONG_LISTS = 1 << 15
SLICE = 256  # shorter lists are picked together
CLASSES = 128
TERMS = 16_384

_INDEX = ("shard long, ids binary, no_id binary, n_docs long, n_words long, terms array<long>, dfs array<long>, lengths binary,"
          " docs binary, tfs binary")
_FOUND = "query_id long, doc_id long, score long"


def words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct words' hashes, each word as a place among them, and where each text's words begin.

    A word is a run of letters and digits in lower case.
    """
    lists = pc.utf8_split_whitespace(pc.replace_substring_regex(
        pc.utf8_lower(pa.array(texts, pa.large_string())), pattern=r"[^\pL\pN]+", replacement=" "))
    coded = lists.flatten().dictionary_encode()
    names = coded.dictionary.to_pylist()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    cuts = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    hashes = np.array([xxhash.xxh3_64_intdigest(w.encode()) for w in names], np.uint64).view(np.int64)
    real = np.array([bool(w) for w in names], bool)[codes]
    return hashes, codes[real], np.concatenate([[0], np.cumsum(real)])[cuts]


def place_type(documents: int) -> str:
    """How a shard stores the places of its documents."""
    return "<u2" if documents <= 1 << 16 else "<i4"


def postings(texts: list[str], first: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A word's hash, the document's place and how often it has the word, for each pair; and the documents' lengths."""
    hashes, codes, cuts = words(texts)
    lengths = np.diff(cuts)
    names, place = np.unique(hashes, return_inverse=True)
    pairs, tfs = np.unique(place[codes].astype(np.int64) * len(texts) + np.repeat(np.arange(len(texts)), lengths), return_counts=True)
    return names[pairs // len(texts)], (pairs % len(texts) + first).astype(np.int32), tfs.astype(np.int32), lengths


def index_rows(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]], places: np.ndarray | None = None) -> dict:
    """The inverted index of the documents in ``parts``; lists are in the order of the words' hashes.

    ``places`` holds the documents in their order in the index, if it is another one.
    """
    terms, docs, tfs, lengths = (np.concatenate(x) for x in zip(*parts, strict=True))
    if places is not None:
        place = np.empty(len(places), place_type(len(places)))
        place[places] = np.arange(len(places))
        docs, lengths = place[docs], lengths[places]
        order = np.argsort(docs, kind="stable")
        terms, docs, tfs = terms[order], docs[order], tfs[order]
    order = np.argsort(terms, kind="stable")  # documents ascend
    names, dfs = np.unique(terms[order], return_counts=True)
    return {"n_docs": len(lengths), "n_words": int(lengths.sum()), "terms": names, "dfs": dfs, "lengths": lengths.astype("<i8").tobytes(),
            "docs": docs[order].astype(place_type(len(lengths))).tobytes(), "tfs": zlib.compress(tfs[order].astype("<i4"), 1)}


def build(docs: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The index of all rows (doc_id, text), a row for each shard. Texts do not leave their partition."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, parts, shard = [], [], TaskContext.get().partitionId() << 32

        def row() -> pd.DataFrame:
            places = np.argsort(np.concatenate([lengths for *_, lengths in parts]), kind="stable")
            known = np.array([0 if i is None else i for i in ids], "<i8")[places]
            return pd.DataFrame([{"shard": shard, "ids": known.tobytes(), "no_id": np.array([i is None for i in ids])[places].tobytes()}
                                 | index_rows(parts, places)])

        for batch in batches:
            for at in range(0, len(batch), shard_rows):
                some = batch.iloc[at:at + shard_rows]
                if ids and len(ids) + len(some) > shard_rows:
                    yield row()
                    shard, ids, parts = shard + 1, [], []
                parts.append(postings(some["text"].tolist(), len(ids)))
                ids += [None if pd.isna(i) else int(i) for i in ids_column(some["doc_id"])]
        if ids:
            yield row()

    return docs.mapInPandas(run, _INDEX)


class Shard:
    """An index in memory: postings' weights without the words' rarity, their shares with it, and maxima by block.

    It may be stored in several rows. Long lists are held a second time, as a row with a level for each
    document: the share in whole steps, rounded up, so that a sum of levels bounds a sum of shares.
    """

    def __init__(self, rows, mean_length: float):
        rows = rows if isinstance(rows, list) else [rows]
        self.ids = np.concatenate([np.frombuffer(r.ids, "<i8") for r in rows])
        self.no_id = np.concatenate([np.frombuffer(r.no_id, bool) for r in rows])
        names = [np.asarray(r.terms, np.int64) for r in rows]
        self.terms = np.unique(np.concatenate(names)) if len(rows) > 1 else names[0]
        places = [np.searchsorted(self.terms, x) for x in names]
        dfs = [np.asarray(r.dfs, np.int64) for r in rows]
        counts = np.zeros(len(self.terms), np.int64)
        for place, df in zip(places, dfs, strict=True):
            counts[place] += df
        self.list_start = np.concatenate([[0], np.cumsum(counts)])
        size, free, first = len(self.ids), self.list_start[:-1].copy(), 0
        self.docs = np.empty(self.list_start[-1], place_type(size))
        self.weights = np.empty(len(self.docs))
        for r, place, df in zip(rows, places, dfs, strict=True):
            lengths = np.frombuffer(r.lengths, "<i8")
            docs = np.frombuffer(r.docs, place_type(len(lengths)))
            weights = np.frombuffer(zlib.decompress(r.tfs), "<i4").astype(np.float64)
            below = (K1 * (1 - B + B * lengths / mean_length))[docs]
            below += weights
            weights *= K1 + 1
            weights /= below
            del below
            at = ranges(free[place], df) if len(rows) > 1 else slice(None)
            self.docs[at] = docs + self.docs.dtype.type(first)
            self.weights[at] = weights
            free[place] += df
            first += len(lengths)
        # A long list has a part for each of its blocks, with its largest weight; a short one is one part.
        long = np.argsort(-counts, kind="stable")[:min(LONG_LISTS, LONG_SPACE * len(self.docs) // max(1, size))]
        long = np.sort(long[counts[long] * LONG_SHARE >= size])
        self.long = long
        self.row_of = np.full(len(self.terms), -1, np.int32)
        self.row_of[long] = np.arange(len(long))
        # The postings of long lists a second time, by document.
        at = ranges(self.list_start[long], counts[long])
        order = np.argsort(self.docs[at], kind="stable")
        self.by_doc, self.doc_rows = at[order].astype(np.int32), np.repeat(np.arange(len(long), dtype=np.uint16), counts[long])[order]
        self.doc_size = np.bincount(self.docs[at], minlength=size)
        self.doc_start = np.cumsum(self.doc_size) - self.doc_size
        new = [self.list_start[:-1]]
        for a, z in zip(self.list_start[long].tolist(), self.list_start[long + 1].tolist(), strict=True):
            new.append(a + 1 + np.flatnonzero(np.diff(self.docs[a:z] // BLOCK_ROWS)))
        self.part_start = np.sort(np.concatenate(new))
        self.part_end = np.append(self.part_start[1:], len(self.docs))
        self.part_block = (self.docs[self.part_start] // BLOCK_ROWS).astype(np.int64)
        self.part_most = np.maximum.reduceat(self.weights, self.part_start) if len(self.part_start) else np.zeros(0)
        self.first_part = np.searchsorted(self.part_start, self.list_start)
        self.block_start = np.arange(0, size, BLOCK_ROWS)
        self.rarity = np.zeros(len(self.terms))
        self.shares = np.zeros(len(self.docs), np.int32)
        self.doc_shares = np.zeros(len(self.by_doc), np.int32)
        self.levels = np.zeros((len(long), size), np.uint16)
        self.most = np.zeros((len(long), len(self.block_start)))
        self.step, self.all_most = 1.0, np.zeros(len(self.block_start))
        self.asked = np.zeros(len(long), bool)

    def weigh(self, terms: np.ndarray, rarity: np.ndarray) -> None:
        """Set the shares of words, by their place among ``terms``."""
        self.rarity[terms] = rarity
        for k in range(0, len(terms), TERMS):
            some = terms[k:k + TERMS]
            sizes = self.list_start[some + 1] - self.list_start[some]
            at = ranges(self.list_start[some], sizes)
            share = self.weights[at]
            share *= np.repeat(rarity[k:k + TERMS], sizes)
            share *= UNIT
            self.shares[at] = np.rint(share, out=share)
        lists = [slice(a, z) for a, z in zip(self.list_start[self.long].tolist(), self.list_start[self.long + 1].tolist(), strict=True)]
        self.doc_shares = self.shares[self.by_doc]
        every = np.zeros(len(self.ids))
        for postings in lists:
            every[self.docs[postings]] += self.shares[postings]
        self.all_most = np.maximum.reduceat(every, self.block_start) if len(every) else every
        self.step = max(1.0, every.max(initial=0) / (np.iinfo(np.uint16).max - len(lists)))  # no sum of levels passes 16 bits
        for row, postings in enumerate(lists):
            self.levels[row, self.docs[postings]] = np.ceil(self.shares[postings] / self.step)
        parts = self.first_part[self.long + 1] - self.first_part[self.long]
        at = ranges(self.first_part[self.long], parts)
        self.most[np.repeat(np.arange(len(lists)), parts), self.part_block[at]] = np.rint(
            self.part_most[at] * np.repeat(self.rarity[self.long], parts) * UNIT)

    def _sums(self, terms: np.ndarray) -> np.ndarray:
        """Each document's sum over whole lists."""
        starts = self.list_start[terms]
        sizes = self.list_start[terms + 1] - starts
        few = sizes < SLICE
        at = ranges(starts[few], sizes[few])
        docs, shares = [self.docs[at]], [self.shares[at]]
        for start, size in zip(starts[~few].tolist(), sizes[~few].tolist(), strict=True):
            docs.append(self.docs[start:start + size])
            shares.append(self.shares[start:start + size])
        return np.bincount(np.concatenate(docs, dtype=np.intp), weights=np.concatenate(shares, dtype=np.float64), minlength=len(self.ids))

    def _long_sums(self, docs: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """The sums of some documents over long lists, from their own postings."""
        sizes = self.doc_size[docs]
        at = ranges(self.doc_start[docs], sizes)
        self.asked[rows] = True
        found = self.asked[self.doc_rows[at]]
        self.asked[rows] = False
        return np.bincount(np.repeat(np.arange(len(docs)), sizes)[found], weights=self.doc_shares[at[found]], minlength=len(docs))

    def top(self, terms: np.ndarray, rarity: np.ndarray, k: int, least: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
        """The best ``k`` documents (their places) and their scores, for words by their place among ``terms``.

        Documents that score below ``least`` may be left out.
        """
        if (self.rarity[terms] != rarity).any():
            self.weigh(terms, rarity)
        rows = self.row_of[terms]
        short, long, rows = terms[rows < 0], terms[rows >= 0], rows[rows >= 0]
        sums = self._sums(short)
        # Blocks whose maxima do not reach the score are passed over, with what the long lists have there.
        reach = np.maximum.reduceat(sums, self.block_start) + np.minimum(self.most[rows].sum(axis=0), self.all_most)
        alive = np.flatnonzero(reach >= max(least, 1))
        if not len(alive):
            return np.zeros(0, np.int64), np.zeros(0)
        first, last = alive[0] * BLOCK_ROWS, (alive[-1] + 1) * BLOCK_ROWS
        levels = np.zeros(len(sums[first:last]), np.uint16)
        for row in rows.tolist():
            levels += self.levels[row, first:last]
        bound = levels * self.step
        bound += sums[first:last]
        docs = np.flatnonzero(bound >= max(least, 1) - 1)
        if len(docs) > k:
            some = bound[docs]
            if len(some) >= CLASSES >= k:  # the best of some documents each: the k-th of these is reached by k
                some = some[:len(some) // CLASSES * CLASSES].reshape(-1, CLASSES).max(axis=0)
            least = max(least, np.partition(some, len(some) - k)[len(some) - k] - self.step * len(rows) - 1)
            docs = docs[bound[docs] >= least - 1]
        docs += first
        sizes = self.list_start[long + 1] - self.list_start[long]
        if self.doc_size[docs].sum() > sizes.sum():  # many documents: whole lists cost less
            scores = (sums + self._sums(long))[docs]
        else:
            scores = sums[docs] + self._long_sums(docs, rows)
        keep = scores >= max(least, 1)
        docs, scores = docs[keep], scores[keep]
        if len(docs) > k:
            reached = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
            docs, scores = docs[reached], scores[reached]
        best = np.lexsort((self.ids[docs], self.no_id[docs], -scores))[:k]
        return docs[best], scores[best]


class _Best:
    """The best documents so far of the queries in a row of ``asking``."""

    def __init__(self, row, total: int, k: int):
        self.names = np.frombuffer(row.asked, "<i8")
        dfs = np.frombuffer(zlib.decompress(row.known), "<i8").tolist()
        self.rarity = np.array([math.log(1 + (total - n + 0.5) / (n + 0.5)) for n in dfs])
        self.queries, starts = np.frombuffer(row.queries, "<i8"), np.frombuffer(row.starts, "<i8")
        places = np.cumsum(np.frombuffer(zlib.decompress(row.places), "<i4"), dtype=np.int32)
        self.places = np.split(places, starts[1:])
        self.k = k
        self.found = [(np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0))] * len(self.queries)  # ids, whether none, scores

    def place(self, shard: Shard) -> None:
        """Find the words' places in a shard."""
        here = np.searchsorted(shard.terms, self.names)
        here[here == len(shard.terms)] = 0
        self.has = shard.terms[here] == self.names if len(shard.terms) else np.zeros(len(here), bool)
        self.here = here

    def meet(self, shard: Shard) -> None:
        for query, mine in enumerate(self.places):
            mine = mine[self.has[mine]]
            if not len(mine):
                continue
            ids, no_id, scores = self.found[query]
            docs, new = shard.top(self.here[mine], self.rarity[mine], self.k, scores[-1] if len(scores) == self.k else 0.0)
            if len(docs):
                ids, no_id = np.concatenate([ids, shard.ids[docs]]), np.concatenate([no_id, shard.no_id[docs]])
                scores = np.concatenate([scores, new])
                best = np.lexsort((ids, no_id, -scores))[:self.k]
                self.found[query] = ids[best], no_id[best], scores[best]

    def rows(self) -> pd.DataFrame:
        ids, no_id, scores = (np.concatenate(x) for x in zip(*self.found, strict=True))
        return pd.DataFrame({"query_id": np.repeat(self.queries, [len(x) for x, *_ in self.found]),
                             "doc_id": pd.arrays.IntegerArray(ids, no_id), "score": scores.astype(np.int64)})


def top_k(docs: DataFrame, queries: Column, k: int, id_col: str = "doc_id", text_col: str = "text",
          shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank (from 1), doc_id and score: the best ``k`` of all rows for each that ``queries`` holds of.

    A query is the words of a row's whole text, each once; rows of one id are one query. Scores are
    BM25 sums. Ties go to the smaller id, null ids last. A row without a word of the query is never
    found, so a query may have fewer results, or none. A null text counts as empty. The whole index
    is built first; then each task holds some of the queries, at most ``HELD_ROWS``, and shards pass by.
    """
    spark = docs.sparkSession
    prepare(spark)
    own, text = F.col(f"`{id_col}`").cast("long"), F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    index = materialise(build(docs.select(own.alias("doc_id"), text.alias("text")), shard_rows), "index")
    shards, total, length = index.agg(F.count("*"), F.sum("n_docs"), F.sum("n_words")).first()
    total, mean_length = total or 0, (length or 0) / max(1, total or 0) or 1.0

    def asked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            hashes, codes, cuts = words(batch["text"].tolist())
            yield pd.DataFrame({"query_id": np.repeat(batch["doc_id"].to_numpy(np.int64), np.diff(cuts)), "term": hashes[codes]})

    terms = materialise(docs.where(own.isNotNull() & F.coalesce(queries, F.lit(False))).select(own.alias("doc_id"), text.alias("text"))
                        .mapInPandas(asked, "query_id long, term long").distinct(), "queries")
    known = index.select(F.explode(F.arrays_zip("terms", "dfs")).alias("x")).select(F.col("x.terms").alias("of"), F.col("x.dfs").alias("df"))
    df = known.join(terms.select("term").distinct(), F.col("of") == F.col("term"), "left_semi").groupBy("of").agg(F.sum("df").alias("df"))
    # A word that most queries have is divided by the adaptive join.
    weighed = divisible_join(terms, df, [terms.term], [df.of], "inner").select("query_id", "term", "df")
    blocks = max(1, -(-terms.select("query_id").distinct().count() // query_rows))

    def block(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["query_id", "term"])
        names, first = np.unique(rows["term"].to_numpy(), return_index=True)
        queries, starts = np.unique(rows["query_id"].to_numpy(), return_index=True)
        return pd.DataFrame([{
            "block": int(key[0]), "terms": names.astype("<i8").tobytes(), "dfs": zlib.compress(rows["df"].to_numpy()[first].astype("<i8"), 1),
            "queries": queries.astype("<i8").tobytes(), "starts": starts.astype("<i8").tobytes(),
            "places": zlib.compress(np.diff(np.searchsorted(names, rows["term"].to_numpy()), prepend=0).astype("<i4"), 1)}])

    shape = "block long, terms binary, dfs binary, queries binary, starts binary, places binary"
    asking = materialise(weighed.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks))).groupBy("block")
                         .applyInPandas(block, shape), "queries")
    # A tile is the queries that a task holds and the shards that pass by: rows in this order.
    groups = max(1, min(shards, max(TASKS * spark.sparkContext.defaultParallelism, -(-shards // TASK_SHARDS))))
    held = max(1, HELD_ROWS // query_rows)
    first = f"block DIV {held} * {groups}L"
    group = f"pmod(shiftright(shard, 32) + (shard & 4294967295L), {groups}L)"
    meeting = asking.select(F.expr(f"explode(sequence({first}, {first} + {groups - 1}L)) AS tile"), F.lit(-1).cast("long").alias("shard"), F.struct(
        F.col("terms"), F.col("dfs").alias("known"), "queries", "starts", "places").alias("ask"), F.lit(None).alias("index"))
    stored = index.select(F.expr(f"explode(sequence({group}, {group} + {(blocks - 1) // held * groups}L, {groups}L)) AS tile"), "shard",
                          F.lit(None).alias("ask"), F.struct("ids", "no_id", "n_docs", "terms", "dfs", "lengths", "docs", "tfs").alias("index"))
    rows = (stored.unionByName(meeting).repartition("tile").sortWithinPartitions("tile", "shard")
            .select("tile", *[F.col(f"index.{c}").alias(c) for c in ("ids", "no_id", "n_docs", "dfs", "lengths", "docs", "tfs")],
                    F.col("index.terms").alias("terms"), *[F.col(f"ask.{c}").alias(c) for c in ("known", "queries", "starts", "places")],
                    F.col("ask.terms").alias("asked")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tile, asks, waiting = None, [], []

        def meet() -> None:
            """Let the waiting shards, as one, meet the queries."""
            shard = Shard(waiting, mean_length)
            for ask in asks:
                ask.place(shard)
            terms, first = np.unique(np.concatenate([ask.here[ask.has] for ask in asks]), return_index=True)
            shard.weigh(terms, np.concatenate([ask.rarity[ask.has] for ask in asks])[first])
            for ask in asks:
                ask.meet(shard)

        for batch in batches:
            for r in batch.itertuples(index=False):
                if waiting and (r.tile != tile or r.docs is not None and sum(x.n_docs for x in waiting) + r.n_docs > MORE * shard_rows):
                    meet()
                    waiting = []
                if r.tile != tile:
                    yield from (ask.rows() for ask in asks)
                    tile, asks = r.tile, []
                if r.docs is None:
                    asks.append(_Best(r, total, k))
                elif asks:
                    waiting.append(r)
        if waiting:
            meet()
        yield from (ask.rows() for ask in asks)

    # A row holds an index: few rows at a time go to Python.
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    usual, path = spark.conf.get(key), fresh_path(spark, "found")
    spark.conf.set(key, "1")
    try:
        rows.mapInPandas(run, _FOUND).write.parquet(path)
    finally:
        spark.conf.set(key, usual)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (spark.read.schema(_FOUND).parquet(path).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "doc_id", (F.col("score") / UNIT).alias("score")))
