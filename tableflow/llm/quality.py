"""A quality classifier: a byte-level convolutional network in numpy.

A text's UTF-8 bytes are cut into overlapping chunks that cover all of it. Learned filters slide
over each chunk and keep their largest response in it; the responses of all chunks, largest and
mean, are combined into one probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableflow.llm.common import prepare, texts

CHUNK = 512
STEP = 448  # chunks overlap by the rest
WINDOW = 8
STRIDE = 4
WIDTH = 8  # numbers that stand for a byte
FILTERS = 32
#: The model learns from at most so many documents of each class, and of each from so many chunks.
TRAIN_ROWS = 1_500
TRAIN_CHUNKS = 8
STEPS = 750  # of 32 documents each
THRESHOLD = 0.3
_BLOCK = 512  # chunks that pass through the filters at a time
_PLACES = (CHUNK - WINDOW) // STRIDE + 1


def chunks(text: bytes) -> np.ndarray:
    """Rows of ``CHUNK`` bytes that cover the text; the last is filled with zeros."""
    count = max(1, -(-(len(text) - (CHUNK - STEP)) // STEP))
    data = np.zeros((count - 1) * STEP + CHUNK, np.uint8)
    data[:len(text)] = np.frombuffer(text, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(data, CHUNK)[::STEP]


@dataclass
class Net:
    """The parameters; ``head`` weighs the largest and the mean responses, its last number stands alone."""

    table: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    head: np.ndarray

    @staticmethod
    def fresh(seed: int = 0) -> Net:
        rng = np.random.default_rng(seed)
        normal = lambda scale, *shape: (rng.standard_normal(shape) * scale).astype(np.float32)
        return Net(normal(0.5, 256, WIDTH), normal(0.2, WINDOW * WIDTH, FILTERS), np.zeros(FILTERS, np.float32),
                   np.append(normal(0.1, 2 * FILTERS), np.float32(0)).astype(np.float32))

    def windows(self, rows: np.ndarray) -> np.ndarray:
        """The numbers of each window, chunks x places x (bytes x width)."""
        numbers = self.table[rows].reshape(len(rows), CHUNK * WIDTH)
        return np.lib.stride_tricks.sliding_window_view(numbers, WINDOW * WIDTH, axis=1)[:, ::STRIDE * WIDTH]

    def pooled(self, rows: np.ndarray) -> np.ndarray:
        """The largest response of each filter in each chunk."""
        out = np.empty((len(rows), FILTERS), np.float32)
        for at in range(0, len(rows), _BLOCK):
            seen = np.ascontiguousarray(self.windows(rows[at:at + _BLOCK])).reshape(-1, WINDOW * WIDTH)
            out[at:at + _BLOCK] = (seen @ self.filters).reshape(-1, _PLACES, FILTERS).max(axis=1)
        return np.maximum(out + self.bias, 0)

    def combined(self, pooled: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The probability of each document from the responses of its chunks."""
        sizes = np.diff(np.append(starts, len(pooled)))[:, None]
        most = np.maximum.reduceat(pooled, starts)
        mean = np.add.reduceat(pooled, starts) / sizes
        logit = most @ self.head[:FILTERS] + mean @ self.head[FILTERS:-1] + self.head[-1]
        return 1 / (1 + np.exp(-np.clip(logit.astype(np.float64), -500, 500)))

    def score(self, found: list[str]) -> np.ndarray:
        out = np.empty(len(found))
        at = 0
        while at < len(found):  # documents that fill a block together, so that a long one counts alone
            held, end = [], at
            while end < len(found) and sum(map(len, held)) < _BLOCK:
                held.append(chunks(found[end].encode()))
                end += 1
            pooled = np.concatenate([self.pooled(x) for x in held]) if len(held) == 1 else self.pooled(np.concatenate(held))
            sizes = np.array([len(x) for x in held])
            out[at:end] = self.combined(pooled, np.cumsum(sizes) - sizes)
            at = end
        return out


def fit(examples: list[np.ndarray], labels: np.ndarray, steps: int = STEPS, seed: int = 0) -> Net:
    """Learn from documents (rows of chunks) by gradient descent with momentum estimates.

    Both classes weigh the same. Every other time, a document is cut to a short part of one of
    its chunks, so that short texts are learned too.
    """
    net, rng = Net.fresh(seed), np.random.default_rng(seed + 1)
    params = [net.table, net.filters, net.bias, net.head]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    share = np.array([np.mean(labels == 0), np.mean(labels == 1)])
    weight = 0.5 / share[labels]
    order = np.zeros(0, np.int64)
    for step in range(1, steps + 1):
        rate = 0.005 * (1 + np.cos(np.pi * step / steps))
        if len(order) < 32:
            order = np.concatenate([order, rng.permutation(len(examples))])
        batch, order = order[:32], order[32:]
        held = [_short(examples[k], rng) if rng.random() < 0.5 else examples[k] for k in batch]
        rows = np.concatenate(held)
        sizes = np.array([len(x) for x in held])
        starts = np.cumsum(sizes) - sizes
        doc = np.repeat(np.arange(len(batch)), sizes)
        seen = np.ascontiguousarray(net.windows(rows))
        response = seen @ net.filters
        place = response.argmax(axis=1)
        pooled = np.maximum(np.take_along_axis(response, place[:, None], 1)[:, 0] + net.bias, 0)
        most = np.maximum.reduceat(pooled, starts)
        error = (net.combined(pooled, starts) - labels[batch]) * weight[batch] / len(batch)
        error = error.astype(np.float32)
        mean = np.add.reduceat(pooled, starts) / sizes[:, None]
        d_head = np.concatenate([error @ most, error @ mean, [error.sum()]])
        is_most = pooled == most[doc]
        ties = np.add.reduceat(is_most.astype(np.float32), starts)[doc]
        d_pool = (error[doc, None] * net.head[:FILTERS] * is_most / ties
                  + error[doc, None] * net.head[FILTERS:-1] / sizes[doc, None]) * (pooled > 0)
        picked = seen[np.arange(len(rows))[:, None], place]  # chunks x filters x window
        d_filters = np.einsum("cfk,cf->kf", picked, d_pool)
        d_seen = (d_pool[:, :, None] * net.filters.T[None]).reshape(-1, WIDTH)
        letters = rows[np.arange(len(rows))[:, None, None], place[:, :, None] * STRIDE + np.arange(WINDOW)].reshape(-1)
        d_table = np.stack([np.bincount(letters, weights=d_seen[:, k], minlength=256) for k in range(WIDTH)], axis=1)
        for k, grad in enumerate((d_table, d_filters, d_pool.sum(axis=0), d_head)):
            first[k] = 0.9 * first[k] + 0.1 * grad.astype(np.float32)
            second[k] = 0.999 * second[k] + 0.001 * (grad * grad).astype(np.float32)
            params[k] -= (rate * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return net


def _short(rows: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """A part of one chunk, from the start of a word if it has one."""
    text = bytes(rows[rng.integers(len(rows))]).rstrip(b"\0")
    at = text.find(b" ", int(rng.integers(max(1, len(text) - 20)))) + 1
    return chunks(text[at:at + int(rng.integers(20, 300))])


def labelled(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, id_col: str = "doc_id",
             text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """Chunks of at most ``rows`` documents of each class for learning, none of them held out.

    Which ones is settled by a hash of the id, and of rows that share an id, by a hash of the chunks:
    one row of each id. Rows without a label of 0 or 1 do not count.
    """
    marked = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    marked = marked.where(F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
    picked = [marked.where(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows) for k in (0, 1)]
    few = picked[0].unionByName(picked[1]).dropDuplicates(["doc_id"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for text in batch["text"]:
                rows = chunks(text.encode())
                found.append(rows[np.linspace(0, len(rows) - 1, min(len(rows), TRAIN_CHUNKS)).astype(int)].tobytes())
            yield pd.DataFrame({"doc_id": batch["doc_id"], "label": batch["label"], "chunks": found})

    known = texts(docs, id_col, text_col)
    rows_found = known.join(F.broadcast(few), "doc_id").mapInPandas(run, "doc_id long, label int, chunks binary")
    return rows_found.groupBy("doc_id", "label").agg(F.min(F.struct(F.xxhash64("chunks").alias("hash"), "chunks"))["chunks"].alias("chunks"))


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning."""
    return F.crc32(doc_id.cast("string")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, **columns: str) -> Net | float:
    """The fitted network; with labels of one class or none, their share of ones (or 0.5) instead."""
    prepare(docs.sparkSession)
    found = labelled(docs, labels, rows, **columns).toPandas().sort_values(["doc_id", "label", "chunks"])
    marks = found["label"].to_numpy(np.int64)
    if len(set(marks.tolist())) < 2:
        return float(marks.mean()) if len(marks) else 0.5
    return fit([np.frombuffer(x, np.uint8).reshape(-1, CHUNK) for x in found["chunks"]], marks)


def score_column(net: Net | float, text: Column) -> Column:
    """The score of each text; a null text counts as empty, which is one chunk of zeros."""
    @F.pandas_udf("double")
    def run(found: pd.Series) -> pd.Series:
        return pd.Series(net.score(found.tolist()) if isinstance(net, Net) else np.full(len(found), net))

    return run(F.coalesce(text, F.lit("")))


def score(docs: DataFrame, net: Net | float, threshold: float = THRESHOLD, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted for each row. A null id is not held out."""
    return texts(docs, id_col, text_col).select("doc_id", score_column(net, F.col("text")).alias("score")).select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))


def accepted(docs: DataFrame, net: Net | float, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text scores ``threshold`` or more, with all their columns."""
    prepare(docs.sparkSession)
    return docs.where(score_column(net, F.col(f"`{text_col}`")) >= threshold)
