"""Phrases whose words go together, scored from count streams in prefix and in suffix order.

Counting: a task sorts the phrases of its texts, counts them, and Spark adds up its counts. A phrase
is as frequent as ``least`` only if all pairs of words within it are. So pairs are counted first, by
64-bit names, and phrases only where a filter of fixed size lets each of their pairs pass. What the
filter lets pass by mistake is counted too, by its very words, and falls below ``least``.

Estimation: the frequent phrases are one stream in the order of their words from the first on, where
each follows all its beginnings, and one in the order from the last word on, where each follows all
its endings. A scan of sorted partitions keeps the open beginnings (or endings) on a stack, which
gives the counts of left (or right) parts and tells each phrase its most frequent extension. The
two streams are sorted by phrase and merged.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tableflow.llm.common import prepare
from tableflow.session import materialise

LEAST = 100
LONGEST = 5
TOP = 2_000
UNKNOWN = "und"
FILTER_BITS = 27  # the filter has 2 ** 27 bits, 16 MB, at any size of the input
FILTER_HASHES = 3
FILTER_BLOCK = 1 << 19
FLUSH = 2_000_000  # phrases a task holds before it gives their counts
SALTS = 64

_COUNTS = "lang string, phrase string, k int, n long"
_WORD, _SPACE, _END = 0, 1, 2
# The bytes that end a piece and those between words; A-Z alone change their case.
_KINDS = np.zeros(256, np.uint8)
_KINDS[[0x20, 0x09]] = _SPACE
_KINDS[[ord(c) for c in ".,;:!?\x0a\x0b\x0c\x0d"]] = _END
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)


class Words(NamedTuple):
    """The words of a batch of texts, in order."""

    codes: np.ndarray  # which of the distinct words
    keys: list[tuple[str, bytes]]  # the distinct words, each with its language
    going: np.ndarray  # the word goes on to the next one within its piece


def parsed(batch: pa.RecordBatch) -> Words | None:
    """The words of the columns lang and text."""
    line = pa.scalar("\n", pa.large_string())
    texts = pc.binary_join_element_wise(batch["text"].cast(pa.large_string()), line, pa.scalar("", pa.large_string()))
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = _LOWER[np.frombuffer(texts.buffers()[2], np.uint8)[ends[0]:ends[-1]]]
    kinds = _KINDS[data]
    word = kinds == _WORD
    edges = np.flatnonzero(np.diff(word, prepend=False))  # each text ends with a line end, so edges come in pairs
    starts, stops = edges[::2], edges[1::2]
    if not len(starts):
        return None
    offsets = np.concatenate([[0], np.cumsum(stops - starts)]).astype(np.int64)
    array = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[word])])
    coded, langs = array.dictionary_encode(), batch["lang"].dictionary_encode()
    lang = langs.indices.to_numpy(zero_copy_only=False)[np.searchsorted(ends[1:] - ends[0], starts, "right")].astype(np.int64)
    # The same word of two languages is two words.
    count = len(coded.dictionary)
    both = lang * count + coded.indices.to_numpy(zero_copy_only=False)
    used = np.zeros(count * len(langs.dictionary), bool)
    used[both] = True
    number = np.cumsum(used) - 1
    names, words = langs.dictionary.to_pylist(), coded.dictionary.to_pylist()
    keys = [(names[x // count], words[x % count]) for x in np.flatnonzero(used).tolist()]
    piece = np.cumsum(kinds == _END)[starts]
    return Words(number[both].astype(np.int32), keys, piece[1:] == piece[:-1])


def pair_names(words: Words) -> np.ndarray:
    """A 64-bit name of each word with the next one, whether in its piece or not."""
    seeds = {lang: xxhash.xxh32_intdigest(lang) for lang in {lang for lang, _ in words.keys}}
    each = np.array([xxhash.xxh64_intdigest(word, seeds[lang]) for lang, word in words.keys], np.uint64)[words.codes]
    mixed = each[:-1] * np.uint64(0xD6E8FEB86659FD93) + each[1:]
    return (mixed ^ mixed >> np.uint64(32)) * np.uint64(0xFF51AFD7ED558CCD)


def slots(names: np.ndarray, bits: int = FILTER_BITS) -> list[np.ndarray]:
    """The places of 64-bit names in the filter."""
    return [(names * np.uint64(odd) >> np.uint64(64 - bits)).astype(np.int64)
            for odd in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)[:FILTER_HASHES]]


def _run_lengths(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each run of equal values (or rows) begins, and how long it is."""
    apart = ordered[1:] != ordered[:-1]
    first = np.flatnonzero(np.concatenate([[True], apart if ordered.ndim == 1 else apart.any(axis=1)]))
    return first, np.diff(np.append(first, len(ordered)))


class _Counter:
    """Counts of a task's phrases, given as rows when many are held."""

    def __init__(self, longest: int, passed: np.ndarray):
        self.longest, self.passed = longest, passed
        self.codes: dict[tuple[str, bytes], int] = {}
        self.held: list[list[np.ndarray]] = [[] for _ in range(longest)]
        self.size = 0

    def add(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        words = parsed(batch)
        if words is None:
            return
        get = self.codes.setdefault
        codes = np.array([get(key, len(self.codes)) for key in words.keys], np.int32)[words.codes]
        going = words.going.copy()
        names = pair_names(words)
        for place in slots(names):
            going &= (self.passed[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)
        whole = np.ones(len(codes), bool)
        for k in range(1, self.longest + 1):
            whole = whole if k == 1 else whole[:-1] & going[k - 2:]
            grams = codes[np.flatnonzero(whole)[:, None] + np.arange(k, dtype=np.int32)]
            self.held[k - 1].append(grams)
            self.size += len(grams)
        if self.size >= FLUSH:
            yield from self.rows()

    def rows(self) -> Iterator[pa.RecordBatch]:
        langs = pa.array([x[0] for x in self.codes], pa.string())
        words = pa.array([x[1] for x in self.codes], pa.large_binary())
        space = pa.scalar(b" ", pa.large_binary())
        for k, parts in enumerate(self.held, 1):
            if not sum(map(len, parts)):
                continue
            grams = np.concatenate(parts)
            grams = grams[np.lexsort(grams.T[::-1])]
            first, counts = _run_lengths(grams)
            grams = grams[first]
            for at in range(0, len(grams), 100_000):
                part = grams[at:at + 100_000]
                each = [words.take(pa.array(part[:, j])) for j in range(k)]
                joined = each[0] if k == 1 else pc.binary_join_element_wise(*each, space)
                yield pa.RecordBatch.from_arrays(
                    [langs.take(pa.array(part[:, 0])), joined.cast(pa.large_string()).cast(pa.string()),
                     pa.array(np.full(len(part), k, np.int32)), pa.array(counts[at:at + 100_000])], ["lang", "phrase", "k", "n"])
        self.codes, self.held, self.size = {}, [[] for _ in range(self.longest)], 0


def _pair_filter(docs: DataFrame, least: int) -> np.ndarray:
    """A bit field of fixed size with the places of all frequent pairs set; its blocks alone reach the driver.

    Pairs are counted by names. Two of one name add up, so no frequent pair falls below ``least``.
    """
    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def rows() -> pa.RecordBatch:
            ordered = np.sort(np.concatenate([np.zeros(0, np.uint64), *held]))
            first, counts = _run_lengths(ordered) if len(ordered) else (np.zeros(0, np.int64),) * 2
            return pa.RecordBatch.from_arrays([pa.array(ordered[first].view(np.int64)), pa.array(counts)], ["name", "n"])

        for batch in batches:
            words = parsed(batch)
            if words is not None:
                held.append(pair_names(words)[words.going])
                size += len(held[-1])
            if size >= FLUSH:
                yield rows()
                held, size = [], 0
        yield rows()

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.concatenate(slots(batch["name"].to_numpy(zero_copy_only=False).view(np.uint64)))
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(found))], ["place"])

    def block(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(FILTER_BLOCK, np.uint8)
        bits[rows["place"].to_numpy() % FILTER_BLOCK] = 1
        return pd.DataFrame({"block": [key[0]], "bits": [np.packbits(bits, bitorder="little").tobytes()]})

    pairs = docs.mapInArrow(names, "name long, n long").groupBy("name").agg(F.sum("n").alias("f")).where(F.col("f") >= least).select("name")
    found = pairs.mapInArrow(places, "place long").distinct().withColumn("block", F.expr(f"CAST(place DIV {FILTER_BLOCK} AS INT)"))
    out = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
    size = FILTER_BLOCK // 8
    for row in materialise(found.groupBy("block").applyInPandas(block, "block int, bits binary"), "filter").toLocalIterator():
        out[row.block * size:(row.block + 1) * size] = np.frombuffer(row.bits, np.uint8)
    return out


def frequent(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """Phrases of 1 to ``longest`` words with their count f >= ``least`` by lang, and the words (n) of each lang."""
    sent = docs.sparkSession.sparkContext.broadcast(_pair_filter(docs, least))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _Counter(longest, sent.value)
        for batch in batches:
            yield from counter.add(batch)
        yield from counter.rows()

    counts = docs.mapInArrow(run, _COUNTS).groupBy("lang", "phrase", "k").agg(F.sum("n").alias("f"))
    counts = materialise(counts.where((F.col("k") == 1) | (F.col("f") >= least)), "phrases")
    return counts.where(F.col("f") >= least), counts.where("k = 1").groupBy("lang").agg(F.sum("f").alias("n"))


def _stream(found: DataFrame, forward: bool) -> DataFrame:
    """Each phrase with the counts of its beginnings (or endings) by length, and of its most frequent extension.

    Phrases of one first (or last) word are sorted in one partition; the scan holds one path of them.
    """
    part, longer = ("lefts", "right_ext") if forward else ("rights", "left_ext")
    columns = ["lang", "phrase", "f", part, longer]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        path: list[tuple[str, list[str]]] = []
        done: list[list] = []  # rows of the path
        for batch in batches:
            out = []
            for lang, words, phrase, f in zip(batch["lang"], batch["words"], batch["phrase"], batch["f"], strict=True):
                words = list(words)
                while path and (path[-1][0] != lang or path[-1][1] != words[:len(path[-1][1])]):
                    path.pop()
                    out.append(done.pop())
                if done:
                    done[-1][4] = max(done[-1][4], f)
                done.append([lang, phrase, f, [row[2] for row in done], 0])
                path.append((lang, words))
            yield pd.DataFrame(out, columns=columns)
        yield pd.DataFrame(done, columns=columns)

    words = F.split("phrase", " ")
    ordered = found.select("lang", (words if forward else F.reverse(words)).alias("words"), "phrase", "f")
    return (ordered.repartitionByRange("lang", F.col("words")[0]).sortWithinPartitions("lang", "words")
            .mapInPandas(run, f"lang string, phrase string, f long, {part} array<long>, {longer} long"))


def estimated(found: DataFrame, words: DataFrame) -> DataFrame:
    """Each phrase of two words or more: a, its lowest-scoring cut (l, r), n, score, and ``longer``, its most frequent extension."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                lefts, rights = (list(map(int, x)) for x in (row.lefts, row.rights))
                a, n = int(row.f), int(row.n)  # Python's whole numbers have no bound, so products stay exact
                score, _, left, right = min((1000 * a * n // (left * right), k, left, right)
                                            for k, (left, right) in enumerate(zip(lefts, reversed(rights), strict=True)))
                out.append((row.lang, row.phrase, a, left, right, n, score, max(row.left_ext, row.right_ext)))
            yield pd.DataFrame(out, columns=["lang", "phrase", "a", "l", "r", "n", "score", "longer"])

    right = _stream(found, False).select(F.col("lang").alias("lang2"), F.col("phrase").alias("phrase2"), "rights", "left_ext")
    left = _stream(found, True).where(F.size("lefts") > 0)
    both = left.join(right.hint("merge"), (F.col("lang") == F.col("lang2")) & (F.col("phrase") == F.col("phrase2")))
    return (both.join(words.select(F.col("lang").alias("of"), "n"), F.col("lang") == F.col("of"))
            .select("lang", "phrase", "f", "lefts", "rights", "left_ext", "right_ext", "n")
            .mapInPandas(run, "lang string, phrase string, a long, l long, r long, n long, score long, longer long"))


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, longest: int = LONGEST,
                 covered: int = 100, top: int = TOP) -> DataFrame:
    """The first ``top`` phrases of each language: lang, rank, phrase, a, l, r, n and score.

    Order: score and a descending, phrase ascending in byte order, so ties are settled. A phrase goes
    if an extension by words on either side has ``covered`` percent of its count or more. Null languages
    are ``und``; a null or empty text has no words; repeated rows count each time; a text of any length
    is counted whole. Without frequent phrases, or rows, the result is empty. Other columns stay behind.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text_col).alias("text")).where("text is not null")
    scored = materialise(estimated(*frequent(rows, least, longest)), "phrases").where(F.col("longer") * 100 < F.col("a") * covered)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # A language may hold most phrases: each of its parts keeps its own first ones before they meet.
    parts = Window.partitionBy("lang", "part").orderBy(*order)
    best = (scored.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
            .withColumn("rank", F.row_number().over(parts)).where(F.col("rank") <= top))
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
