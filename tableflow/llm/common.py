"""What the operators of this package share: inputs, batches and tokens of words."""

from __future__ import annotations

import io
import re
import struct
import uuid
import zipfile
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableflow.session import file_system, shared_folder

BATCH_ROWS = 1_000
CACHE_WORDS = 350_000
CACHE_LETTERS = 64
_SHIPPED: set[str] = set()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of a folder of Parquet tables, read through Spark."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Let executors import this library, and send them texts in batches of at most 1,000 rows.

    The library goes to the shared folder and from there to executors, once for each application,
    so that none needs it installed. Spark also cuts batches by bytes (``maxBytesPerBatch``, 64 MB by
    default), so that only one text alone can make a batch larger.
    """
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        root, data = Path(__file__).resolve().parent.parent, io.BytesIO()
        with zipfile.ZipFile(data, "w") as out:
            for source in sorted(root.rglob("*.py")):
                out.write(source, source.relative_to(root.parent))
        path = f"{shared_folder(spark)}/code-{uuid.uuid4().hex}/{root.name}.zip"
        system, found = file_system(spark, path)
        stream = system.create(found)
        stream.write(data.getvalue())
        stream.close()
        context.addPyFile(path)
        _SHIPPED.add(context.applicationId)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id`` and ``text`` alone, a null text as the empty one; other columns stay behind."""
    prepare(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def ids_column(column: pd.Series) -> pd.Series:
    """Ids for output: whole numbers that may be null."""
    return column.astype("Int64")


# Characters for which lower-casing and NFC work character by character in any Unicode version.
_PLAIN = re.compile("[^\t\n\r\x20-\x7e\xa1-\xac\xae-\xff]")


# The classes of the vocabulary's splitting pattern within Latin-1, lower case.
_PIECES = re.compile("'(?:s|t|re|ve|m|ll|d)|[a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff]+|[0-9\xb2\xb3\xb9\xbc-\xbe]"
                     "|[^\\sa-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff0-9\xb2\xb3\xb9\xbc-\xbe]+")


def byte_letters() -> dict[int, str]:
    """The letter by which byte-level vocabularies write each byte: itself if it prints, else the next beyond 255."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class Recent:
    """Texts and their ids, the last ones asked for: two halves, of which the older one is dropped when the newer is full."""

    def __init__(self, half: int = CACHE_WORDS, letters: int = CACHE_LETTERS):
        self.half, self.letters = half, letters
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def put(self, text: str, ids: bytes) -> bytes:
        if len(text) <= self.letters:
            if len(self.new) >= self.half:
                self.old, self.new = self.new, {}
            self.new[text] = ids
        return ids

    def get(self, text: str) -> bytes | None:
        """The ids of a text that is known; one of the older half moves to the newer."""
        found = self.new.get(text)
        if found is None and (found := self.old.get(text)) is not None:
            self.put(text, found)
        return found


class WordTokens:
    """Ids of whole texts under a vocabulary whose pieces never span white space.

    White space separates words for good, so a word has the same ids alone as in its text:
    the tokenizers library merges each word once, and its ids are kept. Texts with characters
    beyond Latin-1, controls or special tokens go to the library whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.size = self.library.get_vocab_size()
        self.merge = self.library.model.tokenize
        self.letters = byte_letters()
        self.known = Recent()

    def _piece(self, piece: str) -> bytes:
        letters = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)
        tokens = self.merge(letters)
        return self.known.put(piece, struct.pack(f"<{len(tokens)}I", *[t.id for t in tokens]))

    def _learn(self, word: str) -> bytes:
        """Ids of a word without white space; its pieces are known as words of their own."""
        if word.isascii() and word.isalpha():
            return self._piece(word)
        get, pieces = self.known.get, _PIECES.findall(word)
        ids = [get(piece) or self._piece(piece) for piece in pieces]
        return ids[0] if len(pieces) == 1 else self.known.put(word, b"".join(ids))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, as unsigned 32-bit integers."""
        odd = {k for k, text in enumerate(texts) if _PLAIN.search(text) or "<|" in text}
        lists = pc.utf8_split_whitespace(pc.utf8_lower(pa.array(["" if k in odd else t for k, t in enumerate(texts)], pa.large_string())))
        coded = lists.flatten().dictionary_encode()
        get, learn = self.known.get, self._learn
        known = [get(word) or learn(word) for word in coded.dictionary.to_numpy(zero_copy_only=False).tolist()]
        flat, sizes = np.frombuffer(b"".join(known), "<u4"), np.array([len(x) // 4 for x in known], np.int64)
        codes = coded.indices.to_numpy(zero_copy_only=False)
        counts = sizes[codes]
        ends = np.concatenate([[0], np.cumsum(counts)])
        starts = np.cumsum(sizes) - sizes
        ids = flat[np.repeat(starts[codes] - ends[:-1], counts) + np.arange(ends[-1])]
        cuts = ends[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
        return [self._whole(texts[k]) if k in odd else ids[cuts[k]:cuts[k + 1]] for k in range(len(texts))]

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4")


@lru_cache(maxsize=4)
def word_tokens(path: str) -> WordTokens:
    """One encoder for each vocabulary and Python worker."""
    return WordTokens(path)


def frames(batches: Iterator[pd.DataFrame], rows: int) -> Iterator[pd.DataFrame]:
    """Batches joined to at least ``rows`` rows, the last one excepted."""
    held, count = [], 0
    for batch in batches:
        held.append(batch)
        count += len(batch)
        if count >= rows:
            yield pd.concat(held, ignore_index=True)
            held, count = [], 0
    if count:
        yield pd.concat(held, ignore_index=True)
