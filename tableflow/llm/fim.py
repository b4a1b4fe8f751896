"""Documents rearranged to fill in their middle, cut between tokens that memoised chunks count.

A token is a run of ASCII letters or one other character. A rolling hash of the last ``WINDOW``
bytes parts a text into chunks at places its content defines, so that passages which documents
share give the same chunks. A chunk's summary (tokens, characters, whether a letter is at either
end) is kept with the chunk's very bytes: a chunk met again is compared and not counted again.
Summaries add up, less one token wherever letters meet at a border. The sums tell which chunk
holds a cut, and only that chunk is scanned.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import islice
from typing import NamedTuple

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableflow.llm.common import ids_column, texts

WINDOW = 16
CHUNK_BITS = 8  # a border at one place of 256 in the mean
SEGMENT = 1 << 20
MEMO_CHUNKS = 200_000  # of a worker; only how much is counted again depends on it
MEMO_BYTES = 4_096
PLAIN_FROM, SPM_BELOW = 90, 20

# The marks of the three parts.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"

_SHAPE = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
_GEAR = np.random.default_rng(42).integers(0, 1 << 32, 256, np.uint32)
_INNER = bytes(range(0x80, 0xC0))  # bytes of a character after its first
_KINDS = bytes(b"a"[0] if chr(b).isascii() and chr(b).isalpha() else b" "[0] for b in range(256))
_STARTS = re.compile(rb"[A-Za-z]+|[^A-Za-z\x80-\xbf]")


class Summary(NamedTuple):
    """What a chunk adds to its text."""

    tokens: int
    chars: int
    opens: bool  # with a letter
    closes: bool


def summary(chunk: bytes) -> Summary:
    kinds = chunk.translate(_KINDS, _INNER)
    return Summary(len(kinds.split()) + kinds.count(b" "), len(kinds), chunk[:1].isalpha(), chunk[-1:].isalpha())


def borders(data: bytes) -> list[int]:
    """Where chunks end: behind each window whose hash ends in zeros, and at the end of the data."""
    found = []
    for at in range(0, len(data), SEGMENT):
        first = max(0, at - WINDOW + 1)
        gear = _GEAR[np.frombuffer(data, np.uint8, min(at + SEGMENT, len(data)) - first, first)]
        places = len(gear) - WINDOW + 1
        if places <= 0:
            continue
        value = gear[:places].copy()
        for k in range(1, WINDOW):
            value = value * np.uint32(3) + gear[k:k + places]
        found.append(np.flatnonzero((value >> np.uint32(32 - CHUNK_BITS)) == 0) + first + WINDOW)
    ends = np.concatenate(found).tolist() if found else []
    return ends if ends and ends[-1] == len(data) else [*ends, len(data)]


class Chunks:
    """Summaries of the chunks a worker has met, by their hash and verified by their bytes."""

    def __init__(self, most: int = MEMO_CHUNKS):
        self.known: dict[int, tuple[bytes, Summary]] = {}
        self.most = most
        self.reused = 0

    def summary(self, chunk: bytes) -> Summary:
        name = xxhash.xxh3_64_intdigest(chunk)
        held = self.known.get(name)
        if held and held[0] == chunk:
            self.reused += 1
            return held[1]
        found = summary(chunk)
        if len(chunk) <= MEMO_BYTES:
            if len(self.known) >= self.most:
                self.known.clear()
            self.known[name] = chunk, found
        return found


class Tokens:
    """A text whose tokens are counted by chunks, and found by their number."""

    def __init__(self, data: bytes, chunks: Chunks):
        self.data = data
        self.ends = borders(data) if data else []
        self.starts = [0, *self.ends[:-1]]
        parts = [chunks.summary(data[a:z]) for a, z in zip(self.starts, self.ends, strict=False)]
        closes = [False, *[p.closes for p in parts]]
        self.joined = [p.opens and before for p, before in zip(parts, closes, strict=False)]
        # Tokens that begin before each chunk; a chunk's first letters may belong to a token begun before.
        self.before = np.cumsum([0, *[p.tokens - j for p, j in zip(parts, self.joined, strict=True)]])
        self.chars = np.cumsum([0, *[p.chars for p in parts]])

    def __len__(self) -> int:
        return int(self.before[-1])

    def cut(self, token: int) -> tuple[int, int]:
        """The place of a token's first byte, and the characters before it; behind the last token, the end."""
        if token >= len(self):
            return len(self.data), int(self.chars[-1])
        k = int(np.searchsorted(self.before, token, "right")) - 1
        chunk = self.data[self.starts[k]:self.ends[k]]
        local = token - int(self.before[k]) + self.joined[k]
        at = next(islice(_STARTS.finditer(chunk), local, None)).start()
        return self.starts[k] + at, int(self.chars[k]) + len(chunk[:at].translate(None, _INNER))


def draws(doc_id: int | None) -> list[int]:
    """The four numbers that decide on a document, from its id; a missing id is written as nothing."""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[k:k + 8], 16) for k in range(0, 32, 8)]


def rearrange(doc_id: int | None, text: str, chunks: Chunks) -> tuple[int, str, int | None, int | None, str]:
    """Number of tokens, form, characters of prefix and middle (none if plain), and the output."""
    one, other, share, kind = draws(doc_id)
    data = text.encode()
    tokens = Tokens(data, chunks)
    n = len(tokens)
    if not text or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)) or share % 100 >= PLAIN_FROM:
        return n, PLAIN, None, None, text
    first, last = sorted((one % (n + 1), other % (n + 1)))
    (a, a_chars), (z, z_chars) = tokens.cut(first), tokens.cut(last)
    prefix, middle, suffix = data[:a].decode(), data[a:z].decode(), data[z:].decode()
    if kind % 100 < SPM_BELOW:
        return n, SPM, a_chars, z_chars - a_chars, SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle
    return n, PSM, a_chars, z_chars - a_chars, PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle


def restore(output: str, form: str) -> str:
    """The text that was rearranged. No mark occurs in a text that was, so each is found where it was put."""
    if form == PLAIN:
        return output
    second, third = (SUFFIX, MIDDLE) if form == PSM else (PREFIX, MIDDLE)
    at, end = output.index(second), output.index(third)
    one, other, middle = output[len(PREFIX):at], output[at + len(second):end], output[end + len(third):]
    return one + middle + other if form == PSM else other + middle + one


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n (tokens), form, prefix_chars, middle_chars and output of each document, in one pass.

    The cuts and the form depend on the id and the number of tokens alone, so a repeated task gives
    the same. One row for each input row, repeated ids too. A null text counts as empty; an empty
    text is plain, with 0 tokens. A null id stays null and is drawn as an empty one. A text of any
    length is cut into chunks piece by piece and rearranged whole. An empty table gives no rows;
    other columns stay behind, whatever their names.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        chunks = Chunks()
        for batch in batches:
            ids = ids_column(batch["doc_id"])
            found = [rearrange(None if pd.isna(i) else int(i), t, chunks) for i, t in zip(ids, batch["text"], strict=True)]
            out = pd.DataFrame(found, columns=["n", "form", "prefix_chars", "middle_chars", "output"])
            yield out.astype({"prefix_chars": "Int64", "middle_chars": "Int64"}).assign(doc_id=ids.to_numpy())[
                ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]]

    return texts(docs, id_col, text_col).mapInPandas(run, _SHAPE)


def restored(rearranged: DataFrame) -> DataFrame:
    """``rearranged`` with the column ``restored``, the text that each ``output`` and ``form`` give back."""
    @F.pandas_udf("string")
    def back(output: pd.Series, form: pd.Series) -> pd.Series:
        return pd.Series([restore(o, f) for o, f in zip(output, form, strict=True)], dtype="object")

    return rearranged.withColumn("restored", back("output", "form"))
