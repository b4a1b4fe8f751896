"""Byte-level BPE as a streaming transducer with bounded lookahead.

How far can text to the right change a token? Two adjacent parts x and y merge only if y came
about whole; a merge of earlier rank that starts with a piece ending y (one on the right spine of
y's merge tree) can prevent that, and that one in turn depends on what follows *its* right part.
Ranks fall strictly along such a chain, so one pass over the merge list in its order gives, for
each token, the most bytes beyond its end that any chain can reach: its sufficient lookahead. A
token with as many bytes behind it in the buffer is final. The encoder emits it and forgets its
bytes, so that memory is bounded however long a word is; the decoder holds three bytes at most.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import re
import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from tableflow.llm.common import CACHE_WORDS, byte_letters, ids_column, texts

CHUNK = 1 << 16
LONG = 64
_TOKEN = (1 << 24) - 1
_NONE = 1 << 62

# The public splitting pattern of byte-level vocabularies.
SPLIT = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
# How a piece of each kind goes on.
_RUNS = tuple(map(regex.compile, (r"\p{L}+", r"\p{N}+", r"[^\s\p{L}\p{N}]+", r"\s+")))
_BOUNDARY = re.compile(r"(?s).* (?=\S)")
_IRREGULAR = re.compile(r"[^\S \n]|  | \n|\n |\x01|[\x1c-\x1f]")


class MergeList:
    """The merges of a byte-level vocabulary, their lookahead, and the special strings beside them."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        if stored["normalizer"] or stored["model"]["type"] != "BPE" or stored["pre_tokenizer"]["type"] != "ByteLevel":
            raise ValueError("not a byte-level BPE vocabulary")
        vocab, letters = stored["model"]["vocab"], byte_letters()
        self.byte_ids = [vocab[letters[b]] for b in range(256)]
        self.special = {t["content"]: t["id"] for t in stored["added_tokens"]}
        byte_of = {letter: byte for byte, letter in letters.items()}
        named = vocab | self.special
        self.bytes_of = [b""] * (max(named.values()) + 1)
        for token, number in named.items():
            self.bytes_of[number] = b"".join(
                bytes([byte_of[c]]) if c in byte_of else c.encode() for c in token)
        self.merges: dict[tuple[int, int], int] = {}  # rank, then the new token in the low bits
        self.spine: dict[int, tuple[int, ...]] = {i: (i,) for i in self.byte_ids}
        reach = dict.fromkeys(self.byte_ids, 0)  # by left part: most bytes that chains of the merges so far reach
        for rank, (left, right) in enumerate(stored["model"]["merges"]):
            a, b, new = vocab[left], vocab[right], vocab[left + right]
            if a not in self.spine or b not in self.spine or new in self.spine:
                raise ValueError("a merge uses a later one, or two make the same token")
            self.merges[a, b] = rank << _TOKEN.bit_length() | new
            self.spine[new] = (new, *self.spine[b])
            here = len(self.bytes_of[b]) + max(reach[x] for x in self.spine[b])
            reach[a] = max(reach[a], here)
            reach.setdefault(new, 0)
        self.lookahead = {token: max(reach[x] for x in spine) for token, spine in self.spine.items()}
        self.window = max(self.lookahead.values())

    def merge(self, data: bytes) -> list[int]:
        """Tokens of a whole word: the lowest rank first, from the left."""
        ids = [self.byte_ids[b] for b in data]
        if len(ids) > LONG:
            return self._merge_long(ids)
        get = self.merges.get
        pairs = [get(pair, _NONE) for pair in zip(ids, ids[1:], strict=False)]
        while pairs and (best := min(pairs)) != _NONE:
            k, new = pairs.index(best), best & _TOKEN
            ids[k:k + 2] = [new]
            del pairs[k]
            if k:
                pairs[k - 1] = get((ids[k - 1], new), _NONE)
            if k < len(pairs):
                pairs[k] = get((new, ids[k + 1]), _NONE)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same over a linked list with a queue."""
        size, get = len(ids), self.merges.get
        after, before, alive = list(range(1, size + 1)), list(range(-1, size - 1)), [True] * size
        queue = [(found, k, ids[k], ids[k + 1]) for k in range(size - 1) if (found := get((ids[k], ids[k + 1]))) is not None]
        heapq.heapify(queue)
        while queue:
            found, k, left, right = heapq.heappop(queue)
            n, new = after[k], found & _TOKEN
            if not alive[k] or n >= size or ids[k] != left or ids[n] != right:
                continue
            ids[k], alive[n], after[k] = new, False, after[n]
            if after[n] < size:
                before[after[n]] = k
            for x, y in ((before[k], k), (k, after[k])):
                if x >= 0 and y < size and (found := get((ids[x], ids[y]))) is not None:
                    heapq.heappush(queue, (found, x, ids[x], ids[y]))
        return [i for i, keep in zip(ids, alive, strict=True) if keep]


class WordStream:
    """Tokens of one word whose bytes arrive in parts; holds about two windows of bytes."""

    def __init__(self, merges: MergeList):
        self.merges, self.held = merges, b""

    def feed(self, data: bytes) -> list[int]:
        out, size = [], 2 * self.merges.window + LONG
        for at in range(0, len(data), size):
            self.held += data[at:at + size]
            if len(self.held) >= size:
                out += self._stable()
        return out

    def _stable(self) -> list[int]:
        ids, at = self.merges.merge(self.held), 0
        for k, token in enumerate(ids):
            end = at + len(self.merges.bytes_of[token])
            if len(self.held) - end < self.merges.lookahead[token]:
                self.held = self.held[at:]
                return ids[:k]
            at = end
        self.held = b""
        return ids

    def close(self) -> list[int]:
        ids, self.held = self.merges.merge(self.held), b""
        return ids


class Encoder:
    """Tokens of a text that arrives in parts, the same as of the whole; memory stays constant."""

    def __init__(self, merges: MergeList):
        self.merges, self.words, self.rest = merges, WordStream(merges), ""
        self.run = None  # the kind of the word that is still open, if its start has gone to the stream

    def _word(self, text: str) -> list[int]:
        return self.words.feed(text.encode()) + self.words.close()

    def feed(self, text: str) -> list[int]:
        out, self.rest = [], self.rest + text
        if self.run is not None:
            found = self.run.match(self.rest)
            end = found.end() if found else 0
            if end == len(self.rest):  # goes on; the last character may be white space that joins the next word
                keep = 1 if self.run is _RUNS[3] else 0
                out += self.words.feed(self.rest[:end - keep].encode())
                self.rest = self.rest[end - keep:]
                return out
            if self.run is _RUNS[3]:
                end = max(0, end - 1)
            out += self.words.feed(self.rest[:end].encode()) + self.words.close()
            self.run, self.rest = None, self.rest[end:]
        cut = found.end() - 1 if (found := _BOUNDARY.match(self.rest)) else 0
        if cut > 0:
            for word in SPLIT.findall(self.rest[:cut]):
                out += self._word(word)
            self.rest = self.rest[cut:]
        if len(self.rest) > CHUNK:
            words = SPLIT.findall(self.rest)
            for word in words[:-2]:
                out += self._word(word)
            last = words[-2:]
            if len(last) == 2 and len(last[0]) > 1:
                out += self._word(last.pop(0))
            if len(last) == 1 and len(last[0]) > LONG:
                word = last.pop()
                self.run = next(run for run in _RUNS if run.fullmatch(word[1:]))
                keep = 1 if self.run is _RUNS[3] else 0
                out += self.words.feed(word[:len(word) - keep].encode())
                last = [word[len(word) - keep:]]
            self.rest = "".join(last)
        return out

    def close(self) -> list[int]:
        out = []
        if self.run is not None:
            out += self.words.feed(self.rest.encode()) + self.words.close()
        else:
            for word in SPLIT.findall(self.rest):
                out += self._word(word)
        self.run, self.rest = None, ""
        return out


class Decoder:
    """Text of tokens that arrive in parts; bytes that are no UTF-8 become the replacement character."""

    def __init__(self, merges: MergeList):
        self.bytes_of = merges.bytes_of
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        return self.state.decode(b"".join(map(self.bytes_of.__getitem__, ids)))

    def close(self) -> str:
        return self.state.decode(b"", final=True)


class TextTokens:
    """Ids of whole texts: each word that a space sets off goes through the transducer once and is kept."""

    def __init__(self, path: str):
        self.merges = MergeList(path)
        self.stream = WordStream(self.merges)
        self.known: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        names = map(re.escape, sorted(self.merges.special, key=len, reverse=True))
        self.special = re.compile(f"({'|'.join(names)})") if self.merges.special else None

    def _stream(self, text: str) -> list[int]:
        encoder, out = Encoder(self.merges), []
        for at in range(0, len(text), CHUNK):
            out += encoder.feed(text[at:at + CHUNK])
        return out + encoder.close()

    def _whole(self, text: str) -> np.ndarray:
        out = []
        for part in self.special.split(text) if self.special else [text]:
            out += [self.merges.special[part]] if part in self.merges.special else self._stream(part)
        return np.array(out, "<u4")

    def _piece(self, piece: str) -> bytes:
        ids = self.stream.feed(piece.encode()) + self.stream.close()
        found = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= LONG:
            if len(self.pieces) >= CACHE_WORDS:
                self.pieces.clear()
            self.pieces[piece] = found
        return found

    def _learn(self, part: str) -> bytes:
        """Ids of a part between single spaces, with its space; a first part is marked and has none."""
        word = part[1:] if part.startswith("\x01") else " " + part
        found = b"".join([self.pieces.get(piece) or self._piece(piece) for piece in SPLIT.findall(word)])
        if len(part) <= LONG:
            if len(self.known) >= CACHE_WORDS:
                self.known.clear()
            self.known[part] = found
        return found

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, as unsigned 32-bit integers."""
        odd = {k for k, t in enumerate(texts) if _IRREGULAR.search(t) or (self.special and self.special.search(t))}
        lists = pc.split_pattern(pa.array(["\x01" if k in odd else "\x01" + t for k, t in enumerate(texts)], pa.large_string()), " ")
        coded = lists.flatten().dictionary_encode()
        get, learn = self.known.get, self._learn
        known = [get(part) or learn(part) for part in coded.dictionary.to_pylist()]
        flat, sizes = np.frombuffer(b"".join(known), "<u4"), np.array([len(x) // 4 for x in known], np.int64)
        codes = coded.indices.to_numpy(zero_copy_only=False)
        counts = sizes[codes]
        ends = np.concatenate([[0], np.cumsum(counts)])
        starts = np.cumsum(sizes) - sizes
        ids = flat[np.repeat(starts[codes] - ends[:-1], counts) + np.arange(ends[-1])]
        cuts = ends[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
        return [self._whole(t) if k in odd else ids[cuts[k]:cuts[k + 1]] for k, t in enumerate(texts)]

    def decode(self, ids: np.ndarray) -> Iterator[str]:
        """The text, in parts."""
        decoder = Decoder(self.merges)
        for at in range(0, len(ids), CHUNK):
            yield decoder.feed(ids[at:at + CHUNK].tolist())
        yield decoder.close()


@lru_cache(maxsize=4)
def text_tokens(path: str) -> TextTokens:
    """One encoder for each vocabulary and Python worker."""
    return TextTokens(path)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids (array) of each text; a null text counts as empty and has no ids."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"doc_id": ids_column(batch["doc_id"]), "ids": text_tokens(path).encode(batch["text"].tolist())})

    return texts(docs, id_col, text_col).mapInPandas(run, "doc_id long, ids array<long>")


def decode(tokens: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id and text of each row of ids; null ids give the empty text."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = ["" if ids is None else "".join(text_tokens(path).decode(np.asarray(ids))) for ids in batch["ids"]]
            yield pd.DataFrame({"doc_id": ids_column(batch["doc_id"]), "text": found})

    return tokens.selectExpr(f"`{id_col}` AS doc_id", f"`{ids_col}` AS ids").mapInPandas(run, "doc_id long, text string")


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, SHA-256 of the ids (little-endian unsigned 32-bit) and of the text decoded from them.

    A null or empty text has no tokens; repeated rows are digested each; a null id stays null.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens = text_tokens(path)
        for batch in batches:
            rows = []
            for ids in tokens.encode(batch["text"].tolist()):
                digest = hashlib.sha256()
                for part in tokens.decode(ids):
                    digest.update(part.encode())
                rows.append((len(ids), hashlib.sha256(ids).hexdigest(), digest.hexdigest()))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"]).assign(doc_id=ids_column(batch["doc_id"]))

    return texts(docs, id_col, text_col).mapInPandas(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
