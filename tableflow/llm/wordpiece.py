"""Counts of greedy word pieces by a linear longest-match automaton.

Each word, with a space before it, is cut from the left into the longest pieces the vocabulary
has. The automaton is the vocabulary's trie. Where a letter has no edge, a failure link leads to
the node of what is left after the pieces that are certain by then, and a number kept with the
link counts them. So each letter is read once, and no piece is ever built.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tableflow.llm.common import CACHE_LETTERS, CACHE_WORDS, byte_letters, ids_column, texts


class Automaton:
    """Trie, failure links and popped-piece counts of byte strings that include every single byte."""

    def __init__(self, pieces: list[bytes]):
        self.edges: list[dict[int, int]] = [{}]
        ends = [False]
        for piece in pieces:
            node = 0
            for byte in piece:
                if byte not in self.edges[node]:
                    self.edges[node][byte] = len(self.edges)
                    self.edges.append({})
                    ends.append(False)
                node = self.edges[node][byte]
            ends[node] = bool(piece)
        if len(self.edges[0]) < 256 or not all(ends[n] for n in self.edges[0].values()):
            raise ValueError("the vocabulary lacks single bytes")
        self.fail, self.popped = [0] * len(self.edges), [0] * len(self.edges)
        level = [(0, byte, node) for byte, node in self.edges[0].items()]
        while level:
            below = []
            for parent, byte, node in level:
                if ends[node]:
                    self.fail[node], self.popped[node] = 0, 1
                else:
                    at, count = self.fail[parent], self.popped[parent]
                    while byte not in self.edges[at]:
                        at, count = self.fail[at], count + self.popped[at]
                    self.fail[node], self.popped[node] = self.edges[at][byte], count
                below += [(node, b, n) for b, n in self.edges[node].items()]
            level = below

    def count(self, word: bytes) -> int:
        """How many pieces a word has."""
        edges, fail, popped, at, out = self.edges, self.fail, self.popped, 0, 0
        for byte in word:
            while byte not in edges[at]:
                out += popped[at]
                at = fail[at]
            at = edges[at][byte]
        while at:
            out += popped[at]
            at = fail[at]
        return out


class Counter:
    """Counts of whole texts; each word is run through the automaton once and its number kept."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            vocab = json.load(file)["model"]["vocab"]
        byte_of = {letter: byte for byte, letter in byte_letters().items()}
        self.automaton = Automaton([bytes(byte_of[c] for c in token) for token in vocab if all(c in byte_of for c in token)])
        self.known: dict[str, int] = {}

    def _learn(self, word: str) -> int:
        found = self.automaton.count(b" " + word.encode()) if word else 0
        if len(word) <= CACHE_LETTERS:
            if len(self.known) >= CACHE_WORDS:
                self.known.clear()
            self.known[word] = found
        return found

    def count(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Words and pieces of each text."""
        lists = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
        coded = lists.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        pieces = np.array([self.known[w] if w in self.known else self._learn(w) for w in words], np.int64)
        codes = coded.indices.to_numpy(zero_copy_only=False)
        real = np.array([bool(w) for w in words], bool)
        cuts = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        sums = [np.concatenate([[0], np.cumsum(x[codes])])[cuts] for x in (real.astype(np.int64), pieces)]
        return np.diff(sums[0]), np.diff(sums[1])


@lru_cache(maxsize=4)
def counter(path: str) -> Counter:
    """One counter for each vocabulary and Python worker."""
    return Counter(path)


def count_pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words and n_pieces of each text.

    Words are what ASCII white space separates. ``path`` names a byte-level vocabulary, whose
    pieces at the start of a word begin with the space. A null or empty text has no words;
    repeated rows count each; a null id stays null.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words, pieces = counter(path).count(batch["text"].tolist())
            yield pd.DataFrame({"doc_id": ids_column(batch["doc_id"]), "n_words": words, "n_pieces": pieces})

    return texts(docs, id_col, text_col).mapInPandas(run, "doc_id long, n_words long, n_pieces long")
