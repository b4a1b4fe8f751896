"""A binary file format for token ids: range asymmetric numeral systems over a static table.

One frequency table serves the whole data set. Ids are cut into blocks that decode alone; in a
block, ``LANES`` coders run side by side, each on every ``LANES``-th id, and share one stream of
32-bit words. A block keeps the coders' states at its start and again at each checkpoint, with
the place in the stream, so that a reader can begin in the middle; a checksum guards it.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np

SCALE = 20  # the frequencies of a table sum to 2 ** SCALE
LANES = 2048
BLOCK_IDS = 524_288
CHECKPOINT_STEPS = 128
_LOW = np.uint64(1 << 31)
_WORD = np.uint64(32)


def frequencies(counts: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Counts scaled to sum to ``2 ** scale``, at least 1 for each id that occurs.

    A data set without ids gets a table without entries, which no block uses.
    """
    total, size = int(counts.sum()), 1 << scale
    if total == 0:
        return np.zeros(len(counts), np.uint32)
    if np.count_nonzero(counts) > size:
        raise ValueError("more ids occur than the table has slots")
    share = counts.astype(np.float64) * (size / total)
    freq = np.where(counts > 0, np.maximum(1, np.floor(share)), 0).astype(np.int64)
    order = np.argsort(-freq, kind="stable")
    while (gap := size - int(freq.sum())) != 0:
        able = order[freq[order] > 1] if gap < 0 else order[freq[order] > 0]
        step = np.minimum(freq[able] // 2, max(1, -gap // len(able))) if gap < 0 else np.full(len(able), max(1, gap // len(able)))
        step = np.where(np.cumsum(step) <= abs(gap), step, np.maximum(0, abs(gap) - (np.cumsum(step) - step)))
        freq[able] += np.sign(gap) * step
    return freq.astype(np.uint32)


@dataclass
class Table:
    """A frequency table, ready for coding."""

    freq: np.ndarray
    scale: int = SCALE

    def __post_init__(self):
        self.freq = self.freq.astype(np.uint64)
        self.start = np.cumsum(self.freq) - self.freq
        self.limit = (_LOW >> np.uint64(self.scale) << _WORD) * self.freq
        self.symbol = np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.freq.astype(np.int64))


@dataclass
class Block:
    """One encoded block; ``marks`` are (step, words read before it, states) at each checkpoint."""

    n_ids: int
    words: bytes
    states: bytes
    mark_words: list[int]
    crc: int
    lanes: int
    every: int


def encode_block(ids: np.ndarray, table: Table, lanes: int = LANES, every: int = CHECKPOINT_STEPS) -> Block:
    """Encode ids from the last to the first, as decoding runs from the first to the last."""
    state = np.full(lanes, _LOW, np.uint64)
    steps = -(-len(ids) // lanes)
    stream, marks, scale = [], [], np.uint64(table.scale)
    written = 0
    for step in range(steps - 1, -1, -1):
        part = ids[step * lanes:(step + 1) * lanes]
        x, freq = state[:len(part)], table.freq[part]
        full = x >= table.limit[part]
        words = x[full].astype(np.uint32)
        x = np.where(full, x >> _WORD, x)
        quotient, rest = np.divmod(x, freq)
        state[:len(part)] = (quotient << scale) + rest + table.start[part]
        stream.append(words)
        written += len(words)
        if step % every == 0:
            marks.append((written, state.copy()))
    body = np.concatenate(stream[::-1]) if stream else np.zeros(0, np.uint32)
    states = np.concatenate([m[1] for m in marks[::-1]]) if marks else np.zeros(0, np.uint64)
    words, states = body.astype("<u4").tobytes(), states.astype("<u8").tobytes()
    return Block(len(ids), words, states, [written - m[0] for m in marks[::-1]], zlib.crc32(states, zlib.crc32(words)), lanes, every)


def decode_block(block: Block, table: Table, first: int = 0, last: int | None = None) -> np.ndarray:
    """The ids ``first`` to ``last`` of a block, beginning at the checkpoint before ``first``."""
    if zlib.crc32(block.states, zlib.crc32(block.words)) != block.crc:
        raise ValueError("a block of token ids is damaged")
    last = block.n_ids if last is None else min(last, block.n_ids)
    if first >= last:
        return np.zeros(0, np.uint32)
    lanes, scale = block.lanes, np.uint64(table.scale)
    mask = np.uint64((1 << table.scale) - 1)
    mark = first // lanes // block.every
    state = np.frombuffer(block.states, "<u8")[mark * lanes:(mark + 1) * lanes].astype(np.uint64)
    words, at = np.frombuffer(block.words, "<u4"), block.mark_words[mark]
    begin = mark * block.every
    out = []
    for step in range(begin, -(-last // lanes)):
        size = min(lanes, block.n_ids - step * lanes)
        x = state[:size]
        slot = x & mask
        ids = table.symbol[slot]
        x = table.freq[ids] * (x >> scale) + slot - table.start[ids]
        low = x < _LOW
        need = int(np.count_nonzero(low))
        if need:
            x[low] = (x[low] << _WORD) | words[at:at + need]
            at += need
        state[:size] = x
        out.append(ids)
    return np.concatenate(out)[first - begin * lanes:last - begin * lanes]
