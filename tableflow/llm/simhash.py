"""SimHash near-duplicates: fingerprints joined with themselves along a binary trie.

Texts whose 64-bit fingerprints differ in few bits are linked. Distinct fingerprints, sorted, are
a binary trie: a node is a range of them. Pairs of nodes are walked down together; the bits in
which their paths differ add up, and a pair that exceeds the budget is dropped with all below it.

Of ``BLOCKS`` parts of the bits, one holds at most ``budget // BLOCKS`` of the differing bits. So
the walk runs over as many tries, each led by another part within which that smaller budget holds.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableflow.joins import divisible_join
from tableflow.llm.common import ids_column, prepare, texts
from tableflow.llm.components import components
from tableflow.session import materialise

BITS = 64
BLOCKS = 3
BUDGET = 4
SHINGLE = 4
SEED = 42
NODE_ROWS = 4_000
PAIRS = 1 << 18
LEAF = 32


def fingerprint(text: str, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Bit i is set if it is set in more than half of the shingles' hashes; no words give zero."""
    data = text.encode().lower()  # bytes: A-Z alone change
    words = data.split()  # bytes: at 0x20 and 0x09 to 0x0D
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, seed)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = (ends - np.diff(ends, prepend=0))[:len(words) - shingle + 1].tolist()
    ends = (ends[shingle - 1:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], seed) for a, b in zip(starts, ends, strict=True)], "<u8")
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at:at + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ``fp``, the fingerprint as a signed long."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = np.array([fingerprint(t) for t in batch["text"]], np.uint64).view(np.int64)
            yield pd.DataFrame({"doc_id": ids_column(batch["doc_id"]), "fp": found})

    return texts(docs, id_col, text_col).mapInPandas(run, "doc_id long, fp long")


class _Groups:
    """Which fingerprints of a task are linked so far."""

    def __init__(self, size: int):
        self.of = np.arange(size)

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        while len(i):
            a, b = self.of[i], self.of[j]
            apart = a != b
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(self.of, np.maximum(a, b), np.minimum(a, b))
            while (self.of[self.of] != self.of).any():
                self.of = self.of[self.of]


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... for counts[0] numbers, then the same from starts[1]."""
    ends = np.cumsum(counts)
    return np.repeat(starts - ends + counts, counts) + np.arange(ends[-1] if len(ends) else 0)


def walk(left: np.ndarray, right: np.ndarray | None, groups: _Groups, own: np.ndarray, other: np.ndarray,
         budget: int, lead: int, lead_budget: int) -> None:
    """Link all pairs of ``left`` x ``right`` (or of ``left`` with itself) within the budget.

    Both are sorted and distinct; ``own`` and ``other`` give their places in ``groups``. Pairs of
    nodes wait on a stack in blocks of ``PAIRS``, so memory does not grow with the pairs.
    """
    itself = right is None
    right = left if itself else right
    if not len(left) or not len(right):
        return

    def node(values: np.ndarray, lo: np.ndarray, bit: np.uint64) -> np.ndarray:
        above = ~((bit << np.uint64(1)) - np.uint64(1)) if bit < 1 << 63 else np.uint64(0)
        return np.searchsorted(values, (values[lo] & above) | bit)

    one = np.zeros(1, np.int64)
    stack = [(0, one, one + len(left), one, one + len(right), one)]
    while stack:
        depth, a, az, b, bz, errors = stack.pop()
        if len(a) > PAIRS:
            stack += [(depth, *(x[k:k + PAIRS] for x in (a, az, b, bz, errors))) for k in range(0, len(a), PAIRS)]
            continue
        # A pair whose fingerprints are all linked already has nothing to add.
        changes_a = np.cumsum(np.diff(groups.of[own], prepend=0) != 0)
        changes_b = changes_a if itself else np.cumsum(np.diff(groups.of[other], prepend=0) != 0)
        known = ((changes_a[a] == changes_a[az - 1]) & (changes_b[b] == changes_b[bz - 1])
                 & (groups.of[own[a]] == groups.of[other[b]]))
        few = ~known & (((az - a) * (bz - b) <= LEAF) | (depth == BITS))
        if few.any():
            n = (bz - b)[few]
            i = _ranges(a[few], (az - a)[few])
            n_i = np.repeat(n, (az - a)[few])
            j = _ranges(np.repeat(b[few], (az - a)[few]), n_i)
            i = np.repeat(i, n_i)
            near = np.bitwise_count(left[i] ^ right[j]) <= budget
            groups.link(own[i[near]], other[j[near]])
        go = ~few & ~known
        if not go.any():
            continue
        a, az, b, bz, errors = (x[go] for x in (a, az, b, bz, errors))
        bit = np.uint64(1 << (BITS - 1 - depth))
        am, bm = np.clip(node(left, a, bit), a, az), np.clip(node(right, b, bit), b, bz)
        most = lead_budget if depth < lead else budget
        below = []
        for la, lz, ra, rz, more in ((a, am, b, bm, 0), (am, az, bm, bz, 0), (a, am, bm, bz, 1), (am, az, b, bm, 1)):
            keep = (la < lz) & (ra < rz) & (errors + more <= most)
            if itself and more and la is not a:
                keep &= a != b  # the mirror image of the pair before
            below.append((la[keep], lz[keep], ra[keep], rz[keep], (errors + more)[keep]))
        joined = [np.concatenate(x) for x in zip(*below, strict=True)]
        if len(joined[0]):
            stack.append((depth + 1, *joined))


def links(found: DataFrame, budget: int = BUDGET, blocks: int = BLOCKS, node_rows: int = NODE_ROWS) -> DataFrame:
    """Links (a, b) that connect all fingerprints (column ``fp``, distinct) within ``budget`` bits.

    A task gets one node of a trie, of the nodes beside it those with a larger prefix, and gives a
    spanning forest of what it links: at most one row for each fingerprint it saw, not all pairs.
    The depth of these nodes follows the number of fingerprints, ``node_rows`` for each.
    """
    spark = found.sparkSession
    prepare(spark)
    lead_budget = budget // blocks
    cuts = [BITS * k // blocks for k in range(blocks + 1)]
    count = found.count()
    depth = min(max(4, math.ceil(math.log2(max(1, count) / node_rows))), *(z - a for a, z in zip(cuts, cuts[1:], strict=False)))
    masks = [0] + ([1 << k for k in range(depth)] if lead_budget else [])
    for _ in range(lead_budget - 1):
        masks = sorted({m ^ 1 << k for m in masks for k in range(depth)} | set(masks))
    places = []
    for trie, turn in enumerate(cuts[:-1]):
        value = f"(shiftleft(fp, {turn}) | shiftrightunsigned(fp, {BITS - turn}))" if turn else "fp"
        places.append(f"transform(array({', '.join(map(str, masks))}), m -> struct({trie} AS trie,"
                      f" shiftrightunsigned({value}, {BITS - depth}) AS own, shiftrightunsigned({value}, {BITS - depth}) ^ m AS node, {value} AS v))")
    nodes = (found.selectExpr(f"explode(concat({', '.join(places)})) AS x").select("x.*").where("node <= own")
             .selectExpr("trie", "node", "own = node AS mine", "v"))

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        turn, lead = cuts[key[0]], cuts[key[0] + 1] - cuts[key[0]]
        values, mine = rows["v"].to_numpy().view(np.uint64), rows["mine"].to_numpy()
        own, beside = np.sort(values[mine]), np.sort(values[~mine])
        groups, at = _Groups(len(values)), np.arange(len(values))
        walk(own, None, groups, at[:len(own)], at[:len(own)], budget, lead, lead_budget)
        walk(own, beside, groups, at[:len(own)], at[len(own):], budget, lead, lead_budget)
        rotated = np.concatenate([own, beside])
        back = (rotated >> np.uint64(turn)) | (rotated << np.uint64(BITS - turn)) if turn else rotated
        linked = np.flatnonzero(groups.of != at)
        return pd.DataFrame({"a": back[linked].view(np.int64), "b": back[groups.of[linked]].view(np.int64)})

    return nodes.groupBy("trie", "node").applyInPandas(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", budget: int = BUDGET) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, the least doc_id reachable over links.

    One row for each input row. A null or empty text has fingerprint zero. Equal fingerprints link,
    repeated rows among them. A null doc_id stays null and lends its component no name; a component
    without any id has a null one.
    """
    found = materialise(fingerprints(docs, id_col, text_col), "fingerprints")
    classes = materialise(found.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    roots = components(links(classes.select("fp"), budget))
    rooted = materialise(classes.join(roots, classes.fp == roots.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")), "classes")
    names = rooted.groupBy(F.col("root").alias("of")).agg(F.min("least").alias("component_id"))
    named = divisible_join(rooted, names, [rooted.root], [names.of], "inner").select(F.col("fp").alias("class"), "component_id")
    named = materialise(named, "classes")
    return found.join(named, found.fp == named["class"]).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, text_col: str = "text", budget: int = BUDGET) -> DataFrame:
    """``docs`` with the first row, in input order, of each group of near duplicates; columns stay as they are."""
    staged = materialise(docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("uid")), "rows")
    groups = near_duplicates(staged.select("uid", F.col("row")[text_col].alias("text")), "uid", "text", budget)
    first = groups.where("doc_id = component_id").select("doc_id")
    return staged.join(first, staged.uid == first.doc_id, "left_semi").select("row.*")
