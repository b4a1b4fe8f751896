"""The n-gram Jaccard join against all pairs."""

import random
import re

import numpy as np
import pytest

from tableflow.llm import jaccard
from tableflow.llm.rtree import RTree, joined, needed


def shingle_set(text, size=5):
    words = re.findall("[^\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)}


def plain(rows):
    """Ids, sizes and components, by comparing each text with each."""
    sets = [shingle_set(t) for _, t in rows]
    of = list(range(len(rows)))

    def root(i):
        while of[i] != i:
            i = of[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and min(len(a), len(b)) * 100 >= max(len(a), len(b)) * 80 and 100 * len(a & b) >= 80 * len(a | b):
                of[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return sorted((repr(d), len(s), repr(least.get(root(i)))) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True)))


def found(docs, **how):
    df = jaccard.near_documents(docs, **how)
    assert df.columns == ["doc_id", "n_shingles", "component_id"]
    return sorted((repr(r.doc_id), r.n_shingles, repr(r.component_id)) for r in df.collect())


def edited(made, words, share):
    return [made.choice(["odd", "even", "blue", "red"]) + str(made.random())[2:6] if made.random() < share else w for w in words]


@pytest.fixture(scope="module")
def families():
    """Near copies of many degrees, of short and long texts, and texts that only share a passage."""
    made, rows = random.Random(5), []
    vocabulary = [f"w{k}" for k in range(400)]
    passage = made.choices(vocabulary, k=60)
    for n in [4, 5, 6, 7, 9, 12, 20, 31, 40, 64, 70, 130, 260, 300, 700]:
        base = made.choices(vocabulary, k=n)
        for share in (0, 0, 0.005, 0.01, 0.02, 0.03, 0.05):
            rows.append(" ".join(edited(made, base, share)))
        rows += [" ".join(base + made.choices(vocabulary, k=max(1, n * extra // 100))) for extra in (5, 15, 20, 24, 26, 30)]
        rows.append(" ".join(base[:n // 2] + passage + base[n // 2:]))
    rows += [" ".join(made.choices(vocabulary, k=made.randint(0, 80))) for _ in range(60)]
    rows += [r.upper() + "\n" for r in rows[::17]] + ["", None, " \t"]
    made.shuffle(rows)
    return [(k * 3 % len(rows), t) for k, t in enumerate(rows)]


def test_families(spark, families):
    docs = spark.createDataFrame(families, "doc_id long, text string").repartition(6)
    assert found(docs) == plain(families)


def test_small_blocks(spark, families, monkeypatch):
    """Cells cut into blocks, and no comparison with a centre: the R-trees alone find the same."""
    docs = spark.createDataFrame(families, "doc_id long, text string").repartition(6)
    monkeypatch.setattr(jaccard, "_surviving", lambda *a, real=jaccard._surviving: real(*a, tile=3))
    shared = jaccard._shared_cells
    monkeypatch.setattr(jaccard, "_shared_cells", lambda s: shared(s).withColumn("centre", jaccard.F.col("node")))
    assert found(docs) == plain(families)


def test_without_trees_links_are_lost(spark, families, monkeypatch):
    docs = spark.createDataFrame(families, "doc_id long, text string").repartition(6)
    shared = jaccard._shared_cells
    monkeypatch.setattr(jaccard, "_shared_cells", lambda s: shared(s).withColumn("centre", jaccard.F.col("node")))
    monkeypatch.setattr(jaccard, "_surviving", lambda members, *a: members.selectExpr("node AS a", "node AS b").limit(0))
    assert found(docs) != plain(families)


def test_too_few_groups(spark, families):
    """Groups too large for the threshold are halved until they are enough."""
    docs = spark.createDataFrame(families[:80], "doc_id long, text string")
    assert any(slack < 0 for t in families[:80] for _, slack, _ in jaccard.entries_of(jaccard.shingles(t[1] or ""), load=30.0))
    assert found(docs, load=30.0) == plain(families[:80])


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert found(docs) == plain([(r.doc_id, r.text) for r in docs.collect()])


def test_edges(spark, edge_docs, no_docs):
    assert found(edge_docs) == plain([(r.doc_id, r.text) for r in edge_docs.collect()])
    assert found(no_docs) == []


def test_threshold_is_met_exactly(spark):
    """8 of 10 shingles link, 7 of 9 do not."""
    a = "a b c d e f g h i j k l m"  # 9 shingles
    rows = [(1, a), (2, a + " n"), (3, "a b c d e f g h i j k l"), (4, "z " + "a b c d e f g h i j k l y"), (5, "q r s t u"), (6, "q r s t")]
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == plain(rows)


@pytest.mark.parametrize("seed", range(5))
def test_tree_join(seed):
    made = np.random.default_rng(seed)
    points = [made.poisson(4, (n, 16)) for n in (1 + seed * 37, 90)]
    points[1][:20] = points[0][0]
    sizes, labels = [p.sum(axis=1) for p in points], [made.integers(0, 3, len(p)) for p in points]
    i, j = joined(*[RTree(*x) for x in zip(points, sizes, labels, strict=True)], 80)
    a, b = (x.ravel() for x in np.indices((len(points[0]), 90)))
    total = sizes[0][a] + sizes[1][b]
    near = ((np.minimum(points[0][a], points[1][b]).sum(axis=1) >= needed(total, 80)) & (labels[0][a] != labels[1][b])
            & (100 * sizes[0][a] >= 80 * sizes[1][b]) & (100 * sizes[1][b] >= 80 * sizes[0][a]))
    assert sorted(zip(i.tolist(), j.tolist(), strict=True)) == sorted(zip(a[near].tolist(), b[near].tolist(), strict=True))


def test_sets_have_groups_enough():
    """A set has more groups than may differ, by any count of shingles."""
    made = np.random.default_rng(1)
    for size in [1, 2, 3, 5, 10, 33, 63, 64, 100, 127, 128, 200, 500, 3000]:
        for _ in range(20):
            one = np.unique(made.integers(0, 1 << 64, size, np.uint64))
            for level, slack, names in jaccard.entries_of(one):
                assert slack >= 0 and len(names) == len(set(names.tolist())) and level <= size.bit_length()
