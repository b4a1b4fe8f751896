"""Line and document dedup against plain versions."""

import random
from collections import defaultdict

import corpus_pipeline
import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tableflow.llm import jaccard, linededup, shingles, simhash
from tableflow.llm.components import components

# ---- SimHash -------------------------------------------------------------------------


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    for space in "\t\n\x0b\x0c\r":
        words = words.replace(space, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[k:k + 4]).encode(), 42) for k in range(max(1, len(words) - 3))]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


@given(st.text(alphabet="ab \tÀ \x1c", max_size=60))
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def plain_groups(values, budget=4):
    of = list(range(len(values)))
    changed = True
    while changed:
        new = [min(of[j] for j in range(len(values)) if bin(values[i] ^ values[j]).count("1") <= budget) for i in range(len(values))]
        changed, of = new != of, new
    return of


def near_numbers(rng, count, spread):
    base = [rng.getrandbits(64) for _ in range(count)]
    out = set(base)
    for x in base:
        for _ in range(4):
            for bit in rng.sample(range(64), rng.randrange(spread)):
                x ^= 1 << bit
            out.add(x)
    return sorted(out)


def test_links_connect_what_all_pairs_do(spark):
    rng = random.Random(4)
    values = near_numbers(rng, 40, 7) + sorted({(0xABCDEF << 40) ^ 1 << k for k in range(64)} - set())
    values = sorted(set(values) | {0, (1 << 64) - 1})
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    for blocks, rows in ((1, 10), (2, 50), (3, 10), (5, 10)):
        links = simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long"), 4, blocks, rows)
        root = {r.node: r.root for r in components(links).collect()}
        groups = defaultdict(set)
        for x in signed:
            groups[root.get(x, x)].add(x)
        expected = defaultdict(set)
        for x, g in zip(signed, plain_groups(values), strict=True):
            expected[g].add(x)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values())), blocks


def test_near_duplicates(spark, edge_docs, no_docs):
    rows = simhash.near_duplicates(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    docs = edge_docs.collect()
    values = [plain_fingerprint(r.text or "") for r in docs]
    least = defaultdict(list)
    for r, g in zip(docs, plain_groups(values), strict=True):
        least[g].append(r.doc_id)
    expected = [(str(r.doc_id), f"{v:016x}", min((x for x in least[g] if x is not None), default=None))
                for r, v, g in zip(docs, values, plain_groups(values), strict=True)]
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in rows) == sorted(expected)
    assert simhash.near_duplicates(no_docs).count() == 0


def test_one_of_each_keeps_all_columns(edge_docs, no_docs):
    kept = simhash.one_of_each(edge_docs)
    assert kept.columns == edge_docs.columns
    texts = [plain_fingerprint(r.text or "") for r in kept.collect()]
    assert len(texts) == len(set(texts)) == len({plain_fingerprint(r.text or "") for r in edge_docs.collect()})
    assert simhash.one_of_each(no_docs).count() == 0


def test_components_of_a_chain_a_star_and_copies(spark):
    links = [(k, k + 1) for k in range(100, 160)] + [(7, k) for k in range(300, 500)] + [(7, 7), (300, 7), (None, 9)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: 100 for k in range(100, 161)} | {k: 7 for k in [7, *range(300, 500)]}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- shingles ------------------------------------------------------------------------


def plain_shingles(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
    return {" ".join(words[k:k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def plain_similarity(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def plain_kept(texts):
    """The first of each group that links of similarity 0.8 connect."""
    sets = [plain_shingles(t) for t in texts]
    of = list(range(len(texts)))
    changed = True
    while changed:
        new = [min(of[j] for j in range(len(texts)) if plain_similarity(sets[i], sets[j]) >= 0.8) for i in range(len(texts))]
        changed, of = new != of, new
    return {k for k, g in enumerate(of) if k == g}


def test_near_copies_of_shingles(spark, edge_docs, no_docs):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    texts = ["", None, "  ", "two words", "Two  words", "two other"]
    for _ in range(12):  # each next copy has some more words changed, from far above the threshold to below it
        words = [word() for _ in range(rng.randrange(60, 200))]
        for step in range(6):
            copy = list(words)
            for place in rng.sample(range(len(copy)), step):
                copy[place] = word()
            texts.append(" ".join(copy))
    common = [word() for _ in range(100)]  # a large group, with some of its members below the threshold
    for step in range(80):
        copy = list(common)
        for place in rng.sample(range(len(copy)), step % 7):
            copy[place] = word()
        texts.append(" ".join(copy))
    rng.shuffle(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    kept = {r.doc_id for r in shingles.one_of_each(docs).collect()}
    assert kept == plain_kept(texts)
    assert shingles.one_of_each(edge_docs).columns == edge_docs.columns and shingles.one_of_each(no_docs).count() == 0
    assert shingles.one_of_each(edge_docs).count() == len({frozenset(plain_shingles(r.text)) for r in edge_docs.collect()})


def test_pipeline_drops_copies_of_more_than_four_bits(spark):
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(120)]
    texts = [" ".join(words)] + [" ".join([*words[:k], "other", *words[k + 1:]]) for k in range(0, 120, 7)]
    first = simhash.fingerprint(texts[0])
    assert any(bin(first ^ simhash.fingerprint(t)).count("1") > 4 for t in texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    assert [r.doc_id for r in corpus_pipeline.dedup_documents(spark, docs, "").collect()] == [0]


def simhash_families(rng):
    """A text with near copies within four bits, and two texts of one fingerprint that are unlike."""
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    words = [word() for _ in range(2_000)]
    near = [" ".join(words)] + [" ".join([*words[:k], word(), *words[k + 1:]]) for k in range(0, 2_000, 97)]
    first = simhash.fingerprint(near[0])
    near = [t for t in near if bin(first ^ simhash.fingerprint(t)).count("1") <= 4]
    unlike = ["a " * 400 + " ".join(word() for _ in range(20)) for _ in range(2)]
    assert len(near) > 10 and bin(simhash.fingerprint(unlike[0]) ^ simhash.fingerprint(unlike[1])).count("1") <= 4
    return near, unlike


def test_simhash_alone_settles_what_is_within_its_bits(spark, monkeypatch):
    near, unlike = simhash_families(random.Random(10))
    docs = spark.createDataFrame(list(enumerate(near + unlike)), "doc_id long, text string").coalesce(1)
    shared = jaccard._shared_cells
    monkeypatch.setattr(jaccard, "_shared_cells", lambda s: shared(s).withColumn("centre", jaccard.F.col("node")))
    monkeypatch.setattr(jaccard, "_surviving", lambda members, *a: members.selectExpr("node AS a", "node AS b").limit(0))
    assert {r.doc_id for r in corpus_pipeline.dedup_documents(spark, docs, "").collect()} == {0, len(near), len(near) + 1}


def test_simhash_leaves_less_to_the_join(spark, monkeypatch):
    near, unlike = simhash_families(random.Random(11))
    docs = spark.createDataFrame(list(enumerate(near + unlike)), "doc_id long, text string").coalesce(1)
    compared = []
    verified = jaccard._verified
    monkeypatch.setattr(jaccard, "_verified", lambda pairs, *a: compared.append(pairs.count()) or verified(pairs, *a))
    assert shingles.one_of_each(docs).count() == 3
    assert compared == [len(near), 0, 0]  # each with the first of its component, the unlike ones too; then none


# ---- lines ---------------------------------------------------------------------------


def plain_dedup(texts, least):
    """Deletes, for each run with an earlier copy that is long enough, all its lines."""
    lines = [t.split("\n") for t in texts]
    starts = [(d, i) for d, found in enumerate(lines) for i in range(len(found))]
    gone = [set() for _ in texts]
    for n, (d, i) in enumerate(starts):
        for e, j in starts[:n]:
            m = 0
            while i + m < len(lines[d]) and j + m < len(lines[e]) and lines[d][i + m] == lines[e][j + m]:
                m += 1
            if sum(map(len, lines[d][i:i + m])) >= least:
                gone[d] |= set(range(i, i + m))
    return ["\n".join(x for i, x in enumerate(found) if i not in out) for found, out in zip(lines, gone, strict=True)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 9), max_size=20), st.integers(1, 25))
def test_smallest_windows(sizes, least):
    after, before = linededup.windows(np.array(sizes, np.int64), least)
    for i in range(len(sizes)):
        assert after[i] == next((m for m in range(1, len(sizes) - i + 1) if sum(sizes[i:i + m]) >= least), 0)
        assert before[i] == next((m for m in range(1, i + 2) if sum(sizes[i + 1 - m:i + 1]) >= least), 0)


def test_repeated_runs_go(spark):
    rng = random.Random(5)
    texts = ["\n".join(rng.choice(["aaaa", "bbb", "", "cc", "d"]) for _ in range(rng.randrange(1, 14))) for _ in range(25)]
    texts += texts[:2] + ["aaaa\naaaa\naaaa\naaaa\naaaa"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    for least in (1, 5, 9, 20):
        rows = sorted(linededup.dedup_lines(docs, least).collect())
        expected = plain_dedup(texts, least)
        assert [r.text for r in rows] == expected
        for r, before, after in zip(rows, texts, expected, strict=True):
            assert r.lines_before == before.count("\n") + 1
            assert r.lines_removed == r.lines_before - (after.count("\n") + 1 if after or r.lines_removed < r.lines_before else 0) \
                or after == ""


def test_lines_of_edge_cases(edge_docs, no_docs):
    got = linededup.dedup_lines(edge_docs, 5)
    assert got.columns == [*edge_docs.columns, "lines_before", "lines_removed"]
    rows = got.collect()
    assert len(rows) == edge_docs.count()
    assert sorted(r.text for r in rows if r.doc_id == 1) == ["", "A b c d e"]
    assert [r.text for r in rows if r.doc_id == 3] == [None] and [r.lines_before for r in rows if r.doc_id == 3] == [0]
    assert {(r.row, r.uid, r.node) for r in rows} == {(r.row, r.uid, r.node) for r in edge_docs.collect()}
    assert linededup.dedup_lines(no_docs).count() == 0
