"""Nearest neighbours against all cosines, search against all BM25 scores."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from tableflow.llm import ann, search

SHAPE = "vec_id long, embedding array<float>, label int, shard int, ids binary"


def exact(rows, k):
    vectors = {i: np.array(v, np.float64) for i, v in rows
               if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    out = {}
    for q, v in vectors.items():
        scores = [(-float(v @ w / math.sqrt(v @ v) / math.sqrt(w @ w)), i) for i, w in vectors.items() if i != q and len(w) == len(v)]
        out[q] = sorted((round(s, 9), i) for s, i in scores)[:k]
    return out


def test_neighbours_of_random_vectors_are_found(spark):
    rng = np.random.default_rng(2)
    rows = [(k, rng.standard_normal(24).astype(np.float32).tolist()) for k in range(1500)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = defaultdict(list)
    for r in ann.nearest(df, F.col("vec_id") % 50 == 0, 5, shard_rows=400, query_rows=7).orderBy("query_id", "rank").collect():
        got[r.query_id].append((round(-r.score, 9), r.vec_id))
    expected = exact(rows, 5)
    assert set(got) == set(range(0, 1500, 50)) and all(len(v) == 5 and v == sorted(v) for v in got.values())
    assert sum(len({i for _, i in v} & {i for _, i in expected[q]}) for q, v in got.items()) >= 0.95 * 5 * len(got)


def test_vectors_that_take_no_part_ties_and_few_candidates(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (50, [3.0, 3.0]), (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0]),
            (6, [inf, 1.0]), (7, [None, 1.0]), (8, []), (None, [1.0, 1.0]), (100, [1.0, 2.0, 3.0]), (150, None), (9, [-1e-30, 0.0])]
    df = spark.createDataFrame([(*r, 1, 1, b"") for r in rows], SHAPE)
    got = ann.nearest(df, F.col("vec_id") % 50 == 0, 5).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in got] == [
        (0, 1, 1), (0, 2, 2), (0, 3, 50), (0, 4, 9), (50, 1, 0), (50, 2, 1), (50, 3, 2), (50, 4, 9)]
    assert [round(r.score, 12) for r in got[:4]] == [1.0, 1.0, round(math.sqrt(0.5), 12), -1.0]
    assert ann.nearest(df.limit(0), F.col("vec_id") % 50 == 0, 5).count() == 0


def test_many_copies_of_one_vector(spark):
    rows = [(k, [1.0, 2.0, 3.0] if k % 3 else [float(k), 1.0, 0.5]) for k in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = ann.nearest(df, F.col("vec_id") == 100, 3, shard_rows=50).orderBy("rank").collect()
    assert [r.vec_id for r in got] == [1, 2, 4] and len({r.score for r in got}) == 1


def plain_search(docs, is_query, k):
    words = [re.findall(r"[^\W_]+", (t or "").lower()) for _, t in docs]
    df = Counter(w for found in words for w in set(found))
    mean = sum(map(len, words)) / len(docs)
    queries = defaultdict(set)
    for (i, _), found in zip(docs, words, strict=True):
        if i is not None and is_query(i):
            queries[i] |= set(found)
    out = []
    for q, asked in queries.items():
        scores = []
        for (i, _), found in zip(docs, words, strict=True):
            tf = Counter(found)
            share = [round(1e6 * (math.log(1 + (len(docs) - df[w] + 0.5) / (df[w] + 0.5))
                                  * (tf[w] * 2.2 / (tf[w] + 1.2 * (0.25 + 0.75 * len(found) / mean))))) for w in asked if tf[w]]
            if share:
                scores.append((-sum(share), i is None, i))
        out += [(q, n + 1, i, -s) for n, (s, _, i) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return sorted(out)


def test_search_equals_all_scores(spark):
    rng = random.Random(6)
    names = ["".join(rng.choice("abcde") for _ in range(rng.randrange(1, 4))) for _ in range(60)]
    docs = [(k, " ".join(rng.choice(names) + rng.choice(["", ".", ", x"]) for _ in range(rng.randrange(1, 60)))) for k in range(400)]
    docs += [(k + 400, docs[k][1]) for k in range(40)] + [(None, docs[0][1]), (500, docs[0][1]), (500, "Zz é"), (510, ""), (520, None)]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, term string, shard int").repartition(3)
    for shard, block in ((8_192, 64), (50, 8)):
        before, search.BLOCK_ROWS = search.BLOCK_ROWS, block
        try:
            got = search.top_k(df, F.col("doc_id") % 10 == 0, 7, shard_rows=shard, query_rows=9).collect()
        finally:
            search.BLOCK_ROWS = before
        rows = sorted((r.query_id, r.rank, r.doc_id, round(r.score * 1e6)) for r in got)
        assert rows == plain_search(docs, lambda i: i % 10 == 0, 7)
    assert search.top_k(df.limit(0), F.col("doc_id") % 10 == 0, 7).count() == 0


def test_pruned_blocks_change_nothing():
    rng = random.Random(8)
    names = [f"w{k}" for k in range(200)]
    texts = [" ".join(rng.choice(names[: rng.choice((5, 30, 200))]) for _ in range(rng.randrange(3, 40))) for _ in range(900)]
    row = type("Row", (), search.index_rows([search.postings(texts[:500]), search.postings(texts[500:], 500)]) | {"ids": np.arange(900).astype("<i8").tobytes(), "no_id": bytes(900)})
    shard = search.Shard(row, 20.0)
    for _ in range(50):
        terms = np.array(sorted(rng.sample(range(len(shard.terms)), 12)))
        rarity = np.array([rng.random() * 5 for _ in terms])
        docs, scores = shard.top(terms, rarity, 5)
        every = np.zeros(900)
        for t, w in zip(terms, rarity, strict=True):
            a, z = shard.part_start[shard.first_part[t]], shard.part_end[shard.first_part[t + 1] - 1]
            np.add.at(every, shard.docs[a:z], np.rint(search.UNIT * (w * shard.weights[a:z])))
        best = np.lexsort((np.arange(900), -every))[:5]
        assert docs.tolist() == best[every[best] > 0].tolist() and scores.tolist() == every[docs].tolist()


def a_row(texts, first, shuffled=False):
    """The row of a shard, its documents ordered by length or not, and these documents."""
    places = np.argsort([len(t.split()) for t in texts], kind="stable") if shuffled else np.arange(len(texts))
    kept = {"ids": (places + first).astype("<i8").tobytes(), "no_id": bytes(len(texts))}
    return type("Row", (), search.index_rows([search.postings(texts)], places) | kept)


def test_shards_as_one_with_a_score_to_beat(monkeypatch):
    rng = random.Random(12)
    names = [f"w{k}" for k in range(300)]
    texts = [" ".join(rng.choice(names[: rng.choice((5, 30, 300))]) for _ in range(rng.randrange(3, 60))) for _ in range(900)]
    texts[850:] = texts[100:150]  # equal scores in two shards
    alone = search.Shard(a_row(texts, 0), 20.0)
    whole = []
    scored = search.Shard._long_sums
    monkeypatch.setattr(search.Shard, "_long_sums", lambda shard, docs, rows: whole.append(len(docs)) or scored(shard, docs, rows))
    rows = [a_row(texts[:400], 0, True), a_row(texts[400:410], 400, True), a_row(texts[410:], 410, True)]
    for share, step in ((16, 256), (2, 1)):
        monkeypatch.setattr(search, "LONG_SHARE", share)
        monkeypatch.setattr(search, "SLICE", step)
        monkeypatch.setattr(search, "BLOCK_ROWS", 64)
        shard = search.Shard(rows, 20.0)
        assert shard.terms.tolist() == alone.terms.tolist()
        rarity = np.array([rng.random() * 5 for _ in shard.terms])
        for at in rng.sample(range(900), 60):
            terms = np.flatnonzero(np.isin(shard.terms, search.words([texts[at]])[0]))
            every = np.zeros(900)
            for t in terms:
                a, z = alone.list_start[t], alone.list_start[t + 1]
                every[alone.docs[a:z]] += np.rint(search.UNIT * (rarity[t] * alone.weights[a:z]))
            best = np.lexsort((np.arange(900), -every))[:5]
            for least in (0.0, every[best[2]], every[best[0]] + 1):
                docs, scores = shard.top(terms, rarity[terms], 5, least)
                good = best[(every[best] >= least) & (every[best] > 0)]
                assert shard.ids[docs].tolist()[:len(good)] == good.tolist() and scores.tolist()[:len(good)] == every[good].tolist()
    assert sum(whole) < 0.1 * 900 * len(whole)  # levels leave few documents to score whole


def test_queries_in_several_tasks_and_shards_that_pass_by(spark, monkeypatch):
    rng = random.Random(13)
    names = [f"w{k}" for k in range(80)]
    docs = [(k, " ".join(rng.choice(names) for _ in range(rng.randrange(1, 40)))) for k in range(200)]
    docs += [(k + 200, docs[k][1]) for k in range(30)] + [(None, docs[0][1]), (400, ""), (410, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    monkeypatch.setattr(search, "HELD_ROWS", 8)
    monkeypatch.setattr(search, "TASKS", 0)
    for shards in (1, 3, 16):
        monkeypatch.setattr(search, "TASK_SHARDS", shards)
        got = search.top_k(df, F.col("doc_id") % 10 == 0, 6, shard_rows=20, query_rows=4).collect()
        rows = sorted((r.query_id, r.rank, r.doc_id, round(r.score * 1e6)) for r in got)
        assert rows == plain_search(docs, lambda i: i % 10 == 0, 6)
