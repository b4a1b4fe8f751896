"""The classifier on generated texts that are easy to tell apart."""

import random

import numpy as np
import pytest

from tableflow.llm import quality


@pytest.fixture(scope="module")
def marked(spark):
    rng = random.Random(1)
    rows = []
    for k in range(400):
        words = ["".join(rng.choice("etaoinshr") for _ in range(rng.randrange(2, 8))) for _ in range(rng.randrange(5, 300))]
        good = k % 4 != 0
        rows.append((k, " ".join(words) + "." if good else "!! ".join(words).upper(), int(good)))
    return spark.createDataFrame(rows, "doc_id long, text string, quality int")


def test_held_out_documents_are_told_apart(marked):
    net = quality.train(marked.select("doc_id", "text"), marked.select("doc_id", "quality"))
    rows = quality.score(marked, net).join(marked, "doc_id").collect()
    assert len(rows) == 400 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out]
    assert 40 < len(held) < 120 and np.mean([(r.score >= 0.5) == r.quality for r in held]) > 0.97
    kept = quality.accepted(marked, net)
    assert kept.columns == marked.columns and kept.count() == sum(r.predicted for r in rows)


def test_no_held_out_document_is_learned(marked):
    found = quality.labelled(marked.select("doc_id", "text"), marked.select("doc_id", "quality"), rows=500)
    assert found.where(quality.held_out(found.doc_id)).count() == 0
    few = quality.labelled(marked.select("doc_id", "text"), marked.select("doc_id", "quality"), rows=10)
    assert few.groupBy("label").count().where("count = 10").count() == 2


def test_one_row_of_each_document_is_learned(spark, marked):
    docs = marked.select("doc_id", "text").unionByName(spark.range(500).selectExpr("1L AS doc_id", "concat('row ', id) AS text"))
    rows = quality.labelled(docs.repartition(4), marked.select("doc_id", "quality"), rows=500).collect()
    assert len(rows) == len({r.doc_id for r in rows}) == marked.where(~quality.held_out(marked.doc_id)).count()
    again = quality.labelled(docs.repartition(3), marked.select("doc_id", "quality"), rows=500).collect()
    assert sorted(rows) == sorted(again)


def test_edge_cases(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, None), (3, 7), (None, 1)], "doc_id long, quality int")
    share = quality.train(edge_docs, labels)
    assert share in (0.5, 1.0) and quality.train(no_docs, labels.limit(0)) == 0.5
    net = quality.Net.fresh()
    rows = quality.score(edge_docs, net).collect()
    assert len(rows) == edge_docs.count() and all(0 <= r.score <= 1 for r in rows)
    by_text = {r.text: s for r, s in zip(edge_docs.collect(), net.score([x.text or "" for x in edge_docs.collect()]), strict=True)}
    assert by_text[""] == by_text[None]
    assert quality.score(no_docs, net).count() == 0 and quality.score(edge_docs, 0.2).where("predicted = 1").count() == 0


def test_chunks_cover_the_whole_text():
    for size in (0, 1, quality.STEP, quality.CHUNK, quality.CHUNK + 1, 5000):
        text = bytes(1 + k % 250 for k in range(size))
        rows = quality.chunks(text)
        assert b"".join([rows[0].tobytes(), *[r[quality.CHUNK - quality.STEP:].tobytes() for r in rows[1:]]]).rstrip(b"\0") == text


def test_one_call_scores_as_many():
    net = quality.Net.fresh()
    texts = ["a" * k for k in range(0, 3000, 171)]
    assert np.allclose(net.score(texts), [net.score([t])[0] for t in texts])


def test_training_follows_its_gradient():
    """The loss of one batch falls when the network is fitted to it."""
    rng = np.random.default_rng(0)
    examples = [quality.chunks(bytes(rng.integers(97 if k % 2 else 65, 123 if k % 2 else 91, 200).astype(np.uint8))) for k in range(40)]
    labels = np.array([k % 2 for k in range(40)])
    net = quality.fit(examples, labels, steps=120)
    found = np.array([net.combined(net.pooled(x), np.array([0]))[0] for x in examples])
    assert ((found > 0.5) == labels).mean() == 1
