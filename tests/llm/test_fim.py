"""Fill-in-middle against plain tokens of a regular expression."""

import hashlib
import random
import re

import pytest

from tableflow.llm import fim

TOKEN = re.compile("[A-Za-z]+|[^A-Za-z]")


def plain(doc_id, text):
    tokens = TOKEN.findall(text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k:8 * k + 8], 16) for k in range(4))
    n = len(tokens)
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if h4 % 100 < 20:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def check(docs):
    rows = fim.restored(fim.fill_in_middle(docs)).collect()
    key = lambda r: tuple((x is not None, x) for x in r)
    wanted = sorted((plain(r.doc_id, r.text or "") for r in docs.collect()), key=key)
    assert sorted((tuple(r)[:6] for r in rows), key=key) == wanted
    assert all(r.restored == plain(r.doc_id, r.output)[5] if r.form == "plain" else True for r in rows)
    texts = {(r.doc_id, r.text or "") for r in docs.collect()}
    assert {(r.doc_id, r.restored) for r in rows} == texts
    return rows


def test_given_documents(spark):
    rows = check(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    assert {r.form for r in rows} == {"plain", "psm", "spm"}


def test_edges(spark, edge_docs):
    check(edge_docs)
    made = random.Random(3)
    texts = ["".join(made.choices("abZ \n<>éß日😀.", k=n)) for n in [0, 1, 2, 3, 40, 700] * 40]
    texts += ["x" * 70_000, "\u0301" * 5_000, "<<S>", "a<P>b", "<", "é" * 3_000 + "word"]
    check(spark.createDataFrame([(k % 50, t) for k, t in enumerate(texts)], "doc_id long, text string"))


def test_nothing(no_docs):
    assert fim.fill_in_middle(no_docs).collect() == []


@pytest.mark.parametrize("size", [0, 1, 15, 16, 17, 5_000])
def test_borders(size, monkeypatch):
    data = random.Random(size).randbytes(size)
    whole = fim.borders(data)
    assert whole[-1] == size and whole == sorted(set(whole))
    monkeypatch.setattr(fim, "SEGMENT", 100)
    assert fim.borders(data) == whole
    # The same passage has the same borders wherever it lies, but for a window at its start.
    shifted = {x - 77 for x in fim.borders(b"q" * 77 + data)}
    assert {x for x in whole[:-1] if x >= fim.WINDOW} <= shifted


def test_shared_chunks_are_counted_once():
    text, chunks = " ".join(random.Random(1).choices(["river", "stone", "hill", "a"], k=3_000)), fim.Chunks()
    fim.rearrange(1, text, chunks)
    first = chunks.reused
    fim.rearrange(2, "another start " + text + " another end", chunks)
    assert chunks.reused - first >= 0.9 * len(fim.borders(text.encode())) - 3


def test_equal_names_of_other_chunks(monkeypatch):
    """A chunk whose hash was met before is compared by its bytes."""
    monkeypatch.setattr(fim.xxhash, "xxh3_64_intdigest", lambda data: 7)
    chunks = fim.Chunks()
    for text in ("some words here", "1 2 3 4", "some words here"):
        assert len(fim.Tokens(text.encode(), chunks)) == len(TOKEN.findall(text))
