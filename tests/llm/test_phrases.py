"""Phrases against plain counting."""

import re
from collections import Counter, defaultdict

import pytest

from tableflow.llm import phrases


def plain(rows, least, top, longest=5, covered=100):
    """All of it by dictionaries."""
    counts, words = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            found = re.findall("[^\x20\x09]+", piece)
            words[lang] += len(found)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(found[i:i + k]) for i in range(len(found) - k + 1))
    out = set()
    for lang, each in counts.items():
        candidates = {p: a for p, a in each.items() if len(p) > 1 and a >= least}
        inside = defaultdict(int)
        for p, a in candidates.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inside[p[i:i + k]] = max(inside[p[i:i + k]], a)
        scored = []
        for p, a in candidates.items():
            if inside[p] * 100 >= a * covered:
                continue
            cuts = [(1000 * a * words[lang] // (each[p[:k]] * each[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(p).encode(), each[p[:k]], each[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.add((lang, rank, phrase.decode(), -a, left, right, words[lang], -score))
    return out


def found(docs, **how):
    df = phrases.collocations(docs, **how)
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize(("least", "top"), [(5, 2000), (8, 7), (100, 2000)])
def test_given_documents(spark, least, top):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.lang, r.text) for r in docs.collect()]
    wanted = plain(rows, least, top)
    assert wanted and found(docs.repartition(5), least=least, top=top) == wanted


def test_edges(spark):
    odd = "a b\x01 a b c a b c a\x0bb a\tb  A B naïve İ é a b naïve İ é. a b;c a b"
    rows = [("x", odd)] * 3 + [(None, odd), (None, None), ("x", ""), ("y", " \t\n"), ("y", "word " * 20_000), ("x", "a b c")]
    docs = spark.createDataFrame([(1, *r, "z", 5, None) for r in rows], "k int, lang string, text string, phrase string, f int, words string")
    for covered in (100, 50):
        assert found(docs, least=2, covered=covered) == plain(rows, 2, 2000, covered=covered)


def test_nothing(spark, no_docs):
    assert not found(no_docs.selectExpr("*", "text AS lang"))
    assert not found(spark.createDataFrame([("a b",), (None,)], "text string").selectExpr("text", "text AS lang"))


def test_filter_errors_change_nothing(spark, monkeypatch):
    """A filter that lets everything pass, as a very full one does, gives the same."""
    rows = [("en", "a b c d e f a b c d"), ("en", "b c d a b c"), ("de", "a b c d")] * 4
    docs = spark.createDataFrame(rows, "lang string, text string")
    wanted = plain(rows, 6, 2000)
    assert found(docs, least=6) == wanted
    full = phrases.np.full((1 << phrases.FILTER_BITS) // 8, 255, phrases.np.uint8)
    monkeypatch.setattr(phrases, "_pair_filter", lambda docs, least: full)
    assert found(docs, least=6) == wanted


def test_products_beyond_64_bits(spark):
    big = 4_000_000_000_000
    shape = "lang string, phrase string, k int, f long"
    counts = spark.createDataFrame([("en", "a", 1, big), ("en", "b", 1, big - 1), ("en", "a b", 2, big - 7)], shape)
    n = 3 * big
    row = phrases.estimated(counts, spark.createDataFrame([("en", n)], "lang string, n long")).first()
    assert (row.a, row.l, row.r, row.n, row.score) == (big - 7, big, big - 1, n, 1000 * (big - 7) * n // (big * (big - 1)))
