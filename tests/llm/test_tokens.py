"""Token ids, packing and files against the tokenizers library; counts against a plain greedy cut."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tableflow.llm import bpe, packing, rans, tokenfile, wordpiece
from tableflow.llm.common import WordTokens
from tableflow.session import fresh_path

BYTES, WORDS = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
MERGES = bpe.MergeList(BYTES)
LIBRARY = Tokenizer.from_file(BYTES)


def u32(ids):
    return np.array(ids, "<u4").tobytes()


def keyed(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r))


# ---- byte-level BPE ------------------------------------------------------------------


def test_digests_equal_the_library(edge_docs):
    got = keyed(map(tuple, bpe.digests(edge_docs, BYTES).collect()))
    expected = []
    for row in edge_docs.collect():
        ids = LIBRARY.encode(row.text or "", add_special_tokens=False).ids
        text = LIBRARY.decode(ids, skip_special_tokens=False)
        expected.append((row.doc_id, len(ids), hashlib.sha256(u32(ids)).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert got == keyed(expected)


def test_round_trip(edge_docs, no_docs):
    back = bpe.decode(bpe.encode(edge_docs, BYTES), BYTES)
    assert keyed(map(tuple, back.collect())) == keyed((r.doc_id, r.text or "") for r in edge_docs.collect())
    assert bpe.digests(no_docs, BYTES).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab'srevd \n\tlm1é!日 ", max_size=80), st.integers(1, 9), st.integers(1, 7))
def test_a_text_in_parts_has_the_same_tokens(text, size, chunk):
    encoder, out = bpe.Encoder(MERGES), []
    before, bpe.CHUNK = bpe.CHUNK, chunk
    long, bpe.LONG = bpe.LONG, 2
    try:
        for at in range(0, len(text), size):
            out += encoder.feed(text[at:at + size])
        out += encoder.close()
    finally:
        bpe.CHUNK, bpe.LONG = before, long
    assert out == LIBRARY.encode(text, add_special_tokens=False).ids


def test_a_long_word_is_emitted_with_bounded_memory():
    rng = random.Random(7)
    for _ in range(10):
        word = "".join(rng.choice("abetionhrsdlg") for _ in range(9_000)).encode()
        stream, out, most, at = bpe.WordStream(MERGES), [], 0, 0
        while at < len(word):
            step = rng.randrange(1, 500)
            out += stream.feed(word[at:at + step])
            most, at = max(most, len(stream.held)), at + step
        assert out + stream.close() == LIBRARY.encode(word.decode(), add_special_tokens=False).ids
        assert most <= 3 * MERGES.window + bpe.LONG


def test_no_text_behind_a_token_changes_it_beyond_its_lookahead():
    rng = random.Random(1)
    for _ in range(400):
        word = bytes(rng.choice(b"eathino rs") for _ in range(rng.randrange(1, 40))).replace(b" ", b"")
        ids = MERGES.merge(word)
        for _ in range(20):
            other = MERGES.merge(word + bytes(rng.choice(b"eathinors") for _ in range(rng.randrange(1, 12))))
            end = 0
            for k, token in enumerate(ids):
                end += len(MERGES.bytes_of[token])
                if len(word) - end < MERGES.lookahead[token]:
                    break
                assert other[k] == token


def test_decoding_in_parts_keeps_characters_whole():
    ids = LIBRARY.encode("héllo 日本 🙂", add_special_tokens=False).ids
    decoder = bpe.Decoder(MERGES)
    assert "".join(decoder.feed([i]) for i in ids) + decoder.close() == "héllo 日本 🙂"
    broken = bpe.Decoder(MERGES)
    assert broken.feed([MERGES.byte_ids[0xE6]]) + broken.close() == LIBRARY.decode([MERGES.byte_ids[0xE6]], skip_special_tokens=False)


# ---- words ---------------------------------------------------------------------------


def test_word_tokens_equal_the_library():
    library, words = Tokenizer.from_file(WORDS), WordTokens(WORDS)
    rng = random.Random(2)
    texts = ["".join(rng.choice("abC'srvd \n\t1é!日½ÿß\x1c") for _ in range(rng.randrange(40))) for _ in range(1500)]
    texts += ["", "Don't 'S it'LL", "<|startoftext|> a", "ΑΣ İ"]
    for _ in range(2):
        for text, ids in zip(texts, words.encode(texts), strict=True):
            assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, text


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(min_size=2, max_size=6).map(lambda b: bytes(x % 3 for x in b)), max_size=12),
       st.binary(max_size=25).map(lambda b: bytes(x % 4 for x in b)))
def test_counts_equal_a_greedy_cut(pieces, word):
    known = {bytes([b]) for b in range(256)} | set(pieces)
    at = count = 0
    while at < len(word):
        at = max(z for z in range(at + 1, len(word) + 1) if word[at:z] in known)
        count += 1
    assert wordpiece.Automaton(sorted(known)).count(word) == count


def test_counts_of_documents(edge_docs, no_docs):
    got = {r.doc_id: (r.n_words, r.n_pieces) for r in wordpiece.count_pieces(edge_docs, BYTES).collect() if r.doc_id}
    assert got[1] == (5, 5) and got[2] == got[3] == got[6] == (0, 0) and got[4][0] == 30_001
    assert wordpiece.count_pieces(edge_docs, BYTES).count() == edge_docs.count()
    assert wordpiece.count_pieces(no_docs, BYTES).count() == 0


# ---- packing -------------------------------------------------------------------------


def check_packing(rows, capacity):
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_pieces_and_packing(edge_docs, no_docs):
    pieces = packing.cut_pieces(edge_docs, WORDS, end_id=1, capacity=64)
    rows = packing.pack(pieces, capacity=64, carry=4, fan_in=2, block=50).collect()
    library = Tokenizer.from_file(WORDS)
    expected = []
    for row in edge_docs.collect():
        ids = library.encode(row.text or "", add_special_tokens=False).ids + [1]
        expected += [(row.doc_id, k, at, len(ids[at:at + 64]), zlib.crc32(u32(ids[at:at + 64])))
                     for k, at in enumerate(range(0, len(ids), 64))]
    assert keyed((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == keyed(expected)
    check_packing(rows, 64)
    assert packing.pack(packing.cut_pieces(no_docs, WORDS, end_id=1)).count() == 0


def test_packing_is_tight_over_many_partitions(spark):
    rows = spark.range(20_000).selectExpr("id", "int(pmod(hash(id), 900)) + 1 AS length").repartition(13)
    packed = packing.pack(rows, capacity=1000, carry=20, fan_in=3).collect()
    assert sorted(r.id for r in packed) == list(range(20_000))
    assert check_packing(packed, 1000) <= 1.01 * sum(r.length for r in packed) / 1000 + 1


def test_best_fit_is_best_fit():
    rng = random.Random(3)
    for _ in range(50):
        sizes = [rng.randrange(1, 30) for _ in range(60)]
        room: list[int] = []
        for size in sorted(sizes, reverse=True):
            fitting = [k for k, r in enumerate(room) if r >= size]
            if fitting:
                room[min(fitting, key=lambda k: room[k])] -= size
            else:
                room.append(40 - size)
        assert packing.best_fit(np.array(sizes), 40).max() + 1 == len(room)


def test_packing_does_not_depend_on_the_order(spark):
    lengths = [2500] * 4000 + [1500] * 4000  # in order: one partition of long pieces, one of short ones
    rows = spark.createDataFrame(list(enumerate(lengths)), "id long, length long").repartitionByRange(2, "id")
    packed = packing.pack(rows).collect()
    assert sorted(r.id for r in packed) == list(range(8000))
    assert check_packing(packed, 4096) <= 1.05 * 4000


def test_pieces_that_cannot_be_packed_fail(spark):
    for length in ("null", "-1", "11"):
        with pytest.raises(Exception, match="a piece must hold"):
            packing.pack(spark.sql(f"SELECT 1 AS id, CAST({length} AS INT) AS length"), capacity=10).collect()
    with pytest.raises(ValueError, match="there already"):
        packing.pack(spark.sql("SELECT 1 AS length, 2 AS offset"))


# ---- files ---------------------------------------------------------------------------


def test_files_give_back_all_ids(spark, edge_docs):
    library, target = Tokenizer.from_file(WORDS), fresh_path(spark, "tokens")
    tokenfile.write_tokens(edge_docs, target, WORDS, end_id=2, block_ids=1000)
    docs = sorted(((r.doc_id, u32(library.encode(r.text or "", add_special_tokens=False).ids + [2])) for r in edge_docs.collect()),
                  key=lambda x: (x[0] is not None, x))
    expected, start = [], 0
    for doc, ids in docs:
        expected.append((doc, start, len(ids) // 4, zlib.crc32(ids)))
        start += len(ids) // 4
    got = [tuple(r) for r in tokenfile.read_digests(spark, target).orderBy("start").collect()]
    assert [(d, n) for d, _, n, _ in got] == [(d, n) for d, _, n, _ in expected]
    assert [r[1] for r in got] == [r[1] for r in expected]
    assert keyed((d, n, c) for d, _, n, c in got) == keyed((d, n, c) for d, _, n, c in expected)
    parts = tokenfile.read_parts(spark, target, with_ids=True).orderBy("shard", "block", "before").collect()
    assert b"".join(bytes(r.ids) for r in parts if r.doc_id == 4) == next(ids for d, ids in docs if d == 4)


def test_no_documents_give_empty_files(spark, no_docs):
    target = fresh_path(spark, "tokens")
    tokenfile.write_tokens(no_docs, target, WORDS, end_id=2)
    assert tokenfile.read_digests(spark, target).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 40), max_size=400), st.integers(1, 9), st.integers(1, 5), st.data())
def test_blocks_decode_from_any_place(ids, lanes, every, data):
    ids = np.array(ids, np.uint32)
    table = rans.Table(rans.frequencies(np.bincount(ids, minlength=41)))
    block = rans.encode_block(ids, table, lanes, every)
    assert rans.decode_block(block, table).tolist() == ids.tolist()
    first = data.draw(st.integers(0, len(ids)))
    last = data.draw(st.integers(first, len(ids)))
    assert rans.decode_block(block, table, first, last).tolist() == ids[first:last].tolist()


def test_tables_keep_rare_ids_and_blocks_notice_damage():
    counts = np.array([10 ** 9, 1, 0, 3, 10 ** 7] + [1] * 5000)
    freq = rans.frequencies(counts)
    assert freq.sum() == 1 << rans.SCALE and ((freq > 0) == (counts > 0)).all()
    table = rans.Table(freq)
    block = rans.encode_block(np.array([0, 1, 3, 4] * 5000), table)
    block.words = bytes([block.words[0] ^ 1]) + block.words[1:]
    with pytest.raises(ValueError, match="damaged"):
        rans.decode_block(block, table)


@given(st.binary(max_size=50), st.binary(max_size=50))
def test_crc_of_joined_parts(a, b):
    assert tokenfile.crc32_combine(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)
