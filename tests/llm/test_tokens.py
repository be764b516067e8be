import hashlib
import zlib
from collections import Counter as Bag

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import awkward, empty, frame

from lociweave.llm import byte_bpe, token_counts, token_file

RANKS, PIECES, WORDS = P.path("byte_bpe_50k.tiktoken"), P.path("piece_bpe_32k.model"), P.path("word_bpe_49k.json")
PARTS = list("abzAZé ÉßΣİ\n\t'.,!$_-0129日😀▁́ ") + ["<|endoftext|>", "'ll", "  ", " the", "ing"]
ALPHABET = st.lists(st.sampled_from(PARTS), max_size=60).map("".join)


@pytest.fixture(scope="module")
def codec():
    return byte_bpe.Codec(byte_bpe.read_ranks(RANKS), P.PATTERN)


@pytest.fixture(scope="module")
def counter():
    return token_counts.Counter(token_counts.read_pieces(open(PIECES, "rb").read()))


@pytest.fixture(scope="module")
def words():
    return token_file.Words(open(WORDS, encoding="utf-8").read())


@settings(max_examples=300, deadline=None)
@given(text=ALPHABET, size=st.integers(1, 30))
def test_pieces_encode_as_the_whole(codec, text, size):
    assert codec.encode(text, size).tolist() == codec.encoder.encode_ordinary(text)
    assert codec.decode(codec.encode(text, size)) == text.encode()


@settings(max_examples=300, deadline=None)
@given(text=ALPHABET)
def test_counts_are_those_of_the_library(counter, text):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    assert counter.count(text) == len(lib.encode(text))


@settings(max_examples=300, deadline=None)
@given(texts=st.lists(ALPHABET, max_size=4))
def test_words_encode_as_the_library(words, texts):
    assert words.apart
    assert words.encode(texts) == [words.library(t).tobytes() for t in texts]


def test_encode_and_decode(spark, codec):
    rows = awkward()
    got = byte_bpe.encode(frame(spark, rows), RANKS, P.PATTERN, decoded=True).collect()
    want = [(i, np.array(codec.encoder.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for i, t in rows]
    assert Bag((r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in got) == Bag(want)
    assert all(r.n_tokens * 4 == len(r.ids) for r in got)
    again = byte_bpe.decode(byte_bpe.encode(frame(spark, rows), RANKS, P.PATTERN), RANKS, P.PATTERN).collect()
    assert Bag((r.doc_id, bytes(r.decoded)) for r in again) == Bag((i, (t or "").encode()) for i, t in rows)
    assert byte_bpe.encode(empty(spark), RANKS, P.PATTERN).count() == 0


def test_token_counts(spark):
    import sentencepiece

    lib, rows = sentencepiece.SentencePieceProcessor(model_file=PIECES), awkward()
    got = token_counts.token_counts(frame(spark, rows), PIECES, limit=100).collect()
    want = [(i, len((t or "").encode()), n := len(lib.encode(t or "")), n > 100) for i, t in rows]
    assert Bag(map(tuple, got)) == Bag(want)
    assert token_counts.token_counts(empty(spark), PIECES).count() == 0


@pytest.mark.parametrize("top", [1, 256, 1 << 16, 1 << 24, 1 << 32])
@pytest.mark.parametrize("n", [0, 1, 3, 4, 5, 257])
def test_packing_round_trip(n, top):
    ranks = np.random.default_rng(n).integers(0, top, n, dtype=np.uint64).astype(np.uint32)
    control, data = token_file.pack(ranks)
    assert len(control) == -(-n // 4) and len(data) == sum(max(1, (int(r).bit_length() + 7) // 8) for r in ranks)
    assert (token_file.unpack(control, data, n, {w: token_file.masks(w) for w in (2, 4)}) == ranks).all()


@pytest.mark.parametrize("block_ids", [1, 1 << 18])
def test_token_files(spark, words, tmp_path, monkeypatch, block_ids):
    monkeypatch.setattr(token_file, "BLOCK_IDS", block_ids)
    rows = awkward()
    token_file.write(frame(spark, rows).repartition(3), str(tmp_path / "f"), WORDS)
    got = token_file.with_starts(spark, str(tmp_path / "f")).orderBy("start").collect()
    want = {(i, tuple(words.library(t or "").tolist()) + (1,)) for i, t in rows}
    assert {(r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in got} == want and len(got) == len(rows)
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
    assert [(-1 if r.doc_id is None else r.doc_id) for r in got] == sorted(-1 if i is None else i for i, _ in rows)
    assert all(r.ids_crc32 == zlib.crc32(r.ids) for r in got)
    ranks = spark.read.parquet(str(tmp_path / "f/vocabulary")).orderBy("rank").collect()
    assert [r.n for r in ranks] == sorted((r.n for r in ranks), reverse=True)


def test_empty_token_file(spark, tmp_path):
    token_file.write(empty(spark), str(tmp_path / "f"), WORDS)
    assert token_file.with_starts(spark, str(tmp_path / "f")).count() == 0


def test_queries_agree_with_the_libraries(spark, codec, words):
    from lociweave.llm import queries

    folder = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in queries.op2_byte_bpe(spark, folder).collect():
        ids = np.array(codec.encoder.encode_ordinary(docs[r.doc_id]), "<u4")
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(docs[r.doc_id].encode()).hexdigest())
    start = 0
    for r in sorted(queries.op8_token_file(spark, folder).collect(), key=lambda r: r.doc_id):
        ids = np.array(words.library(docs[r.doc_id]).tolist() + [1], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_different_words_with_one_polynomial(words):
    """Two letters in Thue-Morse order and its complement: sums over powers of one odd number agree modulo 2 ** 64."""
    order = "0"
    while len(order) < 2048:
        order += order.translate({48: 49, 49: 48})
    pair = [order.translate({48: a, 49: b}) for a, b in ("ab", "ba")]
    assert len(set(pair)) == 2
    texts = [" ".join(pair), *pair, f"x {pair[1]} y"]
    assert words.encode(texts) == [words.library(t).tobytes() for t in texts]


def test_words_with_equal_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(token_file, "word_hashes", lambda data, starts, ends: (ends - starts).astype(np.uint64))
    words = token_file.Words(open(WORDS, encoding="utf-8").read())
    for texts in (["one two cat", "dog"], ["six", "three"], ["one", "dog two"]):
        assert words.encode(texts) == [words.library(t).tobytes() for t in texts]


def test_case_sensitive_vocabulary():
    import json

    file = json.load(open(WORDS, encoding="utf-8"))
    steps = file["normalizer"]["normalizers"]
    file["normalizer"]["normalizers"] = [s for s in steps if s["type"] != "Lowercase"]
    words = token_file.Words(json.dumps(file))
    assert len(steps) > len(file["normalizer"]["normalizers"]) and not words.folds
    texts = ["Some CAPITAL letters", "É à ß"]
    assert words.encode(texts) == [words.library(t).tobytes() for t in texts] != [words.library(t.lower()).tobytes() for t in texts]
