"""Byte-level BPE against the tiktoken library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from pitpanel.llm import bpe, queries


@pytest.fixture(scope="module")
def both():
    own = queries.vocabulary()
    return own, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})


def ids(own, text):
    return np.frombuffer(own.encode(text), "<u4").tolist()


def test_texts(both):
    own, reference = both
    rng = random.Random(2)
    letters = "aábcdeé 12'st\n\t  .,-😀日本語ß  \x1c\x1f\x85́ﬁ"
    texts = ["", " ", "it's they'll  x", "a" * 3000, "\n" * 500, "🏳️‍🌈" * 40, "<|endoftext|>", "Ω≈ç√ 123456789"]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randint(1, 80))) for _ in range(600)]
    for text in texts:
        assert ids(own, text) == reference.encode_ordinary(text), repr(text)
        assert own.decode(own.encode(text)).decode("utf-8") == text


def test_long_text_in_pieces(both, monkeypatch):
    own, reference = both
    rng = random.Random(4)
    text = " ".join("".join(rng.choice("abcdé'.") for _ in range(rng.randint(0, 9))) for _ in range(2000))
    monkeypatch.setattr(bpe, "PIECE", 100)
    assert ids(own, text) == reference.encode_ordinary(text)
    assert own.decode(own.encode(text)).decode("utf-8") == text


def test_merge_agrees_with_whole_entries(both):
    own, reference = both
    for piece in list(own.ranks)[::97]:
        assert own.merge(piece) == reference._encode_single_piece(piece) or own.ranks[piece] in reference._encode_single_piece(piece)


def test_perfect_hash_is_minimal_and_perfect():
    keys = np.random.default_rng(1).integers(0, 2**63, 5000).astype(np.uint64)
    keys = np.unique(keys)
    assert sorted(bpe.PerfectHash(keys).slots(keys).tolist()) == list(range(len(keys)))
    assert len(bpe.PerfectHash(keys[:0]).slots(keys)) == len(keys)


def test_rows(spark, both):
    own, _ = both
    df = spark.createDataFrame([(1, "hello world"), (1, "hello world"), (2, None), (None, "")], "doc_id long, text string")
    rows = bpe.encode_documents(df, own).collect()
    assert len(rows) == 4 and all(bytes(r["decoded"]) == (b"hello world" if r["doc_id"] == 1 else b"") for r in rows)
    assert bpe.encode_documents(df.limit(0), own).count() == 0


def test_query(spark, small, both):
    _, reference = both
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    for r in queries.op4_byte_bpe(spark, small).collect():
        want = reference.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(want)
        assert r["ids_sha256"] == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode("utf-8")).hexdigest()


def test_pre_tokens_merged_side_by_side(both):
    own, reference = both
    rng = random.Random(9)
    pieces = ["".join(rng.choice("abcdeést日😀") for _ in range(rng.randint(1, 12))).encode()[: bpe.SHORT] for _ in range(3000)]
    for piece, got in zip(pieces, own.merge_many(pieces)):
        assert np.frombuffer(got, "<u4").tolist() == own.merge(piece), piece
    texts = ["".join(rng.choice("abé 's\n.12") for _ in range(rng.randint(0, 200))) for _ in range(300)] + ["x" * (bpe.PIECE + 5), ""]
    assert [np.frombuffer(x, "<u4").tolist() for x in own.encode_many(texts)] == [reference.encode_ordinary(t) for t in texts]
