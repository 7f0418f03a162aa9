"""Token alignment against plain byte lists and all pairs of tokens."""

import hashlib
import random
from bisect import bisect_left
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from pitpanel.llm import crosstoken, queries

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def byte_of():
    """Letters of byte-level tokens, as published: bytes that print stand for themselves."""
    bs = list(range(ord("!"), ord("~") + 1)) + list(range(ord("¡"), ord("¬") + 1)) + list(range(ord("®"), ord("ÿ") + 1))
    cs, n = bs[:], 0
    for b in range(256):
        if b not in bs:
            bs.append(b)
            cs.append(256 + n)
            n += 1
    return dict(zip(map(chr, cs), bs))


class Plain:
    def __init__(self):
        self.a, self.b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
        self.a.encode_special_tokens = True
        self.letters = byte_of()

    def tokens(self, text):
        """[(id, begin, end)] of A and of B."""
        if not text:
            return None
        out = []
        ids = self.a.encode(" " + text, add_special_tokens=False).ids
        out.append([(i, bytes(self.letters[c] for c in self.a.id_to_token(i))) for i in ids])
        ids = self.b.encode(text)
        out.append([(i, bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()) for i, p in zip(ids, map(self.b.id_to_piece, ids))])
        placed = []
        for tokens in out:
            if b"".join(x for _, x in tokens) != (" " + text).encode():
                return None
            at, spans = 0, []
            for i, x in tokens:
                spans.append((i, at, at + len(x)))
                at += len(x)
            placed.append(spans)
        return placed

    def table(self, texts):
        links, rows, counts = [], [], Counter()
        for text in texts:
            placed = self.tokens(text)
            if placed is None:
                links.append([])
                rows.append((0, 0, 0, 0, ""))
                continue
            a, b = placed
            found = [(i, j) for i, s, e in a for j, t, f in b if max(s, t) < min(e, f)] if len(a) < 300 else None
            if found is None:  # the same by a sweep, for long texts
                found, k = [], 0
                for i, s, e in a:
                    while b[k][2] <= s:
                        k += 1
                    m = k
                    while m < len(b) and b[m][1] < e:
                        found.append((i, b[m][0]))
                        m += 1
            links.append(found)
            counts.update(found)
            cuts = sorted({e for *_, e in a} & {e for *_, e in b})
            where = lambda tokens: [bisect_left(cuts, e) for *_, e in tokens]
            ga, gb = where(a), where(b)
            sides = [[[] for _ in cuts] for _ in "ab"]
            for side, tokens, group in zip(sides, (a, b), (ga, gb)):
                for x, g in zip(tokens, group):
                    side[g].append(str(x[0]))
            parts = [",".join(x) + "|" + ",".join(y) for x, y in zip(*sides)]
            rows.append((len(a), len(b), len(cuts), len(found), hashlib.sha256(";".join(parts).encode()).hexdigest() if parts else None))
        best = defaultdict(int)
        for (_, j), n in counts.items():
            best[j] = max(best[j], n)
        return [(*row[:4], sum(counts[x] == best[x[1]] for x in found), sum(counts[x] for x in found), row[4]) for row, found in zip(rows, links)]


@pytest.fixture(scope="module")
def plain():
    return Plain()


ODD = [
    None, "", " ", "a", "é漢𝔘 a  b", "汉字漢字 ひらがな 한국어", "👩‍👩‍👧‍👦 🏳️‍🌈 ok", "<|endoftext|> and </s> <s> <unk> <0x41>", "tabs\tand\nlines\r\n  x ", "has ▁ in it", "▁", "zero\x00byte \x01\x7f",
    "  leading", "é combining", "ﬁ ligature ① ½", "nbsp here", "𐍈𐍉", "naïve café über groß", "a" * 3000, "don't we'll I've", "﻿bom", "é" * 500 + "x" * 20 + "漢" * 100,
]


def rows_of(df):
    return {r["doc_id"]: tuple(r[c] for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")) for r in df.collect()}


def test_odd_texts(spark, plain):
    dice = random.Random(2)
    texts = ODD + ["".join(dice.choices(["a", "the", " ", "é", "漢", "\n", "𝔘", "ing", "1", "'s", "▁", "."], k=30)) for _ in range(200)] + ["a the a"] * 5
    df = spark.createDataFrame([(k, t, "x", "y", 3) for k, t in enumerate(texts)], "doc_id long, text string, id string, groups string, row int")
    assert rows_of(crosstoken.score(df, A, B)) == dict(enumerate(plain.table(texts)))


def test_rare_pairs_go_through_the_join(spark, plain, monkeypatch):
    monkeypatch.setattr(crosstoken, "HEAD", 10)
    texts = ["the cat sat on the mat", "the dog über alles", "the the the", "", "rare wörds öccur hère"] * 2
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = dict(enumerate(plain.table(texts)))
    assert rows_of(crosstoken.score(df, A, B)) == want
    monkeypatch.setattr(crosstoken, "HEAD", 0)
    assert rows_of(crosstoken.score(df, A, B)) == want


def test_words_alone_give_what_the_whole_text_gives(plain, monkeypatch):
    dice = random.Random(4)
    tokenizers = crosstoken.loaded(A, B)
    assert tokenizers.divisible
    for bits in (["word", "it's", "über", "漢字", "x1", "\n", "", "and", "</s>", "(a)", "\u00a0", "e\u0301", "\u0301", "\t", "'s", "don't", "99", "…"], ["the", "of", "-", "a.b", "\x1f", "y" * 90]):
        for sep in (" ", "  ", ""):
            for _ in range(60):
                text = sep.join(dice.choices(bits, k=12)) + dice.choice(["", " ", "\n"])
                whole, words = tokenizers.entries([text])[0], tokenizers.words(text)
                tokenizers.remember([words])
                n_a, n_b, n_groups, groups, links = tokenizers.aligned(words)
                assert (n_a, n_b, n_groups, ";" + groups, links.tobytes()) == whole, text
    monkeypatch.setattr(crosstoken, "REMEMBERED", 3)
    for text in ("one two three four five", "six seven one two", "x" * 70 + " one"):
        words = tokenizers.words(text)
        tokenizers.remember([words])
        assert tokenizers.aligned(words)[:3] == tokenizers.entries([text])[0][:3]
    assert len(tokenizers.known) + len(tokenizers.older) <= 10


def test_cuts_come_from_both_reports():
    import numpy as np

    # a character of three bytes in three tokens, whose coarse spans are the whole character, then a certain one
    assert crosstoken.refined(np.array([[0, 1], [1, 4], [1, 4], [1, 4], [4, 6]]), np.array([1, 1, 1, 1, 2])).tolist() == [1, 2, 3, 4, 6]
    assert crosstoken.refined(np.array([[0, 1], [1, 1], [1, 1], [1, 4]]), np.array([1, 1, 1, 1])).tolist() == [1, 2, 3, 4]
    assert crosstoken.refined(np.zeros((0, 2), int), np.zeros(0, int)).tolist() == []


def test_groups_in_full_and_empty_table(spark):
    df = spark.createDataFrame([(None, "hello world"), (None, None)], "doc_id string, text string")
    out = sorted(crosstoken.align(df, A, B, with_groups=True).collect(), key=lambda r: r["n_a"])
    assert out[0]["groups"] == "" and hashlib.sha256(out[1]["groups"].encode()).hexdigest() == out[1]["groups_sha256"]
    assert out[1]["groups"].count("|") == out[1]["n_groups"] == out[1]["groups"].count(";") + 1
    assert crosstoken.score(df.limit(0), A, B).count() == 0
    assert [r["doc_id"] for r in crosstoken.score(df, A, B).collect()] == [None, None]


def test_query(spark, small, plain):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    got, want = rows_of(queries.op12_token_alignment(spark, small)), plain.table([d["text"] for d in docs])
    for d, row in zip(docs, want):
        assert got[d["doc_id"]][:6] == row[:6]
        assert row[6] is None or got[d["doc_id"]][6] == row[6]


def test_no_places_are_asked_for_in_ascii_text(monkeypatch):
    tokenizers = crosstoken.Tokenizers(A, B)
    text = "plain <|endoftext|> text\twith  some 123 words don't " * 3
    ids = tokenizers.a.encode(" " + text, add_special_tokens=False).ids

    class Without:
        encode_batch_fast = tokenizers.a.encode_batch_fast

    monkeypatch.setattr(tokenizers, "a", Without())
    a, a_end, _, b_end = tokenizers.coded(text)
    assert a.tolist() == ids and a_end[-1] == b_end[-1] == 1 + len(text)
    with pytest.raises(AttributeError):
        tokenizers.coded("über")
