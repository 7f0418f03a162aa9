"""Benchmark decontamination: the filter loses no alignment, planted passages are found, clean texts are left."""

import random

import numpy as np

from pitpanel.llm import decontaminate as dc
from pitpanel.llm import queries


def edits(pattern, text):
    """Least edit distance of the pattern to any part of the text."""
    row = np.zeros(len(text) + 1, int)
    for i, p in enumerate(pattern, 1):
        new = np.empty_like(row)
        new[0] = i
        for j, t in enumerate(text, 1):
            new[j] = min(row[j - 1] + (p != t), row[j] + 1, new[j - 1] + 1)
        row = new
    return int(row.min())


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghijkl") for _ in range(rng.randint(2, 8))) for _ in range(n))


def damaged(rng, text, n):
    chars = list(text)
    for _ in range(n):
        at = rng.randrange(len(chars))
        kind = rng.randrange(3)
        chars[at : at + 1] = [] if kind == 0 else [rng.choice("xyz")] if kind == 1 else [chars[at], rng.choice("xyz")]
    return "".join(chars)


def test_every_alignment_within_the_budget_is_found():
    rng = random.Random(7)
    items = [words(rng, n) for n in (6, 9, 12, 20, 40)]
    parts = [(k, start, s) for k, item in enumerate(items) for start, s in dc.segments(dc.normalize(item))]
    block = dc.Block(*map(list, zip(*parts)))
    for trial in range(60):
        item = rng.randrange(5)
        text = f"{words(rng, rng.randint(0, 30))} {damaged(rng, items[item], rng.randint(0, 12))} {words(rng, rng.randint(0, 30))}"
        got = {(i, s): e for i, s, _, e in block.matches([text])[0]}
        plain = dc.normalize(text)
        for i, start, s in parts:
            best = edits(s, plain)
            assert got.get((i, start)) == (best if best <= dc.budget(len(s)) else None), (trial, i, start)


def index(items):
    return dc.Block(*map(list, zip(*[(k, start, s) for k, item in enumerate(items) for start, s in dc.segments(dc.normalize(item))])))


def test_passages_cut_anywhere_are_found():
    rng = random.Random(11)
    items = [words(rng, n) for n in (14, 20, 33, 60, 150)] + [" ".join("".join(rng.choice("abcdef") for _ in range(rng.randint(1, 25))) for _ in range(60))]
    block = index(items)
    for trial in range(300):
        item = rng.randrange(len(items))
        w = items[item].split()
        n = rng.randint(13, min(len(w), 20))
        at = rng.randint(0, len(w) - n)
        passage = " ".join(w[at : at + n])
        if n == 13 and len(passage) <= dc.SEGMENT and trial % 2:
            passage = damaged(rng, passage, dc.budget(len(passage) - 1))
        text = f"{words(rng, rng.randint(40, 60))} {passage} {words(rng, rng.randint(40, 60))}"
        assert item in {i for i, *_ in block.matches([text])[0]}, (trial, passage)


def test_passages_of_scripts_without_spaces_are_found():
    rng = random.Random(12)
    item = "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(400))
    block = index([item])
    for _ in range(100):
        at = rng.randint(0, 400 - 44)
        other = "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(50))
        assert block.matches([other + item[at : at + 44] + other])[0] and not block.matches([other + other])[0]


def test_damaged_passages_belong_to_the_text_they_begin():
    rng = random.Random(13)
    items = [words(rng, n) for n in (9, 12, 20, 40)]
    block = index(items)
    for trial in range(40):
        texts, want = [], []
        for _ in range(12):
            item = rng.randrange(len(items))
            chars = list(items[item])
            cut = rng.randint(1, min(4, dc.budget(len(chars)) // 2))  # a space may go with each letter
            for _ in range(cut):  # letters missing at the start, or anywhere near it
                del chars[0 if trial % 2 else rng.randrange(40)]
            clean = rng.randint(0, 1)
            texts.append(words(rng, 30) if clean else "".join(chars) + " " + words(rng, rng.randint(0, 9)))
            want.append(set() if clean else {item})
        texts.insert(0, None)
        want.insert(0, set())
        found = block.matches(texts)
        assert found == [block.matches([t])[0] for t in texts], trial
        for row, text, items_wanted in zip(found, texts, want):
            assert {i for i, *_ in row} == items_wanted, (trial, text)
            assert all(0 <= place < len(dc.normalize(text)) for _, _, place, _ in row)


def test_rows(spark):
    rng = random.Random(1)
    items = [(1, words(rng, 30)), (1, words(rng, 30)), (2, None), (3, "too short"), (None, words(rng, 25))]
    items.append(items[0])
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = [(1, words(rng, 50), "a"), (2, f"{words(rng, 9)}\n{items[0][1].upper()}! {words(rng, 9)}", "b"), (3, None, "c"), (4, "", "d"), (None, items[4][1], "e"), (2, items[1][1], "f"),
            (7, "too short", "g"), (8, words(rng, 400_000) + " " + items[0][1], "h")]
    df = spark.createDataFrame(docs, "doc_id long, text string, item_id string")
    assert sorted(r["item_id"] for r in dc.clean(df, bench).collect()) == ["a", "c", "d", "g"]
    found = {r["item_id"]: {m["item_id"] for m in r["benchmark_matches"]} for r in dc.find(df, bench).collect()}
    assert found["b"] == {1} and found["e"] == {None} and found["h"] == {1}
    assert dc.clean(df, bench.limit(0)).count() == len(docs) and dc.clean(df.limit(0), bench).count() == 0


def test_blocks_give_the_same_result(spark, monkeypatch):
    rng = random.Random(2)
    items = [(k, words(rng, 25)) for k in range(30)]
    docs = [(k, f"{words(rng, 20)} {items[k][1]} {words(rng, 5)}") for k in range(30)] + [(100 + k, words(rng, 60)) for k in range(20)]
    bench, df = spark.createDataFrame(items, "item_id long, text string"), spark.createDataFrame(docs, "doc_id long, text string")
    monkeypatch.setattr(dc, "BLOCK_CHARS", 1000)
    assert len(list(dc.blocks(bench))) > 2
    assert {r["doc_id"]: [m["item_id"] for m in r["benchmark_matches"]][:1] for r in dc.find(df, bench).collect()} == {i: [i] if i < 100 else [] for i, _ in docs}


def test_items_that_share_a_stem_take_no_time_of_their_own():
    import time

    rng = random.Random(21)
    stem = "which of the following statements about the matter in hand is the only one that is true"
    items = [f"{stem} {words(rng, 25)}" for _ in range(1000)]
    block = index(items)
    text = " ".join(f"{stem} {words(rng, 4)}" for _ in range(20))
    start = time.time()
    found = block.matches([text, f"{words(rng, 20)} {items[77]} {words(rng, 5)}"])
    took = time.time() - start
    plain = dc.normalize(text)
    for item, at, _, n in found[0]:  # the stem itself is part of every item
        pattern = next(s for i, b, s in zip(block.items, block.starts, block.segments) if (i, b) == (item, at))
        assert edits(pattern, plain) == n
        break
    assert 77 in {i for i, *_ in found[1]} and took < 60, took


def test_short_items_are_told_apart(spark):
    bench = spark.createDataFrame([(1, "Too short!"), (2, "yes"), (None, "yes"), (3, "  "), (4, "a b")], "item_id long, text string")
    df = spark.createDataFrame([(1, "This is too SHORT, yes."), (2, "tooshort yesterday a  b"), (3, None), (4, "")], "doc_id long, text string")
    found = {r["doc_id"]: sorted((str(m["item_id"]), m["place"]) for m in r["benchmark_short_matches"]) for r in dc.find(df, bench).collect()}
    assert found == {1: [("1", 8), ("2", 18), ("None", 18)], 2: [("4", 19)], 3: [], 4: []}
    assert dc.clean(df, bench).count() == 4


def test_query(spark, small):
    bench = {r["item_id"]: dc.normalize(r["text"]) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()}
    docs = {r["doc_id"]: dc.normalize(r["text"] or "") for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    whole = {(d, i) for d, text in docs.items() for i, item in bench.items() if item in text}
    got = {(r["doc_id"], r["item_id"]) for r in queries.op3_benchmark_decontamination(spark, small).collect()}
    assert whole <= got
    for d, i in got:
        assert any(edits(s, docs[d]) <= dc.budget(len(s)) for _, s in dc.segments(bench[i]))
