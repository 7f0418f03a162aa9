"""The n-gram Jaccard join against all pairs."""

import random
import re

from pitpanel.llm import queries, setjoin


def grams(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    return {tuple(words[k : k + 3]) for k in range(max(1, len(words) - 2))} if words else set()


def brute(docs, percent=90):
    sets = {i: grams(t) for i, t in docs}
    label = {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            A, B = sets[a], sets[b]
            if A and B and percent * max(len(A), len(B)) <= 100 * min(len(A), len(B)) and 100 * len(A & B) >= percent * len(A | B):
                x, y = sorted((root(a), root(b)))
                label[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


def found(df, **options):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in setjoin.join(df, **options).collect()}


def family(rng, size, copies, edits, start):
    base = [rng.choice("abcdefghijklmnop") + str(rng.randint(0, 400)) for _ in range(size)]
    out = [(start, " ".join(base))]
    for k in range(1, copies):
        words = list(base)
        for _ in range(rng.randint(0, edits)):
            words[rng.randrange(size)] = f"new{rng.randint(0, 10**6)}"
        out.append((start + k, " ".join(words)))
    return out


def test_families(spark):
    rng = random.Random(3)
    docs = family(rng, 150, 120, 5, 0) + family(rng, 80, 30, 3, 500) + family(rng, 12, 20, 1, 900)
    passage = " ".join(f"p{k}" for k in range(60))
    docs += [(2000 + k, passage + " " + " ".join(f"q{rng.randint(0, 10**6)}" for _ in range(rng.randint(1, 150)))) for k in range(80)]
    docs += [(3000, None), (3001, ""), (3002, " \t\n"), (3003, "One"), (3004, "one"), (3005, "one two"), (3006, "\xa0 x")]
    rng.shuffle(docs)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = brute(docs)
    assert found(df) == want
    assert len({c for _, c in want.values()}) < len(want)


def test_no_link_is_lost_in_a_chain(spark):
    rng = random.Random(8)
    words, docs = [f"w{k}" for k in range(200)], []
    for k in range(70):
        words[rng.randrange(200)] = f"z{k}"
        docs.append((k, " ".join(words)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert found(df) == brute(docs)


def test_rows_without_identifier_repeats_and_extra_columns(spark):
    df = spark.createDataFrame([(None, "a b c d", 1), (5, "a b c d", 2), (5, "a b c d", 3), (3, "A B C D", 4)], "doc_id long, text string, id long")
    rows = sorted((r["doc_id"] is None, r["doc_id"], r["n_shingles"], r["component_id"]) for r in setjoin.join(df).collect())
    assert rows == [(False, 3, 2, 3), (False, 5, 2, 3), (False, 5, 2, 3), (True, None, 2, None)]
    assert setjoin.join(df.limit(0)).count() == 0


def test_query(spark, small):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in queries.op9_ngram_jaccard_join(spark, small).collect()}
    assert got == brute(docs)


def test_a_large_family_just_below_the_threshold_opens_no_pairs(spark):
    rng = random.Random(6)
    base = [f"core{k}" for k in range(120)]
    docs = []
    for k in range(3000):  # each has words of its own at three places: any two share less than 90 percent, all share most
        words = list(base)
        for at in rng.sample(range(10), 3):
            words[5 + 11 * at] = f"own{k}x{at}"
        docs.append((k, " ".join(words)))
    docs += [(5000 + k, docs[7 * k][1] + f" end{k}") for k in range(40)]  # and some have a real partner
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in setjoin.join(df).collect()}
    sets = {i: grams(t) for i, t in docs}
    for i, c in got.items():
        assert c == (7 * (i - 5000) if i >= 5000 else i), i
    for k in range(40):
        a, b = sets[7 * k], sets[5000 + k]
        assert 100 * len(a & b) >= 90 * len(a | b)
    some = rng.sample(range(3000), 40)
    assert all(100 * len(sets[x] & sets[y]) < 90 * len(sets[x] | sets[y]) for x in some for y in some if x < y)


def test_marks_bound_the_overlap_and_rounds_lose_no_pair(spark, monkeypatch):
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(1)
    for _ in range(50):
        a, b = (np.unique(rng.integers(0, 2**63, rng.integers(1, 900), dtype=np.uint64)) for _ in range(2))
        b = np.unique(np.concatenate([b, rng.choice(a, len(a) // 2)]))
        marks = [np.bincount((x >> np.uint64(56)).view(np.int64), minlength=setjoin.MARKS).astype(np.uint8).tobytes() for x in (a, b)]
        most = setjoin._most.func(pd.Series(marks[:1] + [b""]), pd.Series(marks[1:] + [b""])).tolist()
        assert most[0] >= len(np.intersect1d(a, b)) and most[1] == -1
    monkeypatch.setattr(setjoin, "ROUND_BYTES", 1)
    monkeypatch.setattr(setjoin, "BROADCAST_IDS", 0)
    docs = family(random.Random(5), 100, 60, 4, 0) + family(random.Random(9), 60, 20, 2, 500)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert found(df) == brute(docs)


def test_no_table_of_a_step_is_left(spark, small):
    import os

    before = set(os.listdir(spark.sparkContext.getCheckpointDir().removeprefix("file:"))) if spark.sparkContext.getCheckpointDir() else set()
    assert setjoin.join(spark.read.parquet(f"{small}/documents.parquet")).count() > 0
    base = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    folders = [base, os.path.dirname(base)]
    left = {x for f in folders for x in os.listdir(f) if x.startswith("jaccard")} - before
    assert not left


def test_a_family_is_not_repeated_for_each_document_next_to_it(spark, monkeypatch):
    rng = random.Random(12)
    docs = family(rng, 150, 150, 4, 0)
    base = docs[0][1].split()
    for k in range(60):  # near the family, but each too far from all of it
        words = list(base)
        for at in rng.sample(range(4, 146), 9):
            words[at] = f"far{k}x{at}"
        docs.append((1000 + k, " ".join(words)))
    tables, made = {}, []
    keep = setjoin.Steps.keep

    def seen(self, df, name):
        tables[name] = keep(self, df, name)
        if name == "turned":
            made.append((tables[name].count(), tables["meeting"].join(tables[name], "group").count()))
        return tables[name]

    monkeypatch.setattr(setjoin.Steps, "keep", seen)
    assert found(spark.createDataFrame(docs, "doc_id long, text string")) == brute(docs)
    (opened, members), = made
    assert members <= 40 * opened  # rows of one document each, not of the whole family


def test_the_order_does_not_depend_on_how_documents_fall_into_tasks(spark, monkeypatch):
    rng = random.Random(21)
    passage = " ".join(f"p{k}" for k in range(60))
    docs = [(k, passage + " " + " ".join(f"q{rng.randint(0, 10**9)}" for _ in range(60))) for k in range(24)]
    docs += [(100 + k, docs[k][1] + " end") for k in range(3)]
    df, made = spark.createDataFrame(docs, "doc_id long, text string"), []
    keep = setjoin.Steps.keep

    def seen(self, df, name):
        kept = keep(self, df, name)
        if name in ("counted", "tokens"):
            made.append((name, kept.count()))
        return kept

    monkeypatch.setattr(setjoin.Steps, "keep", seen)
    want = brute(docs)
    assert found(df.coalesce(1)) == found(df.repartition(27)) == want
    # the passage is known as frequent where no task has it twice, and is in no prefix
    assert made[:2] == made[2:] and dict(made)["counted"] > 5 and dict(made)["tokens"] == 0


def test_counts_of_parts_are_the_counts_of_all(monkeypatch):
    from collections import Counter

    import pandas as pd

    monkeypatch.setattr(setjoin, "COUNTED", 50)
    texts = [" ".join(random.Random(k % 9).choices("abcdefg", k=40)) for k in range(60)] + [None, "", "a"]
    batches = [pd.DataFrame({"text": texts[k : k + 5]}) for k in range(0, len(texts), 5)]
    parts = pd.concat([*setjoin._counts(3)(batches)])
    got = pd.concat([setjoin._frequent(part) for _, part in parts.groupby("part")])
    counts = Counter(x for t in texts for x in setjoin.shingles(t, 3).tolist() if x < 1 << setjoin.COUNTED_BITS)
    assert dict(zip(got["token"].tolist(), got["n"].tolist())) == {x: n for x, n in counts.items() if n >= setjoin.FREQUENT} != {}
    assert list(setjoin._counts(3)(iter([pd.DataFrame({"text": [None, ""]})]))) == []
