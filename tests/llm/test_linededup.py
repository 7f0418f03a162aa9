"""Line dedup against the plain definition: a line goes if a run with it, of enough words, also occurs earlier."""

import random

from pyspark.sql import functions as F

from pitpanel.llm import linededup, queries


def brute(docs, min_words):
    """docs: (id, text) in order of first copies; gives {id: removed raw line numbers}."""
    seqs = []
    for key, text in docs:
        raw = [(i, x.strip(" \t\r")) for i, x in enumerate((text or "").split("\n"))]
        seqs.append((key, [(i, x) for i, x in raw if x]))
    places = {}
    for d, (_, seq) in enumerate(seqs):
        for i, (_, x) in enumerate(seq):
            places.setdefault(x, []).append((d, i))
    out = {}
    for d, (key, seq) in enumerate(seqs):
        gone = set()
        for i in range(len(seq)):
            longest = 0
            for e, j in places[seq[i][1]]:
                if (e, j) >= (d, i):
                    break
                n, other = 0, seqs[e][1]
                while i + n < len(seq) and j + n < len(other) and seq[i + n][1] == other[j + n][1]:
                    n += 1
                longest = max(longest, n)
            run = seq[i : i + longest]
            if sum(len(x.split()) for _, x in run) >= min_words:
                gone |= {r for r, _ in run}
        if gone:
            out[key] = gone
    return out


def found(spark, docs, min_words):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = linededup.copies(df, min_words=min_words).collect()
    return {r["id"]: set(r["removed"]) for r in rows}


def test_random_lines(spark):
    rng = random.Random(5)
    lines = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6))) for _ in range(12)] + ["", "  "]
    docs = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randint(0, 25)))) for i in range(40)]
    for min_words in (1, 7, 15):
        assert found(spark, docs, min_words) == brute(docs, min_words)


def test_runs_and_whole_copies(spark):
    a, b, c, d = ("w%d " % k * 30 for k in range(4))
    docs = [(1, f"{a}\n{b}\n{c}"), (2, f"x\n{a}\n\n{b}\ny"), (3, a), (4, f"{a}\n{b}\n{c}"), (5, f"{d}\nshort\n{d}\nshort"), (6, None), (7, ""), (8, "\n \n")]
    assert found(spark, docs, 50) == brute(docs, 50) == {2: {1, 3}, 4: {0, 1, 2}}
    assert found(spark, docs, 30)[5] == {2, 3}


def test_text_and_other_columns(spark):
    p = "one passage " * 30
    rows = [(1, p + "\nmine", "x", 7), (2, "\n" + p + "\nyours", "y", 8), (None, "alone", "z", 9), (3, p, None, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, removed string, rank long")
    got = {r["rank"]: r for r in linededup.dedup(df).collect()}
    assert got[8]["text"] == "\nyours" and got[8]["removed"] == "y" and got[8]["line_dedup"]["n_removed"] == 1
    assert got[7]["text"] == p + "\nmine" and got[9]["text"] == "alone" and got[1]["text"] == ""
    assert got[9]["doc_id"] is None


def test_repeated_rows_and_empty_table(spark):
    p = "w " * 60
    df = spark.createDataFrame([(1, p), (1, p), (2, p)], "doc_id long, text string")
    got = sorted((r["doc_id"], r["text"]) for r in linededup.dedup(df).collect())
    assert got == [(1, p), (1, p), (2, "")]
    assert linededup.dedup(df.limit(0)).count() == 0


def test_query(spark, small):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").orderBy("doc_id").collect()]
    want = brute(docs, linededup.MIN_WORDS)
    got = {r["doc_id"]: r["n_removed"] for r in queries.op2_line_dedup(spark, small).where(F.col("n_removed") > 0).collect()}
    assert got == {k: len(v) for k, v in want.items()}
