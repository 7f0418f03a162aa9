"""The pipeline: each stage does what its operator says, with whole rows."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pitpanel.llm import decontaminate


@pytest.fixture(scope="module")
def stages(spark, small):
    docs, out = spark.read.parquet(f"{small}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        out.append((name, docs, stage(spark, docs, small).cache()))
        docs = out[-1][2]
    return out


def test_columns_and_rows(stages):
    for name, before, after in stages[:-1]:
        assert after.columns == before.columns, name
        assert after.select("doc_id").exceptAll(before.select("doc_id")).isEmpty()
        kept = after.count()
        assert 0 < kept <= before.count()


def test_run_is_the_last_stage(spark, small, stages):
    ran = corpus_pipeline.run(spark, small)
    assert ran.columns == stages[-1][2].columns
    assert ran.exceptAll(stages[-1][2]).isEmpty() and stages[-1][2].exceptAll(ran).isEmpty()
    assert ran.where(~F.col("round_trip")).isEmpty()


def test_no_benchmark_passage_is_left(spark, small, stages):
    left = [decontaminate.normalize(r["text"]) for r in stages[3][2].collect()]
    items = [decontaminate.normalize(r["text"]) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    assert not any(i in t for i in items for t in left)


def test_edge_rows_and_clashing_columns(spark, small):
    p = " ".join(f"word{k}" for k in range(80))
    rows = [(1, p, "en", "s", 5, 1), (1, p, "en", "s", 5, 1), (2, p, None, None, None, 2), (3, None, "en", "s", 0, 3), (4, "", "en", "s", 0, 4), (5, "short text", "en", "s", 10, 5),
            (6, "12 34", "en", "s", 5, 6), (None, "no number", "en", "s", 9, 7), (8, "a\n" + p, "en", "s", 3, 8)]
    rows += [(20 + k, f"the cat sat on mat {k} of them", "en", "s", 3, 9) for k in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, id long")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, small)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "id"], name
    left = sorted((str(r["doc_id"]), r["text"][:9]) for r in docs.collect())
    assert [x for x in left if not x[0].startswith("2")] == [("1", "word0 wor"), ("5", "short tex"), ("8", "a"), ("None", "no number")]
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, small)
        assert empty.count() == 0


def test_near_copies_against_brute_force_at_five_words(spark, small):
    rng = random.Random(4)
    docs, start = [], 0
    for _ in range(6):
        base = [f"{rng.choice('abcdefgh')}{rng.randint(0, 10**6)}" for _ in range(200)]
        docs.append((start, base))
        for k in range(1, 8):  # scattered edits, and words behind the end
            words, edits = list(base), (4, 4, 5, 3, 0, 0, 0)[k - 1]
            for at in rng.sample(range(5), edits):
                words[20 + 40 * at] = f"new{rng.randint(0, 10**6)}"
            words += [f"more{rng.randint(0, 10**6)}" for _ in range((0, 0, 0, 10, 30, 45, 60)[k - 1])]
            docs.append((start + k, words))
        start += 100
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, w in docs}
    label = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) and label[a] != label[b]:
                low, high = sorted((label[a], label[b]))
                label = {i: low if x == high else x for i, x in label.items()}
    want = sorted(i for i, x in label.items() if i == x)
    assert 6 < len(want) < len(docs)
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in docs], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in corpus_pipeline.keep_one_of_near_copies(spark, df, small).collect()) == want


def test_rows_that_share_an_identifier_but_not_the_text(spark, small):
    near = [f"w{k}" for k in range(100)]
    far = " ".join(f"v{k}" for k in range(80))
    other = " ".join(f"u{k}" for k in range(80))
    rows = [(5, far, 1), (5, other, 2), (5, far, 3), (9, " ".join(near), 4), (9, " ".join(near + ["more"]), 5), (4, other + " end", 6), (5, None, 7), (None, far, 8), (None, far, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, id long")
    left = corpus_pipeline.keep_one_of_near_copies(spark, df, small)
    assert left.columns == df.columns
    kept = sorted((str(r["doc_id"]), (r["text"] or "")[:3]) for r in left.collect())
    # of 4 and the other text of 5 the smaller identifier stays; of both texts of 9 one; texts without words stay
    assert kept == [("4", "u0 "), ("5", ""), ("5", "v0 "), ("9", "w0 "), ("None", "v0 "), ("None", "v0 ")]
