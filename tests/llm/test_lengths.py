"""Length histogram against plain sums."""

import random

import numpy as np
from pyspark.sql import functions as F

from pitpanel.llm import lengths, queries


def test_every_limit(spark):
    rng = random.Random(1)
    sizes = [int(rng.expovariate(0.02)) for _ in range(500)] + [0, 0, 10_000]
    df = spark.createDataFrame([(s, 1) for s in sizes], "size long, length long")
    table = lengths.histogram(df, F.col("size"))
    rows = {r["length"]: r for r in table.collect()}
    a = np.array(sizes)
    assert set(rows) == set(sizes)
    for n, r in rows.items():
        assert (r["n_docs"], r["n_tokens"]) == ((a == n).sum(), n * (a == n).sum())
        assert (r["docs_from"], r["tokens_from"]) == ((a >= n).sum(), a[a >= n].sum())
        assert (r["docs_below"], r["tokens_below"]) == ((a < n).sum(), a[a < n].sum())
        assert r["truncated_total"] == np.minimum(a, n).sum() and np.isclose(r["share_to"], (a <= n).mean())
    limits = [0, 1, 37, 128, 9999, 20_000]
    got = {r["limit"]: (r["docs_cut"], r["truncated_total"]) for r in lengths.at_limits(table, limits).collect()}
    assert got == {x: ((a > x).sum(), np.minimum(a, x).sum()) for x in limits}
    got = {r["share"]: r["length"] for r in lengths.quantiles(table, [0.1, 0.5, 0.99, 1.0]).collect()}
    assert got == {q: int(np.quantile(a, q, method="inverted_cdf")) for q in got}


def test_empty(spark):
    df = spark.createDataFrame([], "size long")
    assert lengths.histogram(df, F.col("size")).count() == 0


def test_query(spark, small):
    counts = [r["n_tokens"] for r in queries.op4_byte_bpe(spark, small).collect()]
    rows = queries.op8_token_counts(spark, small).collect()
    assert sum(r["n_docs"] for r in rows) == len(counts) and sum(r["n_tokens"] for r in rows) == sum(counts)
    assert max(r["tokens_from"] for r in rows) == sum(counts)
