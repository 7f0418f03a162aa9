"""Embedding near-dedup against all pairs."""

import numpy as np
import pytest

from pitpanel.llm import crosspolytope as cp
from pitpanel.llm import queries


def brute(rows, threshold=cp.THRESHOLD):
    """rows: (id, vector, label)."""
    n, parent = len(rows), list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    def unit(v):
        v = np.array([np.nan if x is None else x for x in v], float) if v else np.zeros(1)
        return v / np.linalg.norm(v) if np.isfinite(v).all() and v.any() else None

    units, links = [unit(v) for _, v, _ in rows], [0] * n
    for i in range(n):
        for j in range(i):
            a, b = units[i], units[j]
            if a is not None and b is not None and rows[i][2] is not None and rows[i][2] == rows[j][2] and len(a) == len(b) and a @ b >= threshold:
                links[i] += 1
                links[j] += 1
                parent[root(i)] = root(j)
    least = {}
    for i in range(n):
        least[root(i)] = min(least.get(root(i), rows[i][0]), rows[i][0])
    return {rows[i][0]: (links[i], least[root(i)], least[root(i)] == rows[i][0]) for i in range(n)}


def found(spark, rows, **options):
    df = spark.createDataFrame([(i, v, x, 1, True) for i, v, x in rows], "vec_id long, embedding array<float>, label int, weight int, home boolean")
    return {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in cp.near_duplicates(df, **options).collect()}


def near(rng, v, cosine):
    w = rng.normal(size=len(v))
    w -= (w @ v) / (v @ v) * v
    return v / np.linalg.norm(v) * cosine + w / np.linalg.norm(w) * np.sqrt(1 - cosine**2)


def test_links_close_to_the_threshold(spark):
    rng, rows = np.random.default_rng(6), []
    for k in range(150):
        v = rng.normal(size=64)
        rows += [(3 * k, v.astype(np.float32).tolist(), k % 3), (3 * k + 1, near(rng, v, rng.uniform(0.935, 0.97)).astype(np.float32).tolist(), k % 3),
                 (3 * k + 2, near(rng, v, rng.uniform(0.85, 0.925)).astype(np.float32).tolist(), k % 3)]
    want, got = brute(rows), found(spark, rows)
    assert all(got[i][0] <= want[i][0] for i in want)
    recall = sum(got[i][0] for i in want) / sum(w[0] for w in want.values())
    assert recall >= 0.97


@pytest.mark.parametrize("block", [1024, 16])
def test_large_group_and_copies(spark, monkeypatch, block):
    monkeypatch.setattr(cp, "BLOCK", block)
    rng = np.random.default_rng(9)
    v = rng.normal(size=32)
    rows = [(k, near(rng, v, 0.99).astype(np.float32).tolist(), 1) for k in range(90)]
    rows += [(200 + k, rows[0][1], 1) for k in range(30)] + [(300 + k, rows[1][1], 2) for k in range(5)]
    assert found(spark, rows) == brute(rows)


def test_edges(spark):
    a = [1.0, 0.0, 0.0]
    rows = [(1, a, 1), (2, a, None), (3, None, 1), (4, [0.0, 0.0, 0.0], 1), (5, [1.0, None, 0.0], 1), (6, [float("nan"), 1.0, 0.0], 1), (7, [float("inf"), 0.0, 0.0], 1),
            (8, [2.0, 0.0, 0.0], 1), (9, [1.0, 0.0], 1), (10, [], 1), (11, [], 1), (12, [-1.0, 0.0, 0.0], 1), (13, [5.0], 1), (14, [7.0], 1)]
    got = found(spark, rows)
    assert got == brute(rows)
    df = spark.createDataFrame([(None, a, 1), (4, a, 1), (4, a, 1)], "vec_id long, embedding array<double>, label int")
    rows = sorted((str(r["vec_id"]), r["n_links"], r["component_id"], r["kept"]) for r in cp.near_duplicates(df).collect())
    assert rows == [("4", 1, 4, True), ("4", 1, 4, True), ("None", 0, None, False)]
    assert cp.near_duplicates(df.limit(0)).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.1"
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in queries.op10_embedding_near_dedup(spark, sf).collect()}
    assert got == brute(rows)
