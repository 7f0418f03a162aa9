"""Shared helpers: connected components, frequent rows, slices."""

import random

from pitpanel.llm.common import crc_of, lower_ascii, most_frequent, slices
from pitpanel.llm.graph import components


def test_components(spark):
    rng = random.Random(4)
    chain = [(k, k + 1) for k in range(100, 160)]
    star = [(500, k) for k in range(501, 700)]
    some = [(rng.randint(1000, 1100), rng.randint(1000, 1100)) for _ in range(60)]
    links = chain + [(b, a) for a, b in chain[::3]] + star + some + [(7, 7)]
    parent = {}

    def root(i):
        parent.setdefault(i, i)
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    want = {i: root(i) for i in parent}
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: c for i, c in want.items() if i in got}
    assert all(i in got for a, b in links if a != b for i in (a, b))
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_most_frequent(spark):
    df = spark.createDataFrame([("a", 9), ("b", 5), ("c", 5), ("d", 1), ("e", 1)], "w string, n long")
    names = lambda most: sorted(r["w"] for r in most_frequent(df, "n", most).collect())
    assert [names(k) for k in (0, 1, 2, 3, 4, 5)] == [[], ["a"], ["a"], ["a", "b", "c"], ["a", "b", "c"], ["a", "b", "c", "d", "e"]]


def test_slices_join_to_the_text():
    rng = random.Random(1)
    for _ in range(50):
        text = "".join(rng.choice("ab  ") for _ in range(rng.randint(0, 60)))
        parts = list(slices(text, 7))
        assert "".join(parts) == text and all(len(p) <= 7 for p in parts)


def test_text_helpers(spark):
    df = spark.createDataFrame([("AÉz", 5), (None, None)], "t string, i long")
    assert [tuple(r) for r in df.select(lower_ascii(df["t"]), crc_of(df["i"])).collect()] == [("aÉz", 2226203566), ("", 0)]
