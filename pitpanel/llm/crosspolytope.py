"""Near duplicates among embeddings: cross-polytope hashing after fast Hadamard rotations, with multiprobe buckets.

A vector is turned by three rounds of random signs and a Hadamard transform; its hash is the coordinate axis, with sign,
that it then lies closest to. A table's bucket is the pair of two such hashes. Each vector has its home bucket in each of
TABLES tables and also visits the PROBES next likely buckets. Two vectors meet where one is at home in a bucket that the
other is in; every meeting is verified by the cosine in double precision. Only rows with equal label and length meet.

Equal vectors are one vector with a weight from the start. Buckets of more than BLOCK vectors are dealt into blocks that
meet pair by pair, each pair of blocks by itself, so no task holds a whole large bucket. What comes back are sums and
spanning forests, never pairs. A link is counted where its vectors meet first (lowest bucket number); whether they met
earlier follows from their hashes, which are computed again for linked vectors.

Vectors that are null, empty or zero or hold null or non-finite components, and rows without label, link with nothing;
each is its own component. Rows without identifier take no part: no links, null component, not kept. Repeated rows are
vectors of their own that link with each other. Other columns are not looked at.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitpanel.llm.common import bounded_batches
from pitpanel.llm.graph import components
from pitpanel.session import stable

TABLES, PROBES = 6, 4
#: Vectors of a bucket that one group compares with each other or with as many others.
BLOCK = 1024
THRESHOLD = 0.93
#: Rows that a group gets on average; it holds some whole buckets or pairs of blocks.
SHARD = 8_000
_SEED = 20240501


@lru_cache(8)
def _signs(size: int) -> np.ndarray:
    """Signs of each table's two rotations, three rounds each; fixed for all runs."""
    return np.random.default_rng(_SEED + size).choice([-1.0, 1.0], (TABLES, 2, 3, size))


def _hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the last axis, scaled to keep lengths."""
    size = x.shape[-1]
    step = 1
    while step < size:
        y = x.reshape(*x.shape[:-1], size // (2 * step), 2, step)
        x = np.stack([y[..., 0, :] + y[..., 1, :], y[..., 0, :] - y[..., 1, :]], axis=-2).reshape(x.shape)
        step *= 2
    return x / np.sqrt(size)


def buckets(vectors: np.ndarray) -> np.ndarray:
    """For each vector and table the home bucket and PROBES visited ones, as numbers (rows x TABLES x (1 + PROBES))."""
    n, d = vectors.shape
    size = 1 << max(1, (d - 1).bit_length())
    padded = np.zeros((n, size))
    padded[:, :d] = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    signs = _signs(size)
    near = min(PROBES + 1, 2 * size)
    out = np.zeros((n, TABLES, 1 + PROBES), np.int64)
    for t in range(TABLES):
        axes, costs = [], []
        for k in range(2):
            x = padded
            for r in range(3):
                x = _hadamard(x * signs[t, k, r])
            both = np.concatenate([x, -x], axis=1)
            best = np.argsort(-both, axis=1, kind="stable")[:, :near]
            value = np.take_along_axis(both, best, axis=1)
            axes.append(best)
            costs.append((value[:, :1] - value) ** 2)
        # the pairs with the least squared distance from the home bucket, home first
        cost = (costs[0][:, :, None] + costs[1][:, None, :]).reshape(n, -1)
        chosen = np.argsort(cost, axis=1, kind="stable")[:, : 1 + PROBES]
        first, second = np.take_along_axis(axes[0], chosen // near, axis=1), np.take_along_axis(axes[1], chosen % near, axis=1)
        number = first * 2 * size + second
        out[:, t, : number.shape[1]] = number
        out[:, t, number.shape[1] :] = number[:, :1]
    return out


def _entries(batches):
    """(id, table, bucket, home) of vectors."""
    for pdf in batches:
        for _, group in pdf.groupby(pdf["vector"].map(len)):
            found = buckets(np.stack(group["vector"].to_numpy()).astype(np.float64))
            n = len(group)
            wide = TABLES * (1 + PROBES)
            rows = pd.DataFrame({
                "id": np.repeat(group["id"].to_numpy(), wide),
                "place": np.repeat(group["place"].to_numpy(), wide),
                "bucket": (np.arange(TABLES)[None, :, None] * (1 << 40) + found).reshape(-1),
                "home": np.tile(np.arange(1 + PROBES) == 0, n * TABLES),
            })
            yield rows.sort_values("home", ascending=False).drop_duplicates(["id", "bucket"])


def _earlier(a: np.ndarray, b: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """For pairs of bucket arrays whether the pair also meets in a bucket with a lower number than the one given."""
    offset = (np.arange(TABLES) * (1 << 40))[None, :, None]
    a, b = a + offset, b + offset
    out = np.zeros(len(a), bool)
    for home, other in ((a[:, :, :1], b), (b[:, :, :1], a)):
        out |= ((home == other).any(axis=2) & (home[:, :, 0] < bucket[:, None])).any(axis=1)
    return out


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest row that links lead to, for each row."""
    label = np.arange(n)
    while True:
        new = label.copy()
        low = np.minimum(label[i], label[j])
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _small(home, bucket):
    """Row pairs that share a small bucket with one of them at home; rows are sorted by bucket."""
    first = np.searchsorted(bucket, bucket, "left")
    before = np.arange(len(bucket)) - first
    j = np.repeat(np.arange(len(bucket)), before)
    i = np.arange(len(j)) - np.repeat(np.cumsum(before) - before, before) + np.repeat(first, before)
    met = home[i] | home[j]
    return i[met], j[met]


def _large(x, home, block, threshold, across):
    """Linked row pairs of one pair of blocks (``across``) or inside one block, 512 rows at a time."""
    for start in range(0, len(x), 512):
        rows = slice(start, start + 512)
        linked = (x[rows] @ x.T >= threshold) & (home[rows, None] | home[None, :])
        linked &= np.arange(len(x))[rows, None] < np.arange(len(x))[None, :]
        if across:
            linked &= block[rows, None] != block[None, :]
        i, j = np.nonzero(linked)
        yield i + start, j


def _meet(threshold: float):
    """Links of one shard: its rows are the members of some buckets or pairs of blocks, each complete."""

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for _, group in pdf.groupby(pdf["vector"].map(len)):
            parts.append(shard(group.sort_values(["meeting", "id"], kind="stable").reset_index(drop=True)))
        return pd.concat(parts)

    def shard(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, at = np.unique(pdf["id"].to_numpy(), return_index=True)
        row = np.searchsorted(ids, pdf["id"].to_numpy())
        x = np.stack(pdf["vector"].to_numpy()[at]).astype(np.float64)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        home, block, bucket, weight = (pdf[c].to_numpy() for c in ("home", "block", "bucket", "weight"))
        meeting, size = np.unique(pdf["meeting"].to_numpy(), return_inverse=True, return_counts=True)[1:]
        weight = weight[at]
        found = []
        few = np.flatnonzero(size[meeting] <= 64)
        i, j = _small(home[few], meeting[few])
        for start in range(0, len(i), 1 << 16):
            a, b = few[i[start : start + (1 << 16)]], few[j[start : start + (1 << 16)]]
            linked = np.einsum("nd,nd->n", x[row[a]], x[row[b]]) >= threshold
            found.append((a[linked], b[linked]))
        for k in np.flatnonzero(size > 64).tolist():
            here = np.flatnonzero(meeting == k)
            across = bool(pdf["sides"].to_numpy()[here[0]])
            found += [(here[i], here[j]) for i, j in _large(x[row[here]], home[here], block[here], threshold, across)]
        i, j = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in (0, 1))
        # rows of a small pair of blocks meet across the two only
        apart = ~(pdf["sides"].to_numpy()[i] & (block[i] == block[j])) & (row[i] != row[j])
        i, j = i[apart], j[apart]
        label = _forest(len(ids), row[i], row[j])
        count = np.zeros(len(ids), np.int64)
        if len(i):
            some = np.unique(np.concatenate([row[i], row[j]]))
            own = buckets(x[some])
            number = np.searchsorted(some, np.arange(len(ids)))
            for start in range(0, len(i), 1 << 14):
                a, b = i[start : start + (1 << 14)], j[start : start + (1 << 14)]
                first = ~_earlier(own[number[row[a]]], own[number[row[b]]], bucket[a])
                np.add.at(count, row[a[first]], weight[row[b[first]]])
                np.add.at(count, row[b[first]], weight[row[a[first]]])
        keep = (count > 0) | (label != np.arange(len(ids)))
        return pd.DataFrame({"id": ids[keep], "other": ids[label[keep]], "n": count[keep]})

    return meet


def usable(vector: Column, label: Column) -> Column:
    """Whether a vector can link at all."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(label.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def near_duplicates(rows: DataFrame, vector: str = "embedding", label: str = "label", identifier: str = "vec_id", threshold: float = THRESHOLD) -> DataFrame:
    """One row for each row: identifier, n_links (other vectors linked directly), component_id, kept (it is its component's first)."""
    bounded_batches(rows.sparkSession)
    given = rows.select(F.col(identifier).cast("long").alias("id"), F.col(label).cast("string").alias("label"), F.col(vector).alias("vector"))
    given = given.select(
        "*", (usable(F.col("vector"), F.col("label")) & F.col("id").isNotNull()).alias("ok"),
        F.xxhash64("vector").alias("h1"), F.xxhash64(F.lit(7), "vector").alias("h2"), F.size("vector").alias("size"))
    same = ["label", "h1", "h2", "size"]
    distinct = given.where("ok").groupBy(*same).agg(F.min("id").alias("least"), F.count("*").alias("weight"), F.first("vector").alias("vector"))
    distinct = stable(distinct)
    heads = distinct.select(F.col("least").alias("id"), F.concat_ws("/", "size", "label").alias("place"), "weight", "vector")
    entries = stable(heads.select("id", "place", "vector").mapInPandas(_entries, "id long, place string, bucket long, home boolean"))
    bucket = ["place", "bucket"]
    sizes = entries.groupBy(*bucket).agg(F.count("*").alias("n"), F.max("home").alias("lived_in")).where("n > 1 and lived_in")
    # tables of their own, so that joins with them can be split where one key has very many rows
    sizes = stable(sizes.select(*bucket, F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")))
    met = entries.join(sizes, bucket).withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    met = met.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    sides = F.least("block", "with"), F.greatest("block", "with")
    met = stable(met.select("id", "home", "block", "bucket", (sides[0] != sides[1]).alias("sides"), F.xxhash64("place", "bucket", *sides).alias("meeting")))
    shards = 1 + met.count() // SHARD
    met = met.withColumn("shard", F.pmod("meeting", F.lit(shards))).join(heads.select("id", "weight", "vector"), "id")
    links = stable(met.groupBy("shard").applyInPandas(_meet(threshold), "id long, other long, n long"))
    counts = links.groupBy("id").agg(F.sum("n").alias("found")).withColumnRenamed("id", "least")
    parts = components(links.select(F.col("id").alias("a"), F.col("other").alias("b"))).withColumnRenamed("node", "least")
    named = stable(distinct.drop("vector").join(counts, "least", "left").join(parts, "least", "left"))
    out = given.drop("vector").alias("g").join(named, same, "left")
    component = F.when(F.col("ok"), F.coalesce("component", "least")).otherwise(F.col("id"))
    return out.select(
        F.col("id").alias(identifier),
        F.when(F.col("ok"), F.coalesce("found", F.lit(0)) + F.col("weight") - 1).otherwise(0).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )
