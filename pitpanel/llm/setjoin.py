"""Similarity join of documents on word n-grams with a token-group matrix.

Two documents link when 100 * |A and B| >= percent * |A or B| over their sets of shingles. Equal sets are one document
from the start. The steps, each over all documents:

1. Shingles below a fixed quantile of the hash are counted over all documents, however these fall into tasks; those that
   many documents have (*frequent*) sort last. This only sets an order: any order is right, a good one keeps common
   passages out of the prefixes.
2. In that order a linked pair shares one of the first shingles of both, at places that leave enough to share behind
   them (prefix and place bound), and ``k`` of them if both prefixes are ``k - 1`` longer. Documents are candidates if
   that many of their longer prefix stand in other documents' prefixes, with the least ``k`` that a partner can have.
3. Where more than BUCKET candidates share a prefix shingle, those documents are put in a second order, by the exact
   number of candidates that hold each shingle: edits come before what a family of near copies has in common.
4. Under each prefix shingle a leader, the one with most of its set behind that place, is compared with the others.
   Links join documents to *groups*, so a family of copies takes one comparison for each copy, not one for each pair.
5. The token-group matrix has for each prefix shingle and group the union of its members' places and sizes. Two groups
   qualify where the overlap that this bounds can reach the threshold; only those are opened, member by member of the smaller one.
6. Links of 4 and 5 give the components. Pairs inside a group need no comparison: they are connected already.

Before whole sets are compared, pairs have to pass a bound by MARKS counts for each set, of its shingles by the first bits of their
hash: the sum of the smaller counts is never less than the overlap. Pairs that are left are verified in rounds by the
hash of one side, as many as keep a round at half of the size of the sets themselves, so disk use follows
the input. Tables between steps are deleted as soon as the next one is written.

Shingles stand for themselves by 64-bit hashes: two different ones are taken for one with a chance of about 2^-64 for each pair of shingles.

A null identifier links with nothing and gets a null component. Null and empty texts have no shingles and link with
nothing. Rows that share an identifier count as one document. Other columns are not looked at.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from pitpanel.llm.common import Steps, bounded_batches, most_frequent
from pitpanel.llm.graph import components
from pitpanel.session import stable

#: Shingles counted this often are frequent; at most FREQUENT_MOST of them are broadcast (8 bytes each).
FREQUENT, FREQUENT_MOST = 8, 1 << 20
#: Share of the hash range in which documents are counted: below 2 ** COUNTED_BITS of 2 ** 64.
COUNTED_BITS = 62
#: Shingles that a task holds before it reports them; they are summed up in so many parts of that range (2 ** PART_BITS).
COUNTED, PART_BITS = 4_000_000, 9
#: Candidates under one prefix shingle, beyond which they get an order of their own.
BUCKET = 8
#: Counts of shingles by the first bits of their hash; pairs that a round verifies have at least so many bytes of sets.
MARKS, ROUND_BYTES = 256, 64 << 20
#: Sets that are sent to a semi join at most by broadcast, in rows of 8 bytes.
BROADCAST_IDS = 1 << 21
_LIMIT = np.uint64(1 << COUNTED_BITS)
_SPACE = bytes([9, 10, 11, 12, 13, 32])
_words: dict[bytes, int] = {}
_UPPER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + _SPACE, b"abcdefghijklmnopqrstuvwxyz" + b" " * 6)


def _word_hashes(text: str) -> np.ndarray:
    """Hashes of the words of a text, A-Z in lower case, separated by ASCII white space only."""
    words = text.encode("utf-8").translate(_UPPER).split(b" ")
    try:
        out = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    except KeyError:
        if len(_words) > 300_000:
            _words.clear()
        for w in {w for w in words if w not in _words}:
            _words[w] = xxhash.xxh3_64_intdigest(w) | 1 if w else 0
        out = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    return out[out > 0]


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of the word ``width``-grams; all words as one if there are fewer."""
    words = _word_hashes(text or "")
    if not len(words):
        return words
    n = max(1, len(words) - width + 1)
    out = np.full(n, min(width, len(words)), np.uint64)
    for k in range(min(width, len(words))):
        out = (out ^ words[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return np.unique(out)


def _need(n, m, percent: int):
    """Smallest overlap of linked sets of sizes n and m."""
    return -(-percent * (n + m) // (100 + percent))


#: Shingles of the longer prefix that a pair must share, as a share of the set; at least one.
SHARED = 0.03


def _prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + max(1, int(SHARED * n)) if n else 0


def _counts(width: int):
    """Shingles of a task with the number of its documents that hold each, packed by part of the hash range."""

    def count(batches):
        held, size = [], 0

        def report():
            token, n = np.unique(np.concatenate(held), return_counts=True)
            ends = np.searchsorted(token, np.arange(1, (1 << PART_BITS) + 1, dtype=np.uint64) << np.uint64(COUNTED_BITS - PART_BITS))
            spans = [(part, x, y) for part, (x, y) in enumerate(zip(np.append(0, ends), ends)) if x < y]
            n = n.astype(np.uint32)
            return pd.DataFrame({"part": [p for p, *_ in spans], "tokens": [token[x:y].tobytes() for _, x, y in spans], "times": [n[x:y].tobytes() for _, x, y in spans]})

        for pdf in batches:
            for text in pdf["text"]:
                s = shingles(text, width)
                held.append(s[: np.searchsorted(s, _LIMIT)].copy())
                size += len(held[-1])
            if size > COUNTED:
                yield report()
                held, size = [], 0
        if size:
            yield report()

    return count


def _frequent(part: pd.DataFrame) -> pd.DataFrame:
    """(token, n) of the shingles of one part of the hash range that FREQUENT documents hold."""
    token, at = np.unique(np.frombuffer(b"".join(part["tokens"]), np.int64), return_inverse=True)
    n = np.bincount(at, np.frombuffer(b"".join(part["times"]), np.uint32)).astype(np.int64)
    return pd.DataFrame({"token": token[n >= FREQUENT], "n": n[n >= FREQUENT]})


def _prefixes(width: int, percent: int, frequent):
    def prefix(batches):
        common = frequent.value
        for pdf in batches:
            sizes, sums, firsts, lates, ends = [], [], [], [], []
            for text in pdf["text"]:
                s = shingles(text, width)
                sizes.append(len(s))
                sums.append(xxhash.xxh3_128_digest(s.tobytes()))
                early = len(s)
                low = s[: np.searchsorted(s, _LIMIT)]
                if len(common) and len(low):
                    at = np.minimum(np.searchsorted(common, low), len(common) - 1)
                    late = np.zeros(len(s), bool)
                    late[: len(low)] = common[at] == low
                    early = int((~late).sum())
                    s = np.concatenate([s[~late], s[late]])
                firsts.append(s[: _prefix_length(len(s), percent)].view(np.int64))
                last = len(s) - -(-percent * len(s) // 100)
                lates.append(int(last >= early))
                ends.append(lates[-1] << 30 | int(s[last] >> np.uint64(34)) if len(s) else 0)
            yield pd.DataFrame({"id": pdf["id"], "n": sizes, "digest": sums, "prefix": firsts, "end": ends})

    return prefix


def _sets(width: int):
    def sets(batches):
        for pdf in batches:
            found = [shingles(t, width) for t in pdf["text"]]
            counts = [np.bincount((a >> np.uint64(56)).view(np.int64), minlength=MARKS) for a in found]
            # a count that needs more than a byte: no bound for this set
            marks = [c.astype(np.uint8).tobytes() if len(c) == MARKS and c.max() < 256 else b"" for c in counts]
            yield pd.DataFrame({"id": pdf["id"], "tokens": [a.tobytes() for a in found], "marks": marks})

    return sets


@F.pandas_udf(LongType())
def _most(a: pd.Series, b: pd.Series) -> pd.Series:
    """Upper bound of the overlap of two sets by their marks; -1 where there is none."""
    out = np.full(len(a), -1, np.int64)
    held = np.flatnonzero([len(x) > 0 and len(y) > 0 for x, y in zip(a, b)])
    for some in np.array_split(held, 1 + len(held) // 4096):
        x, y = (np.frombuffer(b"".join(s.iloc[some]), np.uint8).reshape(-1, MARKS) for s in (a, b))
        out[some] = np.minimum(x, y).sum(1, dtype=np.int64)
    return pd.Series(out)


def _unpack(batches):
    for pdf in batches:
        arrays = [np.frombuffer(t, np.int64) for t in pdf["tokens"]]
        yield pd.DataFrame({"id": np.repeat(pdf["id"].to_numpy(), [len(a) for a in arrays]), "token": np.concatenate(arrays) if arrays else np.zeros(0, np.int64)})


@F.pandas_udf(LongType())
def _overlap(a: pd.Series, b: pd.Series) -> pd.Series:
    both = [len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True)) for x, y in zip(a, b)]
    return pd.Series(both, dtype="int64")


def _bounds(percent: int):
    """Whether rows a and b, which share a prefix shingle at places a.pos and b.pos, can reach the threshold."""
    need = F.ceil(F.lit(percent) * (F.col("a.n") + F.col("b.n")) / (100 + percent))
    return (need <= F.col("a.n") - F.col("a.pos")) & (need <= F.col("b.n") - F.col("b.pos"))


def _sizes_fit(percent: int):
    return (F.lit(percent) * F.col("a.n") <= 100 * F.col("b.n")) & (F.lit(percent) * F.col("b.n") <= 100 * F.col("a.n"))


def _reaching(met: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b, na, nb) of the rows in which two documents meet that can still reach the threshold.

    The rows are all common shingles of the two prefixes. Where the prefix of one ends first in the order, every shingle
    of it that the other document has at all is among them, so the overlap is at most their number and what lies behind
    that prefix. Pairs of a crowd are judged in the second order, where their rows are complete.
    """
    named = met.select(
        "a.kind", F.col("a.id").alias("a"), F.col("b.id").alias("b"), F.col("a.n").alias("na"), F.col("b.n").alias("nb"),
        F.col("a.end").alias("ea"), F.col("b.end").alias("eb"))
    met = named.groupBy("kind", "a", "b", "na", "nb").agg(F.count("*").alias("common"), F.min("ea").alias("ea"), F.min("eb").alias("eb"))
    # behind the plain prefix of n - ceil(percent n / 100) + 1 shingles
    behind = {c: F.ceil(F.lit(percent) * F.col(c) / 100) - 1 for c in ("na", "nb")}
    rest = F.when(F.col("ea") < F.col("eb"), behind["na"]).when(F.col("eb") < F.col("ea"), behind["nb"]).otherwise(F.greatest(*behind.values()))
    need = F.ceil(F.lit(percent) * (F.col("na") + F.col("nb")) / (100 + percent))
    return met.where(F.col("common") + rest >= need).select("a", "b", "na", "nb").distinct()


def _verified(steps: Steps, pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, na, nb) that link."""
    marks = sets.select("id", "marks")
    marked = pairs.join(marks.select(F.col("id").alias("a"), F.col("marks").alias("ma")), "a").join(marks.select(F.col("id").alias("b"), F.col("marks").alias("mb")), "b")
    need = F.ceil(F.lit(percent) * (F.col("na") + F.col("nb")) / (100 + percent))
    left = steps.keep(marked.select("a", "b", "na", "nb", _most("ma", "mb").alias("most")).where((F.col("most") < 0) | (F.col("most") >= need)).drop("most"), "pairs")
    held, whole = (df.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0] for df, size in ((left, 8 * F.col("na")), (sets, F.length("tokens"))))
    rounds = 1 + held // max(ROUND_BYTES, whole // 2)
    links = []
    for k in range(rounds):
        part = left.where(F.pmod(F.xxhash64("a"), F.lit(rounds)) == k)
        both = part.join(sets.select(F.col("id").alias("a"), F.col("tokens").alias("ta")), "a").join(sets.select(F.col("id").alias("b"), F.col("tokens").alias("tb")), "b")
        both = both.select("a", "b", "na", "nb", _overlap("ta", "tb").alias("common"))
        links.append(steps.keep(both.where(F.lit(100) * F.col("common") >= F.lit(percent) * (F.col("na") + F.col("nb") - F.col("common"))).select("a", "b"), "links"))
    steps.drop(left)
    return reduce(DataFrame.unionByName, links)


def _only(table: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``table`` whose ``id`` is one of ``ids`` (different ones), which are broadcast if they are few."""
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return table.join(F.broadcast(ids) if few else ids, "id", "left_semi")


def _second_order(steps: Steps, crowd: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(kind, token, id, n, pos, end) of prefixes in the order of (documents of the crowd that hold the shingle, hash)."""
    tokens = steps.keep(_only(sets.select("id", "tokens"), crowd.select("id")).mapInPandas(_unpack, "id long, token long"), "tokens")
    held = steps.keep(tokens.groupBy("token").agg(F.count("*").alias("held")).where("held > 1"), "held")
    shared = tokens.join(held, "token").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("held", "token"))).alias("order"))
    sized = shared.join(crowd, "id")
    # shingles that no other one holds come first and match nothing: they only move the others back
    alone = (F.col("n") - F.size("order")).cast("int")
    last = (F.col("n") - F.ceil(F.lit(percent) * F.col("n") / 100)).cast("int")
    # missing if the prefix has only shingles of its own: it has no rows below then
    end = F.get("order", last - alone)
    end = (F.shiftleft(F.least(end["held"], F.lit((1 << 20) - 1)).cast("int"), 11) + F.shiftrightunsigned(end["token"], 53).cast("int")).cast("int")
    rows = sized.select("id", "n", alone.alias("alone"), end.alias("end"), F.posexplode("order").alias("at", "x"))
    rows = rows.select(F.lit(1).alias("kind"), F.col("x.token").alias("token"), "id", "n", (F.col("at") + F.col("alone")).cast("int").alias("pos"), "end")
    rows = steps.keep(rows.where(F.col("pos") <= F.col("n") - F.ceil(F.lit(percent) * F.col("n") / 100)), "second")
    steps.drop(tokens, held)
    return rows


def classes(steps: Steps, docs: DataFrame, text: str, identifier: str, width: int, percent: int) -> DataFrame:
    """(id, n, digest, prefix, end) of each row with an identifier; equal digests are equal sets."""
    rows = docs.select(F.col(identifier).cast("long").alias("id"), F.col(text).alias("text")).where("id is not null")
    parts = rows.mapInPandas(_counts(width), "part int, tokens binary, times binary").groupBy("part")
    counted = steps.keep(parts.applyInPandas(_frequent, "token long, n long"), "counted")
    common = most_frequent(counted, "n", FREQUENT_MOST).select("token").toPandas()["token"].to_numpy(np.int64)
    frequent = docs.sparkSession.sparkContext.broadcast(np.sort(common.view(np.uint64)))
    steps.drop(counted)
    return steps.keep(rows.mapInPandas(_prefixes(width, percent, frequent), "id long, n long, digest binary, prefix array<long>, end int"), "classes")


def join(docs: DataFrame, text: str = "text", identifier: str = "doc_id", width: int = 3, percent: int = 90) -> DataFrame:
    """One row for each row of ``docs``: ``identifier``, n_shingles, component_id (smallest identifier that links lead to)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    with Steps(spark, "jaccard") as steps:
        own, heads, links = _links(steps, docs, text, identifier, width, percent)
        parts = stable(components(links).select(F.col("node").alias("head"), "component"))
        named = own.join(heads, "digest", "left").join(parts, "head", "left")
        found = stable(named.select(F.col("id").alias(identifier), F.col("n").cast("long").alias("n_shingles"), F.coalesce("component", "head", "id").alias("component_id")))
    nameless = docs.where(F.col(identifier).isNull()).select(F.col(identifier), F.col(text).alias("text"))
    blank = nameless.mapInPandas(_sizes(width), "n long").select(F.lit(None).cast("long").alias(identifier), F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("component_id"))
    return found.unionByName(blank)


def _links(steps: Steps, docs: DataFrame, text: str, identifier: str, width: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(id, n, digest) of all rows, (digest, head) of their classes, and links (a, b) between heads that give all components."""
    every = classes(steps, docs, text, identifier, width, percent)
    # tables of their own: a join with them can then be split where one key has very many rows; so below
    heads = steps.keep(every.where("n > 0").groupBy("digest").agg(F.min("id").alias("head")), "heads")
    first = every.join(heads, "digest").where("id = head").select("id", "n", "end", "prefix").dropDuplicates(["id", "n"])
    first = steps.keep(first, "first")
    own = steps.keep(every.select("id", "n", "digest"), "own")
    steps.drop(every)

    rows = first.select("id", F.explode("prefix").alias("token"))
    crowded = steps.keep(rows.groupBy("token").agg(F.count("*").alias("size")).where("size > 1").select("token"), "crowded")
    shared = steps.keep(rows.join(crowded, "token").groupBy("id").agg(F.count("*").alias("shared")), "shared")
    least = F.greatest(F.lit(1), F.floor(F.lit(SHARED) * F.ceil(F.lit(percent) * F.col("n") / 100)))
    candidates = steps.keep(first.select("id", "n").join(shared, "id").where(F.col("shared") >= least).select("id"), "candidates")
    steps.drop(crowded, shared)

    rows = _only(first, candidates).select(F.lit(0).alias("kind"), F.posexplode("prefix").alias("pos", "token"), "id", "n", "end")
    rows = rows.where(F.col("pos") <= F.col("n") - F.ceil(F.lit(percent) * F.col("n") / 100))
    sizes = steps.keep(rows.groupBy("token").agg(F.count("*").alias("size")).where("size > 1"), "sizes")
    rows = steps.keep(rows.join(sizes, "token").select("kind", "token", "id", "n", "pos", "end", "size"), "rows")
    steps.drop(first, candidates, sizes)

    texts = _only(docs.select(F.col(identifier).cast("long").alias("id"), F.col(text).alias("text")), rows.select("id").distinct())
    sets = steps.keep(texts.mapInPandas(_sets(width), "id long, tokens binary, marks binary"), "sets")
    crowd = steps.keep(rows.where(F.col("size") > BUCKET).select("id", "n").distinct(), "crowd")
    second = _second_order(steps, crowd, sets, percent)
    placed = steps.keep(rows.where(F.col("size") <= BUCKET).drop("size").unionByName(second), "placed")
    steps.drop(rows, crowd, second)

    key = ["kind", "token"]
    place = F.struct("pos", "n", "id")
    leader = placed.groupBy(*key).agg(F.min(place).alias("lead"), F.count("*").alias("size")).where("size > 1")
    leader = steps.keep(leader.select(*key, F.col("lead.id").alias("id"), F.col("lead.n").alias("n"), F.col("lead.pos").alias("pos")), "leader")
    led = placed.alias("a").join(leader.alias("b"), key).where((F.col("a.id") != F.col("b.id")) & _bounds(percent))
    pairs = steps.keep(led.select(F.col("a.id").alias("a"), F.col("b.id").alias("b"), F.col("a.n").alias("na"), F.col("b.n").alias("nb")).distinct(), "led")
    steps.drop(leader)
    near = _verified(steps, pairs, sets, percent)
    steps.drop(pairs)

    grouped = placed.join(components(near).withColumnRenamed("node", "id"), "id", "left")
    grouped = steps.keep(grouped.withColumn("group", F.coalesce("component", "id")).drop("component"), "grouped")
    steps.drop(placed)
    matrix = grouped.groupBy(*key, "group").agg(
        F.min("n").alias("n_min"), F.max("n").alias("n_max"), F.max(F.col("n") - F.col("pos")).alias("rest"))
    matrix = steps.keep(matrix, "matrix")
    # a group whose overlap with the smallest set that it can link to is out of reach takes no part
    several = steps.keep(matrix.groupBy(*key).agg(F.count("*").alias("groups"), F.min("n_min").alias("n_least")).where("groups > 1").drop("groups"), "several")
    partner = F.greatest(F.col("n_least"), F.ceil(F.lit(percent) * F.col("n_min") / 100))
    reach = F.ceil(F.lit(percent) * (F.col("n_min") + partner) / (100 + percent)) <= F.col("rest")
    able = steps.keep(matrix.join(several, key).where(reach).drop("n_least"), "able")
    steps.drop(matrix)
    # rows under a shingle that only one group has meet nothing
    grouped, every = steps.keep(grouped.join(several.select(*key), key, "left_semi"), "meeting"), grouped
    steps.drop(every, several)
    least = F.ceil(F.lit(percent) * (F.col("a.n_min") + F.col("b.n_min")) / (100 + percent))
    qualify = (
        (F.col("a.group") < F.col("b.group"))
        & (least <= F.least("a.rest", "b.rest"))
        & (F.lit(percent) * F.col("a.n_min") <= 100 * F.col("b.n_max")) & (F.lit(percent) * F.col("b.n_min") <= 100 * F.col("a.n_max"))
    )
    opened = able.alias("a").join(able.alias("b"), key).where(qualify)
    opened = steps.keep(opened.select(F.col("a.group").alias("group"), F.col("b.group").alias("other")).distinct(), "opened")
    steps.drop(able)
    # the smaller group of a pair looks for the other: a family of copies is not repeated for each single document next to it
    weight = steps.keep(grouped.groupBy("group").agg(F.count("*").alias("weight")), "weight")
    weighed = opened.join(weight, "group").join(weight.select(F.col("group").alias("other"), F.col("weight").alias("other_weight")), "other")
    swap = F.col("weight") > F.col("other_weight")
    turned = weighed.select(F.when(swap, F.col("other")).otherwise(F.col("group")).alias("group"), F.when(swap, F.col("group")).otherwise(F.col("other")).alias("other"))
    turned = steps.keep(turned, "turned")
    steps.drop(opened, weight)
    members = grouped.join(turned, "group").alias("a")
    met = members.join(grouped.alias("b"), [F.col("a.other") == F.col("b.group"), *[F.col(f"a.{k}") == F.col(f"b.{k}") for k in key]])
    met = steps.keep(_reaching(met.where(_sizes_fit(percent)), percent), "met")
    steps.drop(grouped, turned)
    return own, heads, near.unionByName(_verified(steps, met, sets, percent))


def _sizes(width: int):
    def sizes(batches):
        for pdf in batches:
            yield pd.DataFrame({"n": [len(shingles(t, width)) for t in pdf["text"]]})

    return sizes
