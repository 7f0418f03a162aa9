"""Line dedup: later copies of runs of lines are deleted, found with a suffix array over line numbers.

Each document is the sequence of its lines that are not blank, trimmed. Lines that occur once cannot be part of a copy,
so only *islands* of consecutive repeated lines are sorted. Prefix doubling ranks their suffixes: the rank for 2^k lines
orders the pairs (rank for 2^(k-1) lines here, the same 2^(k-1) lines further on). Ranks come from a range-partitioned
sort of the *distinct* pairs, so a pair that stands in a third of all documents is one row there; pairs that occur once
drop out. All suffixes that share a window of n lines form one longest-common-prefix interval, and the ranks for 2^k
lines at its two ends (2^k <= n) name that interval. Its first suffix, in order of document and line, is the original,
the others are copies.

A line is deleted exactly if a run of consecutive lines with it, of ``min_words`` words at least, also occurs earlier.
It is enough to look at the runs that are minimal from their first or to their last line: whatever a longer repeated run
covers, such runs inside it cover too. They have at most ``min_words`` lines, so log2(min_words) rounds suffice at any
size of the corpus.

Null and empty texts have no lines and stay as they are; blank lines stay. Documents are ordered by identifier (null
first) and a checksum of the text; rows that repeat both are one document and all get the same result. A document can
lose all its lines: its text is then what blank lines leave. Other columns are carried along unchanged.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pitpanel.llm.common import release
from pitpanel.session import shuffle_partitions, stable

#: Passages of this many words count as copied.
MIN_WORDS = 50
_BLANK = " \t\r"
_KEY = ["id", "th"]


def _lines(docs: DataFrame, text: str, identifier: str) -> DataFrame:
    """(id, th, at, raw, h1, h2, words): ``at`` counts lines that are not blank, ``raw`` all of them."""
    pieces = F.transform(F.split(F.col("text"), "\n", -1), lambda x, i: F.struct(i.alias("raw"), F.btrim(x, F.lit(_BLANK)).alias("line")))
    rows = docs.select(F.col(identifier).alias("id"), F.col(text).alias("text"))
    rows = rows.select("id", F.xxhash64("text").alias("th"), F.posexplode(F.filter(pieces, lambda p: p["line"] != "")).alias("at", "p"))
    return rows.select(
        "id", "th", "at", F.col("p.raw").alias("raw"),
        F.xxhash64("p.line").alias("h1"), F.xxhash64(F.lit(7), "p.line").alias("h2"),
        F.size(F.split("p.line", f"[{_BLANK}]+", -1)).alias("words"),
    )


def _ranked(keys: DataFrame, columns: list[str]) -> DataFrame:
    """``keys`` (distinct) plus ``rank``, which ascends with them; checkpointed, so that ranks never change."""
    n = shuffle_partitions(keys)
    return stable(keys.repartitionByRange(n, *columns).sortWithinPartitions(*columns).withColumn("rank", F.monotonically_increasing_id()))


def _windows(lines: DataFrame, min_words: int) -> DataFrame:
    """Runs (id, th, start, n) of repeated lines with min_words words or more, minimal from their first or to their last line."""
    island = Window.partitionBy(*_KEY, "island")
    ahead = island.orderBy("before").rangeBetween(0, min_words - 1)
    behind = island.orderBy("after").rangeBetween(1 - min_words, 0)
    sums = lines.withColumn("after", F.sum("words").over(island.orderBy("at"))).withColumn("before", F.col("after") - F.col("words"))
    sums = sums.select(
        *_KEY, "at", "after",
        F.count("*").over(ahead).cast("int").alias("forward"), F.count("*").over(behind).cast("int").alias("back"),
        (F.sum("words").over(island) - F.col("before") >= min_words).alias("enough"),
    )
    runs = F.array(
        F.when(F.col("enough"), F.struct(F.col("at").alias("start"), F.col("forward").alias("n"))),
        F.when(F.col("after") >= min_words, F.struct((F.col("at") - F.col("back") + 1).alias("start"), F.col("back").alias("n"))),
    )
    return sums.select(*_KEY, F.explode(F.array_distinct(F.array_compact(runs))).alias("r")).select(*_KEY, "r.start", "r.n")


def _same(a: str, b: str, more: list[str]):
    """Join condition on the document and further columns; identifiers can be null."""
    return reduce(lambda x, y: x & y, [F.col(f"{a}.id").eqNullSafe(F.col(f"{b}.id")), F.col(f"{a}.th") == F.col(f"{b}.th")] + [F.col(f"{a}.{c}") == F.col(f"{b}.{c}") for c in more])


def suffix_ranks(lines: DataFrame, levels: int) -> list[DataFrame]:
    """For k = 0..levels the ranks (id, th, at, rank) of runs of 2^k lines that occur more than once.

    ``lines`` has (id, th, at, rank) of the repeated lines. Runs of 2^k lines from ``at`` and from 2^k lines further
    on, both repeated, meet without a gap.
    """
    out = [lines.select(*_KEY, "at", "rank")]
    for k in range(levels):
        follow = out[-1].select(*_KEY, (F.col("at") - (1 << k)).alias("at"), F.col("rank").alias("second"))
        pairs = out[-1].alias("a").join(follow.alias("b"), _same("a", "b", ["at"])).select("a.*", "b.second")
        pairs = pairs.withColumnRenamed("rank", "first")
        repeated = pairs.groupBy("first", "second").agg(F.count("*").alias("copies")).where("copies > 1").select("first", "second")
        ranks = _ranked(repeated, ["first", "second"])
        out.append(stable(pairs.join(ranks, ["first", "second"]).select(*_KEY, "at", "rank")))
    return out


def copies(docs: DataFrame, text: str = "text", identifier: str = "doc_id", min_words: int = MIN_WORDS) -> DataFrame:
    """(id, th, removed): for each document with copied lines the numbers of those lines, blank ones counted."""
    lines = stable(_lines(docs, text, identifier))
    repeated = lines.groupBy("h1", "h2").agg(F.count("*").alias("copies")).where("copies > 1").select("h1", "h2")
    ranks = _ranked(repeated, ["h1", "h2"])
    # rows that repeat a whole document give the same line twice
    lines = lines.join(ranks, ["h1", "h2"]).groupBy(*_KEY, "at").agg(*[F.min(c).alias(c) for c in ("raw", "words", "rank")])
    lines = stable(lines.withColumn("island", F.col("at") - F.row_number().over(Window.partitionBy(*_KEY).orderBy("at"))))
    runs = stable(_windows(lines, min_words))
    longest = runs.agg(F.max("n")).first()[0] or 1
    tables = suffix_ranks(lines, longest.bit_length() - 1)
    level = F.floor(F.log2(F.col("n") + 0.5)).cast("int")
    runs = runs.select("*", level.alias("k")).select("*", (F.col("start") + F.col("n") - F.expr("shiftleft(1, k)")).alias("last"))
    ranked = reduce(DataFrame.unionByName, [t.select(*_KEY, "at", "rank", F.lit(k).alias("k")) for k, t in enumerate(tables)])
    for side, at in (("left", "start"), ("right", "last")):
        found = ranked.select(*_KEY, "k", F.col("at").alias(at), F.col("rank").alias(side))
        runs = runs.alias("a").join(found.alias("b"), _same("a", "b", ["k", at])).select("a.*", f"b.{side}")
    runs = stable(runs)
    interval = ["n", "left", "right"]
    place = F.struct("id", "th", "start")
    # a table of its own, so that a join with it can be split where one interval has very many suffixes
    firsts = stable(runs.groupBy(*interval).agg(F.min(place).alias("original"), F.count("*").alias("copies")).where("copies > 1").drop("copies"))
    later = runs.join(firsts, interval).where(~place.eqNullSafe(F.col("original")))
    covered = later.select(*_KEY, F.explode(F.sequence("start", F.col("start") + F.col("n") - 1)).alias("at")).distinct()
    covered = covered.alias("a").join(lines.alias("b"), _same("a", "b", ["at"])).select("a.*", "b.raw")
    return covered.groupBy(*_KEY).agg(F.collect_set("raw").alias("removed"))


def dedup(docs: DataFrame, text: str = "text", identifier: str = "doc_id", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with copied lines deleted from ``text``, plus struct ``line_dedup`` (n_lines, n_removed; blank lines do not count)."""
    removed = stable(copies(docs, text, identifier, min_words))
    release(docs.sparkSession)
    removed = removed.select(F.col("id").alias("__id"), F.col("th").alias("__th"), F.col("removed").alias("__removed"))
    rows = docs.select("*", F.col(identifier).alias("__own"), F.xxhash64(F.col(text)).alias("__hash"))
    rows = rows.join(removed, F.col("__own").eqNullSafe(F.col("__id")) & (F.col("__hash") == F.col("__th")), "left")
    lines, gone = F.split(F.col(text), "\n", -1), F.col("__removed")
    left = F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone), lambda i: lines[i])
    n_lines = F.size(F.filter(lines, lambda x: F.btrim(x, F.lit(_BLANK)) != ""))
    figures = F.struct(F.greatest(n_lines, F.lit(0)).cast("long").alias("n_lines"), F.greatest(F.size(gone), F.lit(0)).cast("long").alias("n_removed"))
    cleaned = F.when(gone.isNull(), F.col(text)).otherwise(F.array_join(left, "\n"))
    return rows.select(*[cleaned.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns], figures.alias("line_dedup"))
