"""Token counts: an exact histogram of encoded lengths, from which suffix sums answer every context limit.

Documents are counted by length before anything is shuffled, so what follows is as large as the number of different
lengths. That histogram is sorted in ranges; each range adds the sums of the ranges above it. For a limit L the total of
all lengths cut at L is the tokens of shorter documents plus L for every other one, so one row for each length answers
totals, quantiles and truncated totals; between two lengths the truncated total is linear in L.

Null text counts as empty, length 0. An empty table gives an empty histogram. Repeated rows count one by one; other
columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pitpanel.session import shuffle_partitions, stable


def histogram(rows: DataFrame, length: Column) -> DataFrame:
    """(length, n_docs, n_tokens, docs_from, tokens_from, docs_below, tokens_below, truncated_total, share_to).

    ``*_from`` are the suffix sums over this length and longer ones, ``truncated_total`` is the sum of all lengths cut at
    this one, ``share_to`` the share of documents of at most this length.
    """
    counted = rows.select(length.cast("long").alias("length")).groupBy("length").agg(F.count("*").alias("n_docs"))
    counted = counted.withColumn("n_tokens", F.col("length") * F.col("n_docs"))
    ranges = stable(counted.repartitionByRange(shuffle_partitions(counted), "length").withColumn("part", F.spark_partition_id()))
    # one row for each range; all of them are one small window
    above = Window.orderBy(F.desc("part")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.desc("part")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sums = ranges.groupBy("part").agg(F.sum("n_docs").alias("d"), F.sum("n_tokens").alias("t"))
    sums = sums.select(
        "part", *[F.coalesce(F.sum(c).over(above), F.lit(0)).alias(f"{c}_above") for c in "dt"],
        *[F.sum(c).over(everything).alias(f"{c}_all") for c in "dt"])
    longer = Window.partitionBy("part").orderBy(F.desc("length"))
    out = ranges.join(sums, "part")
    out = out.withColumn("docs_from", F.sum("n_docs").over(longer) + F.col("d_above"))
    out = out.withColumn("tokens_from", F.sum("n_tokens").over(longer) + F.col("t_above"))
    below = (F.col("d_all") - F.col("docs_from")), (F.col("t_all") - F.col("tokens_from"))
    return out.select(
        "length", "n_docs", "n_tokens", "docs_from", "tokens_from", below[0].alias("docs_below"), below[1].alias("tokens_below"),
        (below[1] + F.col("length") * F.col("docs_from")).alias("truncated_total"),
        ((below[0] + F.col("n_docs")) / F.col("d_all")).alias("share_to"),
    )


def at_limits(table: DataFrame, limits: Sequence[int]) -> DataFrame:
    """(limit, docs_cut, truncated_total) for any limits: documents longer than the limit, total of all lengths cut at it."""
    asked = [F.struct(F.lit(int(x)).cast("long").alias("limit"), F.sum(F.when(F.col("length") > int(x), F.col("n_docs")).otherwise(0)).alias("docs_cut"),
                      F.sum(F.least(F.col("length"), F.lit(int(x))) * F.col("n_docs")).alias("truncated_total")) for x in limits]
    return table.agg(F.array(*asked).alias("a")).select(F.inline("a"))


def quantiles(table: DataFrame, shares: Sequence[float]) -> DataFrame:
    """(share, length) with the smallest length that at least this share of documents does not exceed."""
    asked = [F.struct(F.lit(float(q)).alias("share"), F.min(F.when(F.col("share_to") >= q, F.col("length"))).alias("length")) for q in shares]
    return table.agg(F.array(*asked).alias("a")).select(F.inline("a"))
