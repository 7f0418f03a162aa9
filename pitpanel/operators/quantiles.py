"""Exact quantiles with linear interpolation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitpanel.operators.blocks import range_blocks, running_totals
from pitpanel.operators.joins import join_checked, join_same
from pitpanel.session import stable

#: Accuracy of the sketches that bracket quantiles: ranks are off by a share of 1 / SKETCH at most.
SKETCH = 10_000


def quantile_name(column: str, p: float) -> str:
    return f"{column}_q{str(p).replace('0.', '', 1) if p < 1 else '1'}"


def grouped_quantiles(df: DataFrame, by: Sequence[str], columns: Sequence[str], probs: Sequence[float],
                      counts: bool = False) -> DataFrame:
    """One row per group. For groups whose size is bounded (one entity of a daily panel, or a
    date-keyed table): ``percentile`` keeps the distinct values of a group in one buffer.
    """
    aggs: list[Column] = []
    for c in columns:
        q = F.percentile(F.col(c).cast("double"), F.array(*[F.lit(p) for p in probs]))
        aggs += [q[i].alias(quantile_name(c, p)) for i, p in enumerate(probs)]
        if counts:
            aggs.append(F.count(c).alias(f"{c}_n"))
    return df.groupBy(*by).agg(*aggs)


def approximate_quantiles(df: DataFrame, by: Sequence[str], columns: Sequence[str], probs: Sequence[float],
                          accuracy: int = 10_000) -> DataFrame:
    """Like ``grouped_quantiles`` from mergeable sketches of fixed size: one pass for groups of any size.

    The rank of each result is off by at most ``rows / accuracy``.
    """
    aggs: list[Column] = []
    for c in columns:
        q = F.percentile_approx(F.col(c).cast("double"), [float(p) for p in probs], accuracy)
        aggs += [q[i].alias(quantile_name(c, p)) for i, p in enumerate(probs)]
    return df.groupBy(*by).agg(*aggs)


def large_quantiles(df: DataFrame, by: Sequence[str], columns: Sequence[str], probs: Sequence[float],
                    n_blocks: int | None = None) -> DataFrame:
    """Long result ``by..., column, n, p, value`` for groups of any size.

    Equal values are counted first (combined map-side), the counts get an exact distributed
    running total, and each quantile is read from the two ranks around it.
    """
    long = df.select(
        *by,
        F.explode(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns
        ])).alias("_cv"),
    ).select(*by, "_cv.column", "_cv.value").filter(F.col("value").isNotNull())
    counted = long.groupBy(*by, "column", "value").agg(F.count("*").alias("_n"))
    laid = range_blocks(counted, [*by, "column", "value"], n_blocks)
    cdf = running_totals(laid, [*by, "column"], ["value"], {"_hi": "_n"})
    totals = laid.groupBy(*by, "column").agg(F.sum("_n").alias("n"))
    wanted_ranks = F.array(*[
        F.struct(F.lit(float(p)).alias("p"), (F.lit(float(p)) * (F.col("n") - 1)).alias("_h")) for p in probs])
    # the ranks travel as one array per group: a distinct value meets its group once, not once per quantile
    hit = join_checked(cdf, totals.withColumn("_ranks", wanted_ranks), [*by, "column"], "inner")
    low = F.col("_hi") - F.col("_n")

    def covers(rank: Column) -> Column:
        return (rank >= low) & (rank < F.col("_hi"))

    wanted = F.filter("_ranks", lambda r: covers(F.floor(r["_h"])) | covers(F.floor(r["_h"]) + 1))
    hit = hit.withColumn("_r", F.explode(wanted))
    rank = F.floor(F.col("_r._h"))
    picked = hit.groupBy(*by, "column", "n", F.col("_r.p").alias("p"), F.col("_r._h").alias("_h")).agg(
        F.max(F.when(covers(rank), F.col("value"))).alias("_v0"),
        F.max(F.when(covers(rank + 1), F.col("value"))).alias("_v1"),
    )
    share = F.col("_h") - F.floor("_h")
    value = F.when(share > 0, F.col("_v0") + share * (F.col("_v1") - F.col("_v0"))).otherwise(F.col("_v0"))
    return picked.select(*by, "column", "n", "p", value.alias("value"))


def bracketed_quantiles(df: DataFrame, by: Sequence[str], columns: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Long result ``by..., column, n, p, value`` for groups of any size, exact, without sorting all values.

    A mergeable sketch of fixed size brackets each quantile between two values of the group. A second pass counts
    exactly how many values are below the bracket, and keeps only those inside, some thousandth of all; the ranks
    looked for are read among these. Counts tell whether a bracket held its ranks; should one have missed them,
    its groups are done by ``large_quantiles``. With keys, groups of up to SKETCH rows take neither: their values are sorted in one aggregate.
    """
    by = list(by)
    if not by:
        return _bracketed(df, by, columns, probs)
    many = stable(df.groupBy(*by).agg(F.count("*").alias("_rows")).where(F.col("_rows") > SKETCH).select(*by, F.lit(True).alias("_many")))
    if many.isEmpty():
        return _sorted_quantiles(df, by, columns, probs)
    told = join_checked(df.select(*by, *columns), many, by)
    few = _sorted_quantiles(told.where("_many is null"), by, columns, probs)
    return few.unionByName(_bracketed(told.where("_many").drop("_many"), by, columns, probs))


def _sorted_quantiles(df: DataFrame, by: Sequence[str], columns: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """``bracketed_quantiles`` of groups of at most SKETCH rows, from the sorted values of each."""
    values = df.groupBy(*by).agg(*[F.sort_array(F.collect_list(F.col(c).cast("double"))).alias(f"_v{i}") for i, c in enumerate(columns)])

    def quantile(v: str, p: float) -> Column:
        rank = F.lit(p) * (F.size(v) - 1)
        low, share = F.floor(rank), rank - F.floor(rank)
        at = lambda k: F.get(v, k.cast("int"))
        return F.when(share > 0, at(low) + share * (at(low + 1) - at(low))).otherwise(at(low))

    cells = [F.struct(F.lit(c).alias("column"), F.size(f"_v{i}").cast("long").alias("n"), F.lit(float(p)).alias("p"), quantile(f"_v{i}", float(p)).alias("value"))
             for i, c in enumerate(columns) for p in probs]
    return values.select(*by, F.inline(F.array(*cells))).where("n > 0")


def _bracketed(df: DataFrame, by: list[str], columns: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """The brackets of ``bracketed_quantiles``. Groups of up to SKETCH values are bracketed by their extremes."""
    margin = 4.0 / SKETCH
    cells = [(c, float(p)) for c in columns for p in probs]
    value = {c: F.col(c).cast("double") for c in columns}
    aggs = []
    for c in columns:
        edges = [min(max(p + d, 0.0), 1.0) for p in map(float, probs) for d in (-margin, margin)]
        aggs += [F.count(c).alias(f"n_{c}"), F.min(value[c]).alias(f"min_{c}"), F.max(value[c]).alias(f"max_{c}"),
                 F.percentile_approx(value[c], edges, SKETCH).alias(f"edges_{c}")]
    sketch = df.groupBy(*by).agg(*aggs)
    brackets = []
    for k, (c, p) in enumerate(cells):
        at = 2 * (k % len(probs))
        few = F.col(f"n_{c}") <= SKETCH
        brackets += [F.when(few | F.lit(p <= margin), F.col(f"min_{c}")).otherwise(F.col(f"edges_{c}")[at]).alias(f"lo{k}"),
                     F.when(few | F.lit(p >= 1 - margin), F.col(f"max_{c}")).otherwise(F.col(f"edges_{c}")[at + 1]).alias(f"hi{k}")]
    sketch = stable(sketch.select(*by, F.struct(*brackets, *[f"n_{c}" for c in columns]).alias("_b")))
    narrow = df.select(*by, *[value[c].alias(f"_v{i}") for i, c in enumerate(columns)])
    placed = join_checked(narrow, sketch, by, "inner") if by else narrow.withColumn("_b", sketch.select("_b").scalar())
    at_cell = [f"_v{columns.index(c)}" for c, _ in cells]
    below = placed.groupBy(*by).agg(*[F.coalesce(F.sum((F.col(v) < F.col(f"_b.lo{k}")).cast("long")), F.lit(0)).alias(f"b{k}") for k, v in enumerate(at_cell)])
    inside = F.filter(F.array(*[
        F.struct(F.lit(k).alias("_cell"), F.col(v).alias("_value"), F.col(v).between(F.col(f"_b.lo{k}"), F.col(f"_b.hi{k}")).alias("held")) for k, v in enumerate(at_cell)
    ]), lambda x: x["held"])
    counted = placed.select(*by, F.explode(inside).alias("x")).groupBy(*by, F.col("x._cell").alias("_cell"), F.col("x._value").alias("_value")).agg(F.count("*").alias("_n"))
    cdf = running_totals(range_blocks(counted, [*by, "_cell", "_value"]), [*by, "_cell"], ["_value"], {"_hi": "_n"})
    # groups meet their ranks as one array each, as brackets did
    ranks = [F.struct(F.lit(k).alias("_cell"), F.col(f"_b.n_{c}").alias("_size"), F.lit(p).alias("_p"), (F.lit(p) * (F.col(f"_b.n_{c}") - 1)).alias("_h")) for k, (c, p) in enumerate(cells)]
    exact = join_same(below, sketch, by) if by else below.withColumn("_b", sketch.select("_b").scalar())
    wanted = exact.select(*by, F.explode(F.array(*[
        F.struct(r.alias("r"), (F.floor(r["_h"]) - F.col(f"b{k}")).alias("_rank")) for k, r in enumerate(ranks)])).alias("w"))
    wanted = stable(wanted.select(*by, "w.r.*", F.col("w._rank").alias("_rank")).where("_size > 0"))
    found = join_same(cdf, wanted, [*by, "_cell"])
    low = F.col("_hi") - F.col("_n")
    covers = lambda rank: (rank >= low) & (rank < F.col("_hi"))
    found = found.where(covers(F.col("_rank")) | covers(F.col("_rank") + 1))
    found = found.groupBy(*by, "_cell", "_h").agg(
        F.max(F.when(covers(F.col("_rank")), F.col("_value"))).alias("_v0"), F.max(F.when(covers(F.col("_rank") + 1), F.col("_value"))).alias("_v1"))
    share = F.col("_h") - F.floor("_h")
    result = F.when(share > 0, F.col("_v0") + share * (F.col("_v1") - F.col("_v0"))).otherwise(F.col("_v0"))
    both = join_same(wanted.select(*by, "_cell", F.col("_size").alias("n"), F.col("_p").alias("p")), found.select(*by, "_cell", result.alias("value")), [*by, "_cell"], "left")
    name = F.element_at(F.array(*[F.lit(c) for c, _ in cells]), F.col("_cell") + 1)
    done = stable(both.select(*by, name.alias("column"), "n", "p", "value"))
    missed = done.where("value is null")
    if missed.isEmpty():
        return done
    again = join_same(df, missed.select(*by).distinct(), by) if by else df
    redone = large_quantiles(again, by, columns, probs)
    return done.where("value is not null").unionByName(join_same(redone, missed.select(*by, "column", "p"), [*by, "column", "p"]))


def quantile_table(df: DataFrame, by: Sequence[str], columns: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """``bracketed_quantiles`` as one row per group: a column per (column, probability) and ``{column}_n``.

    A group without any value has a row too.
    """
    long = bracketed_quantiles(df, by, list(columns), probs)
    if by:
        long = long.unionByName(df.select(*by).distinct(), allowMissingColumns=True)
    return long.groupBy(*by).agg(*[
        F.max(F.when((F.col("column") == c) & (F.col("p") == float(p)), F.col("value"))).alias(quantile_name(c, p))
        for c in columns for p in probs
    ], *[F.coalesce(F.max(F.when(F.col("column") == c, F.col("n"))), F.lit(0)).alias(f"{c}_n") for c in columns])
