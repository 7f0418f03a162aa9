"""Exact ordered operators that never put one key into one task.

A window partitioned by a hot key would send a third of a table to a single task. Here rows are
range-partitioned on the whole order instead, so a hot key spreads over many blocks, and only
one summary row per key and block crosses block borders.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from pitpanel.operators.joins import join_same
from pitpanel.session import shuffle_partitions, stable

BLOCK = "_block"
SLAB_ROWS = 50_000


def range_blocks(df: DataFrame, order: Sequence[str], n_blocks: int | None = None) -> DataFrame:
    """Add ``_block``: contiguous, balanced runs of ``order`` (which should be unique).

    The block number is the range partition a row landed in, so it is written down with a
    checkpoint: a recomputed task must see the same borders.
    """
    n = n_blocks or shuffle_partitions(df)
    return stable(df.repartitionByRange(n, *order).withColumn(BLOCK, F.spark_partition_id()))


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    totals: Mapping[str, str],
    n_blocks: int | None = None,
) -> DataFrame:
    """Exact inclusive running sums per key: ``{output column: summed column}``; null until the first value.

    Inside a block by a window, across blocks by the block sums before it (at most ``n_blocks``
    rows per key). A frame that already carries ``_block`` for this order is used as it is.
    """
    laid = df if BLOCK in df.columns else range_blocks(df, [*keys, *order], n_blocks)
    before = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    sums = laid.groupBy(*keys, BLOCK).agg(*[F.sum(c).alias(f"_s_{n}") for n, c in totals.items()])
    sums = sums.select(
        *keys, BLOCK, *[F.sum(f"_s_{n}").over(before).alias(f"_b_{n}") for n in totals]
    )
    inside = Window.partitionBy(*keys, BLOCK).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = laid.withColumns({f"_w_{n}": F.sum(c).over(inside) for n, c in totals.items()})
    out = join_same(out, sums, [*keys, BLOCK])
    kept = [c for c in df.columns if c != BLOCK]
    zero = F.lit(0)
    return out.select(*kept, *[
        F.when(F.coalesce(f"_w_{n}", f"_b_{n}").isNotNull(), F.coalesce(f"_w_{n}", zero) + F.coalesce(f"_b_{n}", zero)).alias(n)
        for n in totals
    ])


def row_positions(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "_pos",
                  n_blocks: int | None = None) -> DataFrame:
    """1-based exact position of every row inside its key."""
    counted = df.withColumn("_one", F.lit(1).cast("long"))
    return running_totals(counted, keys, order, {name: "_one"}, n_blocks).drop("_one")


def fill_forward(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Sequence[str],
    rank: bool = False,
    n_blocks: int | None = None,
) -> DataFrame:
    """Forward fill across blocks: last non-null inside the block, else the carry from earlier ones.

    ``rank`` adds ``_k_{column}``, the number of filled rows of the key up to and including this one.
    """
    laid = range_blocks(df, [*keys, *order], n_blocks)
    position = F.struct(*order)
    before = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy(*keys, BLOCK).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    ends = laid.groupBy(*keys, BLOCK).agg(
        F.count("*").alias("_rows"),
        *[F.max_by(c, F.when(F.col(c).isNotNull(), position)).alias(f"_e_{c}") for c in columns],
    )
    carry = ends.select(
        *keys, BLOCK, *[F.last(f"_e_{c}", ignorenulls=True).over(before).alias(f"_c_{c}") for c in columns]
    )
    out = laid.withColumns({f"_f_{c}": F.last(c, ignorenulls=True).over(inside) for c in columns})
    out = join_same(out, carry, [*keys, BLOCK])
    filled = out.select(
        *[F.coalesce(f"_f_{c}", f"_c_{c}").alias(c) if c in columns else F.col(c) for c in df.columns], BLOCK)
    if not rank:
        return filled.drop(BLOCK)
    return running_totals(
        filled.withColumns({f"_o_{c}": F.col(c).isNotNull().cast("long") for c in columns}),
        keys, order, {f"_k_{c}": f"_o_{c}" for c in columns},
    ).drop(*[f"_o_{c}" for c in columns])


def fill_forward_and_lead(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str], lead: Sequence[str],
                          first_valid: int = 10, n_blocks: int | None = None) -> DataFrame:
    """Forward fill of ``columns``; what is still missing in ``lead`` gets the median of the key's first ``first_valid`` filled values.

    Rows are read twice: once for a summary of each key and block, with its last value, its number of rows with and without a
    value so far, and its first few filled values; once for the result. From the summaries alone follow, in one
    window, the value that is carried into a block and the first values of the key, wherever its blocks begin.
    """
    laid = range_blocks(df, [*keys, *order], n_blocks)
    position = F.struct(*order)
    inside = Window.partitionBy(*keys, BLOCK).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    filled = laid.withColumns({f"_f_{c}": F.last(c, ignorenulls=True).over(inside) for c in columns})
    ranked = filled.withColumns({f"_k_{c}": F.count(f"_f_{c}").over(inside) for c in lead})
    few = lambda c: F.when(F.col(f"_f_{c}").isNotNull() & (F.col(f"_k_{c}") <= first_valid), F.struct(F.col(f"_k_{c}").alias("k"), F.col(f"_f_{c}").cast("double").alias("v")))
    ends = ranked.groupBy(*keys, BLOCK).agg(
        F.count("*").alias("_rows"), *[F.max_by(c, F.when(F.col(c).isNotNull(), position)).alias(f"_e_{c}") for c in columns],
        *[F.count(f"_f_{c}").alias(f"_n_{c}") for c in lead], *[F.collect_list(few(c)).alias(f"_a_{c}") for c in lead])
    before = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    carry = ends.withColumns({f"_c_{c}": F.last(f"_e_{c}", ignorenulls=True).over(before) for c in columns})
    nothing = F.array().cast("array<double>")

    def first_values(c: str) -> Column:
        carried = F.when(F.col(f"_c_{c}").isNotNull(), F.array_repeat(F.col(f"_c_{c}").cast("double"), F.least(F.col("_rows") - F.col(f"_n_{c}"), F.lit(first_valid)).cast("int")))
        own = F.transform(F.array_sort(f"_a_{c}"), lambda x: x["v"])
        return F.struct(F.col(BLOCK).alias("b"), F.concat(F.coalesce(carried, nothing), own).alias("v"))

    listed = carry.withColumns({f"_l_{c}": F.collect_list(first_values(c)).over(whole) for c in lead})

    def median(c: str) -> Column:
        first = F.array_sort(F.slice(F.flatten(F.transform(F.array_sort(f"_l_{c}"), lambda x: x["v"])), 1, first_valid))
        at = lambda k: F.element_at(first, (F.floor(k / 2) + 1).cast("int"))
        return F.when(F.size(first) > 0, at(F.size(first) - 1) * 0.5 + at(F.size(first)) * 0.5)

    carry = listed.select(*keys, BLOCK, *[f"_c_{c}" for c in columns], *[median(c).alias(f"_m_{c}") for c in lead])
    out = join_same(filled, carry, [*keys, BLOCK])
    return out.select(*[
        F.coalesce(f"_f_{c}", f"_c_{c}", *([f"_m_{c}"] if c in lead else [])).alias(c) if c in columns else F.col(c) for c in df.columns])


def with_halo(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    lookback: int,
    build: Callable[[WindowSpec], Mapping[str, Column] | Sequence[Mapping[str, Column]]],
    slab_rows: int = SLAB_ROWS,
    n_blocks: int | None = None,
    lookahead: int = 0,
) -> DataFrame:
    """Row-count windows (lag, lead, rolling) that look back at most ``lookback`` and ahead at most ``lookahead`` rows.

    Each key is cut into slabs of ``slab_rows`` consecutive rows; the last ``lookback`` rows of a
    slab are copied to the next one, its first ``lookahead`` rows to the one before, so every window sees
    the rows it needs and no group exceeds ``slab_rows + lookback + lookahead`` rows. ``build(window)``
    returns the new columns, or several sets of columns that build on each other; the ordered window it
    gets has no frame, so it may set its own.
    """
    slab_rows = max(slab_rows, lookback, lookahead)
    placed = row_positions(df, keys, order, "_pos", n_blocks)
    at = F.col("_pos") - 1
    slab = F.floor(at / slab_rows)
    own = F.struct(slab.alias("slab"), F.lit(False).alias("halo"))
    copy = F.struct((slab + 1).alias("slab"), F.lit(True).alias("halo"))
    back = F.struct((slab - 1).alias("slab"), F.lit(True).alias("halo"))
    in_tail = (at % slab_rows) >= slab_rows - lookback
    in_head = ((at % slab_rows) < lookahead) & (slab > 0)
    spread = placed.withColumn("_to", F.explode(F.array_compact(F.array(own, F.when(in_tail, copy), F.when(in_head, back)))))
    spread = spread.withColumns({"_slab": F.col("_to.slab"), "_halo": F.col("_to.halo")})
    window = Window.partitionBy(*keys, "_slab").orderBy("_pos")
    built = build(window)
    out = spread
    for columns in [built] if isinstance(built, Mapping) else built:
        out = out.withColumns(dict(columns))
    return out.filter(~F.col("_halo")).drop("_to", "_slab", "_halo", "_pos")
