"""Joins, unions and the reports around them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitpanel.functions.columns import ratio
from pitpanel.operators import windows
from pitpanel.operators.joins import join_calendar, join_checked
from pitpanel.panel import Panel

MERGE_SUFFIXES = ("_x", "_y", "_fred", "_market", "_macro", "_company", "_dup", "_fin")  # fixed values


def date_range(date: str, first: str, last: str) -> Column:
    """Inclusive date bounds as plain comparisons, so they reach the Parquet scan."""
    return (F.col(date) >= F.lit(first).cast("date")) & (F.col(date) < F.date_add(F.lit(last).cast("date"), 1))


def year_range(date: str, first: int, last: int) -> Column:
    return date_range(date, f"{first}-01-01", f"{last}-12-31")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def merge_outer(left: DataFrame, right: DataFrame, on: Sequence[str], null_safe: Sequence[str] | None = None) -> DataFrame:
    """Full outer join on ``on``, also of tables that repeat a key; other columns both sides share are taken from the left.

    A NULL key matches a NULL key, unless ``null_safe`` lists other keys for which that holds. Catalyst turns a null-safe
    full outer join on equal keys into the same sort-merge join as the plain form. Tables with one row per key
    are better stacked.
    """
    null_safe = on if null_safe is None else null_safe
    shared = [c for c in right.columns if c in left.columns and c not in on]
    right = right.drop(*shared)
    if not null_safe:
        return left.join(right, list(on), "full")
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in on})
    conds = [
        F.col(k).eqNullSafe(F.col(f"_r_{k}")) if k in null_safe else F.col(k) == F.col(f"_r_{k}") for k in on
    ]
    both = left.join(renamed, reduce(lambda a, b: a & b, conds), "full")
    return both.select(*[
        F.coalesce(c, f"_r_{c}").alias(c) if c in on else F.col(c)
        for c in [*on, *[c for c in left.columns if c not in on], *[c for c in right.columns if c not in on]]
    ])


def merge_stacked(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """``merge_outer`` of two tables with one row per key: both are stacked, and one aggregate brings equal keys together.

    NULL keys meet like others. Equal keys are combined where the rows are, and rows that are partitioned by
    some of the keys stay where they are, which a full outer join never allows: its output has no known partitioning.
    A key that one side repeats fails at run time.
    """
    on = list(on)
    mine = [c for c in left.columns if c not in on]
    theirs = [c for c in right.columns if c not in on and c not in left.columns]
    kinds = {**dict(left.dtypes), **{c: t for c, t in right.dtypes if c in theirs}}

    def side(df: DataFrame, own: Sequence[str], number: int) -> DataFrame:
        cells = [F.col(c) if c in own else F.lit(None).cast(kinds[c]).alias(c) for c in [*mine, *theirs]]
        return df.select(*on, *cells, F.lit(number).alias("_side"))

    stacked = side(left, mine, 0).unionByName(side(right, theirs, 1))
    # one row of each side at most: whichever value is there is the only one
    both = stacked.groupBy(*on).agg(
        F.count(F.when(F.col("_side") == 0, 1)).alias("_left"), F.count(F.when(F.col("_side") == 1, 1)).alias("_right"),
        *[F.first(c, ignorenulls=True).alias(c) for c in [*mine, *theirs]])
    repeated = F.raise_error(F.concat(F.lit("a key occurs more than once: "), F.to_json(F.struct(*on)))).cast("boolean")
    single = F.when((F.col("_left") <= 1) & (F.col("_right") <= 1), True).otherwise(repeated)
    return both.filter(single).drop("_left", "_right")


def merge_series(left: DataFrame, right: DataFrame, on: str, suffixes: tuple[str, str] = ("_fred", "_market")) -> DataFrame:
    """Outer merge of two tables with one row per date; columns both share get a suffix on each side."""
    shared = [c for c in right.columns if c in left.columns and c != on]
    a = left.withColumnsRenamed({c: c + suffixes[0] for c in shared})
    b = right.withColumnsRenamed({c: c + suffixes[1] for c in shared})
    return merge_stacked(a, b, [on])


def add_context(panel_df: DataFrame, context: DataFrame, on: str, suffix: str = "_macro") -> DataFrame:
    """Left join of an entity panel with a table that has one row per day; its shared columns get a suffix."""
    shared = [c for c in context.columns if c in panel_df.columns and c != on]
    return join_calendar(panel_df, context.withColumnsRenamed({c: c + suffix for c in shared}), on)


def attribute_map(df: DataFrame, source: DataFrame, key: str, attribute: str) -> DataFrame:
    """Take an entity attribute from another table; the smallest value wins if it has several."""
    dim = source.groupBy(key).agg(F.min(attribute).alias(attribute))
    return join_checked(df, dim, [key])


def statement_derived(income: DataFrame, balance: DataFrame, panel: Panel) -> DataFrame:
    out = merge_stacked(income, balance, panel.keys)
    out = windows.pct_change(out, panel, {"revenue_growth": ("revenue", 1), "eps_growth": ("net_income", 1)})
    return out.withColumns({
        "profit_margin": ratio(F.col("net_income"), F.col("revenue"), 100.0),
        "asset_turnover": ratio(F.col("revenue"), F.col("assets")),
        "roe": ratio(F.col("net_income"), F.col("equity"), 100.0),
    })


def price_features_full_window(df: DataFrame, panel: Panel, price: str = "price", volume: str = "volume",
                               high: str = "high", low: str = "low") -> DataFrame:
    """Older loader features: a rolling value exists only once its window is full."""
    out = df.withColumn("_p", F.last(price, ignorenulls=True).over(panel.upto()))
    out = windows.pct_change(out, panel, {f"return_{n}d": ("_p", n) for n in (1, 5, 20, 60)})
    out = windows.rolling_std(out, panel, {"std20": ("return_1d", 20), "std60": ("return_1d", 60)}, min_rows=0)
    out = windows.moving_average(
        out, panel, {"ma50": ("_p", 50), "ma200": ("_p", 200), "volume_ma20": (volume, 20)}, min_rows=0)
    return out.withColumn("day_range", ratio(F.col(high) - F.col(low), F.col(low), 100.0)).drop("_p")


def top_bottom(df: DataFrame, by: str, ties: Sequence[str], k: int) -> DataFrame:
    """The k largest and k smallest rows with a ``side`` column (a top-k report)."""
    top = df.orderBy(F.col(by).desc(), *ties).limit(k).withColumn("side", F.lit("top"))
    bottom = df.orderBy(F.col(by), *ties).limit(k).withColumn("side", F.lit("bottom"))
    return top.unionByName(bottom)


# --- merge reports -----------------------------------------------------------------------------

def date_overlap(left: DataFrame, right: DataFrame, date: str) -> DataFrame:
    """How many distinct dates both tables, only the left and only the right have."""
    a = left.select(date).distinct().withColumn("_a", F.lit(1))
    b = right.select(date).distinct().withColumn("_b", F.lit(1))
    return a.join(b, date, "full").agg(
        F.count(F.when(F.col("_a").isNotNull() & F.col("_b").isNotNull(), 1)).alias("common"),
        F.count(F.when(F.col("_b").isNull(), 1)).alias("left_only"),
        F.count(F.when(F.col("_a").isNull(), 1)).alias("right_only"),
    )


def date_alignment(left: DataFrame, right: DataFrame, date: str) -> DataFrame:
    """The interval both tables cover, its length in days, and whether it is empty."""
    def span(df: DataFrame, side: str) -> DataFrame:
        return df.agg(F.min(date).alias("lo"), F.max(date).alias("hi")).withColumn("side", F.lit(side))

    both = span(left, "l").unionByName(span(right, "r"))
    out = both.agg(F.max("lo").alias("overlap_start"), F.min("hi").alias("overlap_end"))
    days = F.datediff("overlap_end", "overlap_start")
    return out.withColumns({"overlap_days": F.greatest(days, F.lit(0)).cast("long"), "aligned": (days >= 0)})


def merge_quality(left: DataFrame, right: DataFrame, merged: DataFrame, key: str) -> DataFrame:
    """Distinct keys before and after a merge. One pass per table over the distinct keys."""
    keys = union_all([
        d.select(key).distinct().withColumn("side", F.lit(s)) for d, s in ((left, "l"), (right, "r"), (merged, "m"))
    ])
    held = keys.groupBy(key).agg(*[F.max((F.col("side") == s).cast("int")).alias(s) for s in "lrm"])
    n = held.agg(
        F.sum("l").alias("left_keys"), F.sum("r").alias("right_keys"), F.sum("m").alias("merged_keys"),
        F.sum(((F.col("l") == 1) & (F.col("m") == 1)).cast("int")).alias("left_kept"),
    )
    return n.withColumn("lost_pct", ratio(F.col("left_keys") - F.col("left_kept"), F.col("left_keys"), 100.0))


def column_set_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """Columns added, removed and common: schema work only, no data is read."""
    a, b = set(before.columns), set(after.columns)
    rows = [(c, "common" if c in a and c in b else "removed" if c in a else "added") for c in sorted(a | b)]
    return before.sparkSession.createDataFrame(rows, "column string, status string")


def suffix_report(df: DataFrame, suffixes: Sequence[str] = MERGE_SUFFIXES) -> DataFrame:
    """Columns that end in a merge suffix, with their base name and whether the base exists."""
    rows = []
    for c in df.columns:
        for s in suffixes:
            if c.endswith(s):
                rows.append((c[: -len(s)], c, c[: -len(s)] in df.columns))
                break
    return df.sparkSession.createDataFrame(rows, "base string, column string, base_exists boolean")


def merge_report(frames: Mapping[str, DataFrame], date: str) -> DataFrame:
    """Per pipeline: rows, columns, missing percent and date range."""
    parts = []
    for name, df in frames.items():
        cells = sum((F.col(c).isNull().cast("long") for c in df.columns), F.lit(0))
        parts.append(df.agg(
            F.lit(name).alias("pipeline"), F.count("*").alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"),
            (F.sum(cells) * 100.0 / (F.count("*") * len(df.columns))).alias("missing_pct"),
            F.min(date).alias("date_min"), F.max(date).alias("date_max"),
        ))
    return union_all(parts)
