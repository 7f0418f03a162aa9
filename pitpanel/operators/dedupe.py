"""Row de-duplication and duplicate counts; all combine map-side, so a hot key is harmless."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    rows = df.groupBy(*keys).agg(pick(F.struct(*rest), F.struct(*order)).alias("_row"))
    return rows.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each key that comes last in ``order`` (which should be unique inside a key)."""
    return _one_per_key(df, keys, order, F.max_by)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return _one_per_key(df, keys, order, F.min_by)


def duplicate_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``extra_rows``: rows beyond the first per key; ``member_rows``: all rows of repeated keys."""
    n = F.col("_n")
    return df.groupBy(*keys).agg(F.count("*").alias("_n")).agg(
        F.coalesce(F.sum(n - 1), F.lit(0)).alias("extra_rows"),
        F.coalesce(F.sum(F.when(n > 1, n)), F.lit(0)).alias("member_rows"),
        F.count(F.when(n > 1, 1)).alias("repeated_keys"),
    )
