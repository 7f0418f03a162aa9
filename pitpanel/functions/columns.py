"""Scalar column expressions and schema helpers."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INF = float("inf")


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def fractional(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType))


def existing(df: DataFrame, names: Iterable[str]) -> list[str]:
    have = set(df.columns)
    return [n for n in names if n in have]


def ratio(num: Column, den: Column, scale: float = 1.0) -> Column:
    """``num / den * scale``; a zero denominator gives NULL, never infinity."""
    out = F.try_divide(num.cast("double"), den.cast("double"))
    return out if scale == 1.0 else out * F.lit(scale)


def flag(condition: Column) -> Column:
    """0/1; an unknown condition counts as 0."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def clip(c: Column, low: Column | float | None, high: Column | float | None) -> Column:
    """Clip that keeps NULL as NULL and ignores a NULL bound."""
    low_c = low if isinstance(low, Column) else F.lit(low)
    high_c = high if isinstance(high, Column) else F.lit(high)
    return F.when(c < low_c, low_c).when(c > high_c, high_c).otherwise(c)


def is_inf(c: Column) -> Column:
    return F.coalesce(F.abs(c) == F.lit(INF), F.lit(False))


def missing(c: Column, is_fractional: bool) -> Column:
    return (c.isNull() | F.isnan(c)) if is_fractional else c.isNull()


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN means missing in the data model; Spark orders it above every number, so drop it early."""
    cols = {n: F.nanvl(F.col(n), F.lit(None).cast("double")) for n in df.columns if fractional(df, n)}
    return df.withColumns(cols) if cols else df


def right_closed_bins(c: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the interval ``(edges[i], edges[i+1]]`` that holds the value, else NULL."""
    out = None
    for low, high, label in zip(edges[:-1], edges[1:], labels):
        cond = (c > low) & (c <= high)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out


def first_existing(df: DataFrame, candidates: Sequence[str]) -> Column:
    """The first of ``candidates`` present in the schema; the choice is made once, not per row."""
    for name in candidates:
        if name in df.columns:
            return F.col(name)
    raise ValueError(f"none of {list(candidates)} in {df.columns}")


def keep_existing(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.select(*existing(df, names))


def calendar(date: Column) -> dict[str, Column]:
    return {
        "year": F.year(date),
        "month": F.month(date),
        "quarter": F.quarter(date),
        "day_of_week": F.weekday(date),
        "is_month_end": (date == F.last_day(date)).cast("int"),
    }
