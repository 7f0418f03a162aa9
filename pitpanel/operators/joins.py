"""Joins whose broadcast side is measured or bounded."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 << 20
HOT_ROWS = 5_000_000
SALTS = 64


def join_same(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join by columns of equal names in which a null equals a null; the key columns of ``left`` are kept.

    ``how`` is inner or left.
    """
    keyed = right.select(*[F.col(c).alias(f"_on_{c}") if c in on else F.col(c) for c in right.columns])
    same = reduce(lambda a, b: a & b, [left[c].eqNullSafe(keyed[f"_on_{c}"]) for c in on])
    return left.join(keyed, same, how).drop(*[f"_on_{c}" for c in on])


def row_bytes(kind: T.DataType) -> int:
    """Bytes of a row of this schema; texts and collections, whose size only the data know, count as 64 and as four elements."""
    if isinstance(kind, T.StructType):
        return 16 + sum(row_bytes(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return 16 + 4 * row_bytes(kind.elementType)
    if isinstance(kind, T.MapType):
        return 32 + 4 * (row_bytes(kind.keyType) + row_bytes(kind.valueType))
    return 64 if isinstance(kind, (T.StringType, T.BinaryType)) else 16 if isinstance(kind, T.DecimalType) else 8


def join_checked(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left",
                 max_rows: int = BROADCAST_ROWS, hot_rows: int = HOT_ROWS, salts: int = SALTS) -> DataFrame:
    """Left or inner join with a table that has one row per key; safe for hot keys, and null keys equal each other.

    ``right`` is broadcast only after counting it: as many rows as fit into BROADCAST_BYTES, ``max_rows`` at most (the count
    stops there).
    Otherwise the keys with more than ``hot_rows`` left rows are spread over ``salts`` partitions and
    their single right row is repeated that often; all other keys join as usual. There are at most
    ``rows / hot_rows`` hot keys, so their list is small enough to broadcast.
    """
    on = list(on)
    max_rows = min(max_rows, BROADCAST_BYTES // row_bytes(right.schema))
    if right.limit(max_rows + 1).count() <= max_rows:
        return join_same(left, F.broadcast(right), on, how)
    hot = left.groupBy(*on).agg(F.count("*").alias("_rows")).filter(F.col("_rows") > hot_rows)
    hot = hot.select(*on, F.lit(salts).alias("_salts"))
    spread = F.pmod(F.xxhash64(*left.columns), F.col("_salts").cast("long")).cast("int")
    a = join_same(left, F.broadcast(hot), on, "left").withColumn("_salt", F.coalesce(spread, F.lit(0))).drop("_salts")
    b = join_same(right, F.broadcast(hot), on, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1))).drop("_salts")
    return join_same(a, b, [*on, "_salt"], how).drop("_salt")


def one_row_per_day(daily: DataFrame, on: str) -> DataFrame:
    """``daily`` itself, failing at run time if a day occurs twice: its size is then bounded by the calendar."""
    if not isinstance(daily.schema[on].dataType, T.DateType):
        raise ValueError(f"{on} must be a date")
    rows = F.count(F.lit(1)).over(Window.partitionBy(on))
    repeated = F.raise_error(F.lit(f"a day occurs more than once in {on}")).cast("boolean")
    return daily.withColumn("_rows", rows).filter(F.when(F.col("_rows") == 1, True).otherwise(repeated)).drop("_rows")


def join_calendar(left: DataFrame, daily: DataFrame, on: str, how: str = "left") -> DataFrame:
    """Join with a table that has one row per calendar day.

    Its size is bounded by the calendar (36,525 rows a century) and that bound is enforced, so a
    broadcast is safe whatever the size of ``left``.
    """
    return left.join(F.broadcast(one_row_per_day(daily, on)), on, how)
