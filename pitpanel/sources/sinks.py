"""Sinks. Reports are DataFrames too, so every sink is one distributed write."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", order: Sequence[str] = ()) -> None:
    """CSV with a header; ``order`` sorts the whole table, range by range, so the files follow each other."""
    (df.sort(*order) if order else df).write.mode(mode).option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = (),
                  order: Sequence[str] = ()) -> None:
    (df.sort(*order) if order else df).write.mode(mode).partitionBy(*partition_by).parquet(path)


def write_report(df: DataFrame, path: str, run_ts: str) -> None:
    """Append a report as JSON under its run timestamp."""
    df.withColumn("run_ts", F.lit(run_ts)).write.mode("append").partitionBy("run_ts").json(path)
