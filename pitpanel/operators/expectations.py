"""Declarative expectations: a suite is a list of data; all suites over a table are evaluated together.

One aggregate takes all measures of all suites, each once. Uniqueness and distinct counts of all key sets share one grouped pass, in
which each row stands once for each set; its few totals enter the same row as a scalar subquery. So a table is evaluated
at most twice, whatever the number of suites.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitpanel.functions.columns import existing

# fixed values: severities, most severe first, and columns whose nulls are critical
SEVERITIES = ("CRITICAL", "ERROR", "WARNING", "INFO")
KEY_COLUMNS = ("Date", "Company", "GDP", "CPI", "VIX", "Stock_Price", "Revenue")


@dataclass(frozen=True)
class Expectation:
    kind: str
    column: str | None = None
    low: object = None
    high: object = None
    mostly: float = 1.0
    columns: tuple[str, ...] = ()
    values: tuple = ()
    type_name: str | None = None
    severity: str = "ERROR"
    key_severity: str | None = None  # of the same test on a key column, if that differs

    @property
    def target(self) -> str:
        return self.column or ",".join(self.columns) or "table"


def exist(*columns: str) -> list[Expectation]:
    return [Expectation("column_to_exist", c, severity="CRITICAL") for c in columns]


def not_null(*columns: str, mostly: float = 1.0) -> list[Expectation]:
    return [Expectation("values_to_not_be_null", c, mostly=mostly, key_severity="CRITICAL") for c in columns]


def between(column: str, low, high, mostly: float = 1.0) -> list[Expectation]:
    return [Expectation("values_to_be_between", column, low, high, mostly)]


def unique(column: str) -> list[Expectation]:
    return [Expectation("values_to_be_unique", column)]


def unique_together(*columns: str) -> list[Expectation]:
    return [Expectation("compound_columns_to_be_unique", columns=columns)]


def distinct_between(column: str, low, high) -> list[Expectation]:
    return [Expectation("unique_value_count_to_be_between", column, low, high)]


def in_set(column: str, values: Sequence, mostly: float = 1.0) -> list[Expectation]:
    return [Expectation("values_to_be_in_set", column, mostly=mostly, values=tuple(values))]


def of_type(column: str, type_name: str) -> list[Expectation]:
    return [Expectation("values_to_be_of_type", column, type_name=type_name, severity="CRITICAL")]


def rows_between(low, high) -> list[Expectation]:
    return [Expectation("row_count_to_be_between", low=low, high=high)]


def columns_between(low, high) -> list[Expectation]:
    return [Expectation("column_count_to_be_between", low=low, high=high)]


def mean_between(column: str, low, high) -> list[Expectation]:
    return [Expectation("mean_to_be_between", column, low, high)]


def stdev_between(column: str, low, high) -> list[Expectation]:
    return [Expectation("stdev_to_be_between", column, low, high)]


def max_between(column: str, low, high) -> list[Expectation]:
    return [Expectation("max_to_be_between", column, low, high)]


def rows_equal_other() -> list[Expectation]:
    return [Expectation("row_count_to_equal_other_table")]


def severity_of(e: Expectation, key_columns: Sequence[str] = KEY_COLUMNS) -> str:
    """Each expectation carries its severity; some weigh more on key columns."""
    return e.key_severity if e.key_severity and e.column in key_columns else e.severity


def _inside(value: Column, low, high) -> Column:
    ok = F.lit(True)
    if low is not None:
        ok = ok & (value >= F.lit(low))
    if high is not None:
        ok = ok & (value <= F.lit(high))
    return ok


def _measure(df: DataFrame, e: Expectation) -> Column:
    """The aggregate an expectation looks at, as a double."""
    c = F.col(e.column) if e.column else None
    if e.kind == "values_to_not_be_null":
        return F.coalesce(F.try_divide(F.count(c).cast("double"), F.count("*").cast("double")), F.lit(1.0))
    if e.kind == "values_to_be_between":
        hit = F.count(F.when(_inside(c, e.low, e.high), 1))
        return F.coalesce(F.try_divide(hit.cast("double"), F.count(c).cast("double")), F.lit(1.0))
    if e.kind == "values_to_be_in_set":
        hit = F.count(F.when(c.isin(*e.values), 1))
        return F.coalesce(F.try_divide(hit.cast("double"), F.count(c).cast("double")), F.lit(1.0))
    if e.kind == "mean_to_be_between":
        return F.avg(c)
    if e.kind == "stdev_to_be_between":
        return F.stddev_samp(c)
    if e.kind == "max_to_be_between":
        top = F.max(c)
        return F.datediff(top, F.lit("1970-01-01").cast("date")).cast("double") if dict(df.dtypes)[e.column] == "date" else top.cast("double")
    if e.kind in ("row_count_to_be_between", "row_count_to_equal_other_table"):
        return F.count("*").cast("double")
    raise ValueError(e.kind)


def _keys(e: Expectation) -> tuple[str, ...]:
    return (e.column,) if e.column else e.columns


def _written(df: DataFrame, column: str) -> Column:
    """The value as a text that other values do not share; null stays null."""
    kind, c = df.schema[column].dataType, F.col(column)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return (c + F.lit(0.0)).cast("string")  # one zero
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c).cast("string")  # local times repeat an hour in autumn
    if isinstance(kind, T.BinaryType):
        return F.hex(c)
    if isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):
        return F.when(c.isNotNull(), F.to_json(F.struct(c)))
    return c.cast("string")


def _key_totals(df: DataFrame, sets: Sequence[tuple[str, ...]]) -> DataFrame:
    """One row with a map: set number to ``rows`` whose key occurs more than once, and number of different ``keys``.

    A null in a key of one column is no value; in a key of several it is one.
    """
    cells = F.array(*[F.struct(F.lit(k).alias("set"), F.array(*[_written(df, c) for c in keys]).alias("key")) for k, keys in enumerate(sets)])
    rows = df.select(F.explode(F.filter(cells, lambda x: (F.size(x["key"]) > 1) | x["key"][0].isNotNull())).alias("x"))
    counted = rows.groupBy(F.col("x.set").alias("set"), F.col("x.key").alias("key")).agg(F.count("*").alias("n"))
    totals = counted.groupBy("set").agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).cast("double").alias("rows"), F.count("*").cast("double").alias("keys"))
    return totals.agg(F.map_from_entries(F.collect_list(F.struct("set", F.struct("rows", "keys")))).alias("m"))


def _passes(df: DataFrame, e: Expectation, v: Column, other: Column | None) -> Column:
    if e.kind in ("values_to_not_be_null", "values_to_be_between", "values_to_be_in_set"):
        return v >= e.mostly
    if e.kind in ("values_to_be_unique", "compound_columns_to_be_unique"):
        return v == 0
    if e.kind == "row_count_to_equal_other_table":
        return v == other
    if e.kind == "max_to_be_between" and isinstance(e.low or e.high, str):
        day = F.date_add(F.lit("1970-01-01").cast("date"), v.cast("int"))
        as_date = lambda x: F.lit(x).cast("date") if x else None
        low, high = as_date(e.low), as_date(e.high)
        ok = F.lit(True)
        if low is not None:
            ok = ok & (day >= low)
        return ok & (day <= high) if high is not None else ok
    return F.coalesce(_inside(v, e.low, e.high), F.lit(False))


GROUPED = ("values_to_be_unique", "compound_columns_to_be_unique", "unique_value_count_to_be_between")
SCHEMA = ("column_to_exist", "values_to_be_of_type", "column_count_to_be_between")


def evaluate(df: DataFrame, suite: Sequence[Expectation], name: str, other: DataFrame | None = None,
             key_columns: Sequence[str] = KEY_COLUMNS) -> DataFrame:
    """One row per expectation: suite, position, expectation, column, severity, observed, success.

    An expectation on a column the table lacks fails with a NULL observation.
    """
    return evaluate_all(df, {name: suite}, other, key_columns)


def evaluate_all(df: DataFrame, suites: Mapping[str, Sequence[Expectation]], other: DataFrame | None = None,
                 key_columns: Sequence[str] = KEY_COLUMNS) -> DataFrame:
    """``evaluate`` for several suites over one table. ``other`` may be ``df`` itself, which costs nothing."""
    have, types = set(df.columns), dict(df.dtypes)
    measures: dict[tuple, str] = {}
    sets: dict[tuple[str, ...], int] = {}
    for e in [e for suite in suites.values() for e in suite if e.kind not in SCHEMA and {c for c in _keys(e) if c} <= have]:
        if e.kind in GROUPED:
            sets.setdefault(_keys(e), len(sets))
        else:
            measures.setdefault(_measured(e), f"v{len(measures)}")
    base = df.agg(F.count("*").cast("double").alias("_rows"), *[_measure(df, Expectation(kind, c, low, high, values=values)).alias(v)
                                               for (kind, c, low, high, values), v in measures.items()])
    if sets:
        base = base.withColumn("_keys", _key_totals(df, list(sets)).scalar())
    other_rows = None
    if other is not None:
        other_rows = F.col("_rows") if other is df else other.agg(F.count("*").cast("double").alias("v")).scalar()
    cells = []
    for name, suite in suites.items():
        for i, e in enumerate(suite):
            if e.kind == "column_to_exist":
                v = F.lit(1.0 if e.column in have else 0.0)
                ok = F.lit(e.column in have)
            elif e.kind == "values_to_be_of_type":
                good = types.get(e.column) == e.type_name
                v, ok = F.lit(1.0 if good else 0.0), F.lit(good)
            elif e.kind == "column_count_to_be_between":
                v = F.lit(float(len(df.columns)))
                ok = _inside(v, e.low, e.high)
            elif {c for c in _keys(e) if c} <= have:
                if e.kind in GROUPED:
                    of = "keys" if e.kind == "unique_value_count_to_be_between" else "rows"
                    v = F.coalesce(F.try_element_at("_keys", F.lit(sets[_keys(e)]))[of], F.lit(0.0))
                else:
                    v = F.col(measures[_measured(e)])
                ok = _passes(df, e, v, other_rows)
            else:
                v, ok = F.lit(None).cast("double"), F.lit(False)
            cells.append(F.struct(
                F.lit(name).alias("suite"), F.lit(i).alias("position"), F.lit(e.kind).alias("expectation"), F.lit(e.target).alias("column"),
                F.lit(severity_of(e, key_columns)).alias("severity"), v.cast("double").alias("observed"), ok.alias("success"),
            ))
    return base.select(F.explode(F.array(*cells)).alias("_e")).select("_e.*")


def _measured(e: Expectation) -> tuple:
    """What the aggregate of an expectation depends on."""
    limits = (e.low, e.high) if e.kind == "values_to_be_between" else (None, None)
    return (e.kind, e.column, *limits, e.values if e.kind == "values_to_be_in_set" else ())


def summarize(results: DataFrame) -> DataFrame:
    """Per suite: evaluated, successful and failed expectations, success percent, failures by severity."""
    failed = ~F.col("success")
    return results.groupBy("suite").agg(
        F.count("*").alias("evaluated"), F.count(F.when(F.col("success"), 1)).alias("successful"),
        F.count(F.when(failed, 1)).alias("failed"),
        (F.count(F.when(F.col("success"), 1)) * 100.0 / F.count("*")).alias("success_pct"),
        *[F.count(F.when(failed & (F.col("severity") == s), 1)).alias(f"{s.lower()}_failures") for s in SEVERITIES[:3]],
    )


def gate(results: DataFrame, threshold: str = "ERROR") -> DataFrame:
    """Per suite: does it pass, that is, has it no failure at the threshold severity or above?"""
    blocking = SEVERITIES[: SEVERITIES.index(threshold) + 1]
    bad = F.count(F.when(~F.col("success") & F.col("severity").isin(*blocking), 1))
    return results.groupBy("suite").agg(bad.alias("blocking_failures")).withColumn("passed", F.col("blocking_failures") == 0)


def required_columns(df: DataFrame, required: Mapping[str, Sequence[str]]) -> dict[str, list[str]]:
    """Missing columns per list of required columns; schema only."""
    return {k: [c for c in cols if c not in existing(df, cols)] for k, cols in required.items()}


def required_columns_report(frames: Mapping[str, DataFrame], required: Mapping[str, Sequence[str]]) -> DataFrame:
    """One row per dataset and required column: is it ``present``, and how many of the rows have a value in it.

    A column without any value counts as present but not ``usable``; one that is missing has no counts.
    """
    parts = []
    for name, df in frames.items():
        columns = list(required[name])
        row = df.agg(F.count("*").alias("_rows"), *[F.count(c).alias(f"_n_{c}") for c in existing(df, columns)])
        cells = F.array(*[
            F.struct(F.lit(name).alias("dataset"), F.lit(c).alias("column"), F.lit(c in df.columns).alias("present"),
                     (F.col("_rows") if c in df.columns else F.lit(None).cast("long")).alias("n_rows"),
                     (F.col(f"_n_{c}") if c in df.columns else F.lit(None).cast("long")).alias("n_values"))
            for c in columns])
        parts.append(row.select(F.explode(cells).alias("x")).select("x.*"))
    return reduce(DataFrame.unionByName, parts).withColumn("usable", F.coalesce(F.col("n_values") > 0, F.lit(False)))
