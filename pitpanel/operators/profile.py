"""Aggregations and profiling reports. Each report is one pass (plus one grouped pass for duplicates)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitpanel.functions.columns import existing, fractional, is_inf, missing, numeric_columns, ratio
from pitpanel.operators.dedupe import duplicate_count
from pitpanel.operators.quantiles import bracketed_quantiles


def long_report(df: DataFrame, entries: Sequence[Sequence[Column]]) -> DataFrame:
    """Turn one aggregate row into report rows; each entry lists the aliased columns of one row."""
    return df.select(F.explode(F.array(*[F.struct(*e) for e in entries])).alias("_r")).select("_r.*")


def _nulls(df: DataFrame, c: str) -> Column:
    return F.sum(missing(F.col(c), fractional(df, c)).cast("long"))


def dataset_stats(df: DataFrame, name: str, keys: Sequence[str], date: str, non_negative: Sequence[str] = (),
                  post_merge: bool = False, entity: str | None = None) -> DataFrame:
    """One row: size, date range, missing cells, duplicates, mean of means and of deviations.

    ``post_merge`` adds infinite cells and negatives in columns that must not be negative; ``entity`` the number of
    different entities.
    """
    numeric = numeric_columns(df)
    floats = [c for c in numeric if fractional(df, c)]
    agg = df.agg(
        F.count("*").alias("n_rows"), F.min(date).alias("date_min"), F.max(date).alias("date_max"),
        *[_nulls(df, c).alias(f"_m_{c}") for c in df.columns],
        *[F.avg(c).alias(f"_a_{c}") for c in numeric], *[F.stddev_samp(c).alias(f"_s_{c}") for c in numeric],
        *[F.sum(is_inf(F.col(c)).cast("long")).alias(f"_i_{c}") for c in floats],
        *[F.count(F.when(F.col(c) < 0, 1)).alias(f"_g_{c}") for c in existing(df, non_negative)],
    )

    def total(prefix: str, names: Sequence[str]) -> Column:
        return sum((F.coalesce(f"{prefix}{c}", F.lit(0)) for c in names), F.lit(0).cast("long"))

    def mean(prefix: str) -> Column:
        values = F.filter(F.array(*[F.col(f"{prefix}{c}") for c in numeric]), lambda v: v.isNotNull())
        return ratio(F.aggregate(values, F.lit(0.0), lambda a, v: a + v), F.size(values))

    lost = total("_m_", df.columns)
    out = agg.select(
        F.lit(name).alias("dataset"), "n_rows", F.lit(len(df.columns)).alias("n_cols"), "date_min", "date_max",
        F.datediff("date_max", "date_min").cast("long").alias("date_range_days"),
        lost.alias("total_missing"),
        F.round(ratio(lost, F.col("n_rows") * len(df.columns), 100.0), 2).alias("missing_pct"),
        sum(((F.col(f"_m_{c}") > 0).cast("int") for c in df.columns), F.lit(0)).alias("cols_with_missing"),
        duplicate_count(df, keys).select("extra_rows").scalar().alias("duplicates"),
        F.lit(len(numeric)).alias("n_numeric_cols"), F.lit(len(df.columns) - len(numeric)).alias("n_categorical_cols"),
        mean("_a_").alias("mean_value"), mean("_s_").alias("std_value"),
        total("_i_", floats).alias("inf_values"), total("_g_", existing(df, non_negative)).alias("invalid_negatives"),
    )
    if entity is not None:
        # combined where the rows are, so one row for each entity and task is all that moves
        out = out.withColumn("n_entities", df.groupBy(entity).agg(F.lit(1)).where(F.col(entity).isNotNull()).agg(F.count("*").alias("n")).scalar())
    return out if post_merge else out.drop("inf_values", "invalid_negatives")


COMPARED = ("n_rows", "n_cols", "date_range_days", "total_missing", "missing_pct", "cols_with_missing", "duplicates")


def before_after_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """Two statistics rows side by side: metric, before, after, change."""
    a = before.select(*[F.col(c).cast("double").alias(c) for c in COMPARED], F.lit("before").alias("_side"))
    b = after.select(*[F.col(c).cast("double").alias(c) for c in COMPARED], F.lit("after").alias("_side"))
    long = a.unionByName(b).unpivot(["_side"], list(COMPARED), "metric", "value")
    out = long.groupBy("metric").agg(*[
        F.max(F.when(F.col("_side") == s, F.col("value"))).alias(s) for s in ("before", "after")
    ])
    return out.withColumn("change", F.col("after") - F.col("before"))


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column: null count, percent and level (over 50, 20 or 5 percent)."""
    cols = list(columns or df.columns)
    agg = df.agg(F.count("*").alias("_n"), *[_nulls(df, c).alias(c) for c in cols])
    out = long_report(agg, [[
        F.lit(c).alias("column"), F.coalesce(c, F.lit(0)).alias("nulls"),
        ratio(F.col(c), F.col("_n"), 100.0).alias("null_pct")] for c in cols])
    p = F.col("null_pct")
    return out.withColumn("level", F.when(p > 50, "over 50").when(p > 20, "over 20").when(p > 5, "over 5").otherwise("low"))


def null_by_source(df: DataFrame, sources: Mapping[str, Sequence[str]]) -> DataFrame:
    """Mean null percent over the columns of each source."""
    cols = [c for names in sources.values() for c in names]
    of = F.create_map(*[F.lit(x) for s, names in sources.items() for c in names for x in (c, s)])
    return null_profile(df, cols).groupBy(of[F.col("column")].alias("source")).agg(
        F.count("*").alias("n_columns"), F.avg("null_pct").alias("mean_null_pct"))


def null_by_entity(df: DataFrame, entity: str, limit_pct: float = 5.0) -> DataFrame:
    cells = [c for c in df.columns if c != entity]
    lost = sum((missing(F.col(c), fractional(df, c)).cast("long") for c in cells), F.lit(0).cast("long"))
    out = df.groupBy(entity).agg(F.count("*").alias("n_rows"), F.sum(lost).alias("missing_cells"))
    out = out.withColumn("missing_pct", F.col("missing_cells") * 100.0 / (F.col("n_rows") * len(df.columns)))
    return out.withColumn("above_limit", F.col("missing_pct") > limit_pct)


def key_availability(df: DataFrame, entity: str, value, columns: Sequence[str]) -> DataFrame:
    """Non-null count and percent of the key columns for one entity."""
    cols = existing(df, columns)
    agg = df.filter(F.col(entity) == value).agg(F.count("*").alias("_n"), *[F.count(c).alias(c) for c in cols])
    return long_report(agg, [[
        F.lit(c).alias("column"), F.col(c).alias("available"), ratio(F.col(c), F.col("_n"), 100.0).alias("available_pct")]
        for c in cols])


def describe_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, std, min, exact quartiles and max per column."""
    agg = df.agg(*[
        x for c in columns for x in (
            F.count(c).alias(f"{c}_n"), F.avg(c).alias(f"{c}_a"), F.stddev_samp(c).alias(f"{c}_s"),
            F.min(c).cast("double").alias(f"{c}_lo"), F.max(c).cast("double").alias(f"{c}_hi"))
    ])
    base = long_report(agg, [[
        F.lit(c).alias("column"), F.col(f"{c}_n").alias("count"), F.col(f"{c}_a").alias("mean"), F.col(f"{c}_s").alias("std"),
        F.col(f"{c}_lo").alias("min"), F.col(f"{c}_hi").alias("max")] for c in columns])
    q = bracketed_quantiles(df, [], columns, [0.25, 0.5, 0.75]).groupBy("column").agg(*[
        F.max(F.when(F.col("p") == p, F.col("value"))).alias(n) for n, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))])
    return base.join(q, "column", "left")


def risk_return(df: DataFrame, entity: str, returns: str) -> DataFrame:
    """Mean, deviation and their quotient per entity; 0 where the deviation is not positive."""
    out = df.groupBy(entity).agg(F.avg(returns).alias("mean_return"), F.stddev_samp(returns).alias("volatility"))
    return out.withColumn("sharpe", F.when(F.col("volatility") > 0, F.col("mean_return") / F.col("volatility")).otherwise(0.0))


def corr_with_target(df: DataFrame, target: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of each column with the target over pairwise complete rows."""
    cols = [c for c in (columns or numeric_columns(df)) if c != target]
    found = _correlations(df, [*cols, target])
    rows = [(c, float(found[k, -1])) for k, c in enumerate(cols)]
    return _numbers(df, rows, "column string, correlation double")


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Long correlation matrix over pairwise complete rows."""
    found = _correlations(df, list(columns))
    rows = [(a, b, float(found[i, j])) for i, a in enumerate(columns) for j, b in enumerate(columns)]
    return _numbers(df, rows, "a string, b string, correlation double")


def _numbers(df: DataFrame, rows: list[tuple], schema: str) -> DataFrame:
    out = df.sparkSession.createDataFrame(rows, schema)
    return out.withColumn("correlation", F.nanvl("correlation", F.lit(None).cast("double")))


def _correlations(df: DataFrame, columns: list[str]) -> np.ndarray:
    """Correlations of all pairs of columns from one Gram matrix; NaN where there is none.

    With x for a centred, scaled value (0 if it is null) and m for whether it is there, the products of the columns
    (x, m, x * x) with each other hold the count, sums, squares and products of every pair over its complete rows. The Gram matrix
    is summed up in the executors; what comes back has nine cells for each pair of columns.
    """
    k = len(columns)
    value = {c: F.when(~missing(F.col(c), fractional(df, c)), F.col(c).cast("double")) for c in columns}
    scale = df.agg(*[f(value[c]).alias(f"{n}{i}") for i, c in enumerate(columns) for n, f in (("a", F.avg), ("s", F.stddev_pop))]).first()
    x = {}
    for i, c in enumerate(columns):
        spread = scale[f"s{i}"]
        unit = spread if spread and spread == spread and spread not in (float("inf"),) else 1.0
        x[c] = F.coalesce((value[c] - F.lit(scale[f"a{i}"] or 0.0)) / F.lit(unit), F.lit(0.0))
    cells = df.select(*[x[c].alias(f"x{i}") for i, c in enumerate(columns)], *[value[c].isNotNull().cast("double").alias(f"m{i}") for i, c in enumerate(columns)])
    cells = cells.select("*", *[(F.col(f"x{i}") * F.col(f"x{i}")).alias(f"q{i}") for i in range(k)])
    names = [f"{n}{i}" for n in "xmq" for i in range(k)]
    vectors = VectorAssembler(inputCols=names, outputCol="_vector").transform(cells).select("_vector")
    gram = RowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "_vector")).computeGramianMatrix().toArray()
    n, sx, sxx, sxy = gram[k : 2 * k, k : 2 * k], gram[:k, k : 2 * k], gram[2 * k :, k : 2 * k], gram[:k, :k]
    with np.errstate(divide="ignore", invalid="ignore"):
        across = sxy - sx * sx.T / n
        own = sxx - sx * sx / n
        # the second column of a pair: its sums over the same rows stand across the diagonal
        out = across / np.sqrt(own * own.T)
    flat = (own <= 1e-12 * np.maximum(n, 1)) | (own.T <= 1e-12 * np.maximum(n, 1)) | (n < 2)
    return np.where(flat, np.nan, np.clip(out, -1, 1))


def distinct_sketches(df: DataFrame, date: str, columns: Sequence[str], bits: int = 12) -> DataFrame:
    """One row per day and column: ``sketch`` of its values, of fixed size, and the number of values.

    Sketches of any days merge into that of their union. The estimate of a merged sketch is off by 1.04 / sqrt(2 ^ bits) in
    standard deviation, 1.6 percent for 12 bits.
    """
    days = df.groupBy(F.col(date).cast("date").alias("day")).agg(*[x for c in columns for x in (
        F.hll_sketch_agg(F.col(c).cast("string"), bits).alias(f"s_{c}"), F.count(c).alias(f"n_{c}"))])
    return long_report(days, [[F.col("day"), F.lit(c).alias("column"), F.col(f"s_{c}").alias("sketch"), F.col(f"n_{c}").alias("n_values")] for c in columns])


def distinct_estimates(sketches: DataFrame, first: str | None = None, last: str | None = None) -> DataFrame:
    """Estimated number of different values of each column over a range of days, from the stored sketches alone."""
    days = sketches
    if first is not None:
        days = days.filter(F.col("day") >= F.lit(first).cast("date"))
    if last is not None:
        days = days.filter(F.col("day") <= F.lit(last).cast("date"))
    return days.groupBy("column").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"), F.sum("n_values").alias("n_values"))


def stress_periods(df: DataFrame, date: str, level: str, limit: float, columns: Sequence[str]) -> DataFrame:
    """Days above the limit (count, percent, first and last) and the mean of each column inside and outside."""
    high = F.coalesce(F.col(level) > limit, F.lit(False))
    agg = df.agg(
        F.count("*").alias("_n"), F.count(F.when(high, 1)).alias("_k"),
        F.min(F.when(high, F.col(date))).alias("_first"), F.max(F.when(high, F.col(date))).alias("_last"),
        *[F.avg(F.when(high, F.col(c))).alias(f"_h_{c}") for c in columns],
        *[F.avg(F.when(~high, F.col(c))).alias(f"_o_{c}") for c in columns],
    )
    return long_report(agg, [[
        F.lit(c).alias("column"), F.col("_k").alias("stress_days"), ratio(F.col("_k"), F.col("_n"), 100.0).alias("stress_pct"),
        F.col("_first").alias("first_day"), F.col("_last").alias("last_day"), F.col(f"_h_{c}").alias("stress_mean"),
        F.col(f"_o_{c}").alias("normal_mean"), (F.col(f"_h_{c}") - F.col(f"_o_{c}")).alias("difference")] for c in columns])


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n"))


def distinct_report(df: DataFrame, by: str, columns: Sequence[str], date: str) -> DataFrame:
    """Distinct counts per group and the sorted list of years (bounded by the calendar)."""
    years = F.array_sort(F.collect_set(F.year(date)))
    return df.groupBy(by).agg(*[F.count_distinct(c).alias(f"n_{c}") for c in columns], years.alias("years"))


def run_metrics_summary(runs: DataFrame, step: str = "step", duration: str = "duration_s", success: str = "success",
                        order: Sequence[str] = ("run_ts",), slow_seconds: float = 3600.0) -> DataFrame:
    """Per step: runs, success percent, durations, the last run, and the number of slow runs."""
    d, ok = F.col(duration), F.col(success)
    return runs.groupBy(step).agg(
        F.count("*").alias("total_runs"), (F.count(F.when(ok, 1)) * 100.0 / F.count("*")).alias("success_rate"),
        F.avg(d).alias("avg_duration"), F.min(d).alias("min_duration"), F.max(d).alias("max_duration"),
        F.max(order[0]).alias("last_run"), F.max_by(d, F.struct(*order)).alias("last_duration"),
        F.max_by(success, F.struct(*order)).alias("last_success"), F.count(F.when(d > slow_seconds, 1)).alias("slow_runs"),
    )


def validation_metrics_summary(runs: DataFrame, dataset: str, day: Column, success: str) -> DataFrame:
    """Evaluated and failed expectations and the success rate per dataset and day."""
    failed = F.count(F.when(~F.col(success), 1))
    return runs.groupBy(dataset, day.alias("day")).agg(
        F.count("*").alias("total_expectations"), failed.alias("failed_expectations"),
        ((F.count("*") - failed) * 100.0 / F.count("*")).alias("success_rate"),
    )
