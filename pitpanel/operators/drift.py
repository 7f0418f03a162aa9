"""Drift between a reference and a current period, and between runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitpanel.functions.columns import numeric_columns, ratio
from pitpanel.operators.blocks import range_blocks, running_totals
from pitpanel.operators.merge import year_range
from pitpanel.operators.profile import long_report

Years = tuple[int, int]
SERIES_TERMS = 100
EPS = 1e-6
#: Products of two sample sizes up to which the p-value is counted exactly.
EXACT_PAIRS = 20_000


def ks_exact_p(d: Column, n: Column, m: Column) -> Column:
    """Exact two-sided p-value: the share of lattice paths from (0, 0) to (n, m) that reach the distance d.

    Step by step along the diagonals i + j = s, each point holds the share of the paths to it that stayed inside; it gets i / s
    of what came from (i - 1, j) and j / s of what came from (i, j - 1). Distances are compared as integers.
    """
    a, b = F.least(n, m), F.greatest(n, m)
    reach = F.round(d * a.cast("double") * b.cast("double")).cast("long")

    def step(before: Column, s: Column) -> Column:
        def share(i: Column) -> Column:
            j = s - i
            out = (j < 0) | (j > b) | (F.abs(i * b - j * a) >= reach)
            came = i * F.coalesce(F.get(before, (i - 1).cast("int")), F.lit(0.0)) + j * F.coalesce(F.get(before, i.cast("int")), F.lit(0.0))
            return F.when(out, 0.0).otherwise(came / s)

        return F.transform(F.sequence(F.lit(0).cast("long"), F.least(s, a)), share)

    start = F.array(F.when(reach > 0, 1.0).otherwise(0.0))
    inside = F.aggregate(F.sequence(F.lit(1).cast("long"), (a + b).cast("long")), start, step)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.lit(1.0) - F.get(inside, a.cast("int"))))


def ks_p(d: Column, n: Column, m: Column) -> Column:
    """Two-sided p-value: exact for small samples, asymptotic where the exact count has more than EXACT_PAIRS points."""
    small = (n > 0) & (m > 0) & (n.cast("double") * m.cast("double") <= EXACT_PAIRS)
    return F.when(small, ks_exact_p(d, n, m)).otherwise(ks_p_value(d, n, m))


def ks_p_value(d: Column, n: Column, m: Column) -> Column:
    """Asymptotic two-sided p-value: the Kolmogorov series with the small-sample correction."""
    size = F.sqrt(n.cast("double") * m.cast("double") / (n + m))
    lam = (size + 0.12 + 0.11 / size) * d
    terms = F.transform(
        F.sequence(F.lit(1), F.lit(SERIES_TERMS)),
        lambda k: F.when(k % 2 == 1, F.lit(1.0)).otherwise(F.lit(-1.0)) * F.exp(-2.0 * k * k * lam * lam),
    )
    p = 2.0 * F.aggregate(terms, F.lit(0.0), lambda a, t: a + t)
    return F.when(lam < 0.2, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), p)))


def _in(date: str, years: Years) -> Column:
    return year_range(date, *years)


def ks_statistic(df: DataFrame, date: str, columns: Sequence[str], reference: Years, current: Years,
                 min_valid: int = 30, min_rows: int = 100) -> DataFrame:
    """Largest distance between the two empirical distributions of each feature, and its p-value.

    The p-value is exact for small samples, as ``ks_p`` tells. A feature with fewer than ``min_valid`` values in a period, or a period of fewer than ``min_rows`` rows, gives a row
    with ``tested`` false and no p-value.

    Only rows of either period are read; equal values are counted first; the running counts are
    distributed over blocks of the value range, so a single feature never lands in one task.
    """
    either = df.filter(_in(date, reference) | _in(date, current))
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns])
    long = either.select(_in(date, reference).alias("_ref"), _in(date, current).alias("_cur"), F.explode(cells).alias("_x"))
    long = long.select("_ref", "_cur", "_x.feature", "_x.value").filter(F.col("value").isNotNull())
    counted = long.groupBy("feature", "value").agg(
        F.count(F.when(F.col("_ref"), 1)).alias("_r"), F.count(F.when(F.col("_cur"), 1)).alias("_c"))
    laid = range_blocks(counted, ["feature", "value"])
    cdf = running_totals(laid, ["feature"], ["value"], {"_tr": "_r", "_tc": "_c"})
    totals = laid.groupBy("feature").agg(F.sum("_r").alias("n_reference"), F.sum("_c").alias("n_current"))
    # one row per tested column
    gap = F.abs(ratio(F.col("_tr"), F.col("n_reference")) - ratio(F.col("_tc"), F.col("n_current")))
    out = cdf.join(F.broadcast(totals), "feature").groupBy("feature", "n_reference", "n_current").agg(
        F.max(gap).alias("ks_statistic"))
    rows = either.agg(
        F.least(F.count(F.when(_in(date, reference), 1)), F.count(F.when(_in(date, current), 1))).alias("n")).scalar()
    enough = (F.col("n_reference") >= min_valid) & (F.col("n_current") >= min_valid) & (rows >= min_rows)
    p = ks_p(F.col("ks_statistic"), F.col("n_reference"), F.col("n_current"))
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "feature string")
    out = names.join(out, "feature", "left").fillna(0, ["n_reference", "n_current"])  # a feature without values too
    return out.withColumn("tested", F.coalesce(enough, F.lit(False))).withColumn("p_value", F.when(F.col("tested"), p))


def drift_moments(df: DataFrame, date: str, columns: Sequence[str], reference: Years, current: Years) -> DataFrame:
    """Mean and deviation of each feature in both periods and their change in percent."""
    r, c = _in(date, reference), _in(date, current)
    agg = df.filter(r | c).agg(*[
        x for f in columns for x in (
            F.avg(F.when(r, F.col(f))).alias(f"{f}_mr"), F.avg(F.when(c, F.col(f))).alias(f"{f}_mc"),
            F.stddev_samp(F.when(r, F.col(f))).alias(f"{f}_sr"), F.stddev_samp(F.when(c, F.col(f))).alias(f"{f}_sc"))
    ])

    def change(new: str, old: str) -> Column:
        return (F.col(new) - F.col(old)) / (F.abs(F.col(old)) + EPS) * 100

    return long_report(agg, [[
        F.lit(f).alias("feature"), F.col(f"{f}_mr").alias("mean_reference"), F.col(f"{f}_mc").alias("mean_current"),
        change(f"{f}_mc", f"{f}_mr").alias("mean_change_pct"), change(f"{f}_sc", f"{f}_sr").alias("std_change_pct")]
        for f in columns])


def drift_report(df: DataFrame, date: str, columns: Sequence[str], reference: Years, current: Years) -> DataFrame:
    """Test and moments per feature with the severity: HIGH, MEDIUM, LOW, STABLE or UNTESTED (too few values)."""
    out = ks_statistic(df, date, columns, reference, current).join(
        drift_moments(df, date, columns, reference, current), "feature")
    p, moved = F.col("p_value"), F.abs("mean_change_pct") > 50
    return out.withColumn(
        "severity",
        F.when(~F.col("tested"), "UNTESTED").when((p < 0.01) & moved, "HIGH").when(p < 0.01, "MEDIUM").when(p < 0.05, "LOW").otherwise("STABLE"),
    )


def drift_flag(df: DataFrame, report: DataFrame, name: str = "feature_drift_flag") -> DataFrame:
    """1 where any HIGH or MEDIUM feature has a value; reads at most one name per tested column."""
    drifted = [r["feature"] for r in report.filter(F.col("severity").isin("HIGH", "MEDIUM")).select("feature").collect()]
    hit = F.lit(False)
    for f in sorted(drifted):
        hit = hit | F.col(f).isNotNull()
    return df.withColumn(name, hit.cast("int"))


def drift_recommendations(report: DataFrame) -> DataFrame:
    """Advice by number of features per severity; one row per piece of advice."""
    def n(severity: str) -> Column:
        return F.count(F.when(F.col("severity") == severity, 1)).alias(severity.lower())

    counts = report.agg(n("HIGH"), n("MEDIUM"), n("LOW"))
    some = (F.col("high") + F.col("medium") + F.col("low")) > 0
    advice = F.array_compact(F.array(
        F.when(~some, F.lit("no drift to mitigate")),
        F.when(F.col("high") > 0, F.lit("normalise the high-drift features by period")),
        F.when(F.col("medium") > 0, F.lit("validate on later periods, not on random splits")),
        F.when(some, F.lit("monitor drift in production")),
    ))
    return counts.select("high", "medium", "low", F.explode(advice).alias("advice"))


def run_drift(runs: DataFrame, order: str, rows: str = "n_rows", missing_pct: str = "missing_pct", by: Sequence[str] = (),
              threshold: float = 0.2) -> DataFrame:
    """Compare each run with the one before: row count off by more than the threshold, or more missing cells.

    ``runs`` holds one row per run and series, so a window group is the history of one series.
    """
    w = Window.partitionBy(*by).orderBy(order)
    out = runs.withColumns({"_n": F.lag(rows).over(w), "_m": F.lag(missing_pct).over(w)})
    change = ratio(F.col(rows) - F.col("_n"), F.col("_n"))
    return out.withColumns({
        "row_change": change,
        "row_drift": F.coalesce(F.abs(change) > threshold, F.lit(False)),
        "missing_drift": F.coalesce(F.col(missing_pct) > F.col("_m") * (1 + threshold), F.lit(False)),
    }).drop("_n", "_m")


def default_columns(df: DataFrame) -> list[str]:
    return numeric_columns(df, ["year", "month", "day"])
