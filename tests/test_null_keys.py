"""Blocked, large and plain forms agree and lose no row where keys are null."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pitpanel.operators import blocks, checks, drift, features, fill, hygiene, joins, outliers, quantiles, slices, windows
from pitpanel.panel import Panel

START = dt.date(2020, 1, 1)


@pytest.fixture(scope="module")
def frame(spark):
    rows = [(e, START + dt.timedelta(days=k), None if (k * 7 + len(e or "")) % 4 == 0 else float(k * k % 31)) for e in ("a", "bb", None, "dddd") for k in range(10)]
    return spark.createDataFrame(rows, "entity string, dt date, x double")


def rows(df):
    return sorted((tuple(map(str, r)) for r in df.select(*sorted(df.columns)).collect()))


PANEL = Panel(("entity",), "dt")


@pytest.mark.parametrize("work", [
    lambda df, blocked: fill.forward_fill(df, PANEL, ["x"], blocked=blocked),
    lambda df, blocked: windows.lag_features(df, PANEL, ["x"], [1, 3], blocked=blocked),
    lambda df, blocked: windows.moving_average(df, PANEL, {"m": ("x", 3)}, blocked=blocked),
    lambda df, blocked: windows.rolling_std(df, PANEL, {"s": ("x", 4)}, blocked=blocked),
])
def test_blocked_equals_plain(frame, work):
    plain, blocked = work(frame, False), work(frame, True)
    assert plain.count() == 40
    assert rows(plain.select(*[F.round(c, 9).alias(c) if t == "double" else c for c, t in plain.dtypes])) == rows(
        blocked.select(*[F.round(c, 9).alias(c) if t == "double" else c for c, t in blocked.dtypes]))


def test_large_equals_plain(frame):
    spiked = frame.withColumn("x", F.when(F.day("dt") == 9, 1e5).otherwise(F.col("x")))
    plain = quantiles.grouped_quantiles(spiked, ["entity"], ["x"], [0.05, 0.5]).count()
    assert quantiles.quantile_table(spiked, ["entity"], ["x"], [0.05, 0.5]).count() == plain == 4
    clipped = [rows(hygiene.winsorize(spiked, PANEL, ["x"], large=large).select("entity", "dt", F.round("x", 6).alias("x"))) for large in (False, True)]
    assert clipped[0] == clipped[1]
    flags = [rows(outliers.iqr_flags(spiked, PANEL, ["x"], large=large)) for large in (False, True)]
    assert flags[0] == flags[1]
    report = outliers.outlier_report(spiked, PANEL, ["x"])
    assert report.where("entity is null").count() == 1 and report.count() == 4


def test_weights(frame):
    got = slices.sample_weights(frame, "entity")
    assert got.count() == 40 and {r["weight"] for r in got.collect()} == {0.1}


@pytest.mark.parametrize("limit", [200_000, 0])
def test_join_checked_keeps_null_keys_in_either_plan(frame, limit):
    right = frame.groupBy("entity").agg(F.count("*").alias("n"))
    got = joins.join_checked(frame, right, ["entity"], max_rows=limit, hot_rows=5, salts=4)
    assert got.count() == 40 and got.where("n = 10").count() == 40 and got.columns == ["entity", "dt", "x", "n"]


def test_running_totals_carry_over_null_values(spark):
    df = spark.createDataFrame([(k, v) for k, v in enumerate([None, 5, None, None, 7, None])], "at int, v long").coalesce(1)
    got = {r["at"]: r["t"] for r in blocks.running_totals(df, [], ["at"], {"t": "v"}, n_blocks=3).collect()}
    assert [got[k] for k in range(6)] == [None, 5, 5, 5, 12, 12]


def test_stress_index_with_repeated_dates(spark):
    df = spark.createDataFrame([(START + dt.timedelta(days=k // 2), float(k % 5), float(k % 3), float(k)) for k in range(12)], "dt date, vix double, a double, b double")
    out = features.stress_index(df, Panel((), "dt"), ["vix", "a", "b"], "vix")
    assert out.count() == 12 and out.columns == [*df.columns, "stress_index"]


def test_fix_applied_tells_what_ran(spark):
    issues = spark.createDataFrame([
        ("d", "CRITICAL", "date column type", "other", 1, 0.0, True), ("d", "ERROR", "no duplicate rows", None, 1, 0.0, True),
        ("d", "ERROR", "no inf values", "gone", 1, 0.0, True), ("d", "ERROR", "no null columns", "empty", 1, 0.0, False),
    ], checks.ISSUE)
    df = spark.createDataFrame([("a", START, "x", None), ("a", START, "x", None)], "entity string, dt date, other string, empty string")
    out, log = checks.remediate(df, issues, PANEL)
    assert out.count() == 1 and "empty" in out.columns
    assert {(r["check_name"], r["column"]): r["fix_applied"] for r in log.collect()} == {
        ("date column type", "other"): False, ("no duplicate rows", None): True, ("no inf values", "gone"): False, ("no null columns", "empty"): False}


def test_untested_features_are_reported(spark):
    df = spark.range(400).select((F.when(F.col("id") < 200, F.date_add(F.lit(START), F.col("id").cast("int"))).otherwise(F.date_add(F.lit(dt.date(2022, 1, 1)), (F.col("id") - 200).cast("int")))).alias("dt"),
                                 F.col("id").cast("double").alias("full"), F.when(F.col("id") % 20 == 0, F.lit(1.0)).alias("thin"), F.lit(None).cast("double").alias("none"))
    got = {r["feature"]: r for r in drift.drift_report(df, "dt", ["full", "thin", "none"], (2020, 2020), (2022, 2022)).collect()}
    assert [got[f]["tested"] for f in ("full", "thin", "none")] == [True, False, False]
    assert got["thin"]["p_value"] is None and got["none"]["severity"] == "UNTESTED" and got["full"]["severity"] == "HIGH"
