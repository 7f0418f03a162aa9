"""Steps over whole entities as arrays: the same values as windows and aggregates, in one pass."""

import math

import pytest
from pyspark.sql import functions as F

from catalog.views import ENTITY
from pitpanel import Panel
from pitpanel.operators import fill, hygiene, windows
from pitpanel.plans import panels
from pitpanel.plans.repair import repair_merged

SCHEMA = "entity int, dt date, x double, n long, word string"


@pytest.fixture(scope="module")
def daily(spark):
    """Three entities, one of them null, with gaps, equal runs, a NaN, a day without a date and a text."""
    rows = []
    for e, days in ((1, 300), (2, 40), (None, 9)):
        for i in range(days):
            x = None if (i * 7 + (e or 0)) % 5 == 0 else 3.0 if 30 <= i < 60 else ((i * 37) % 101) / 7 - 4
            rows.append((e, i, x, None if i % 11 == 3 else (i * i) % 97, "early" if i in (4, 5) else None))
        rows.append((e, None, 2.5, 5, None))
    rows += [(3, 0, None, None, None), (3, 1, None, None, None), (4, 0, float("nan"), 1, "a"), (4, 1, 0.0, 0, None), (4, 2, 5.0, 2, None), (4, 3, 0.0, 3, None)]
    df = spark.createDataFrame(rows, "entity int, i int, x double, n long, word string").repartition(5, "n")
    return df.select("entity", F.date_add(F.lit("2020-01-01").cast("date"), F.col("i")).alias("dt"), "x", "n", "word").localCheckpoint()


def table(df):
    def cell(v):
        return "nan" if isinstance(v, float) and math.isnan(v) else f"{v + 0.0:.9g}" if isinstance(v, float) else v

    return sorted((tuple(cell(v) for v in row) for row in df.collect()), key=str)


def steps(df, **how):
    out = windows.macd(df, ENTITY, "x", **how)
    out = windows.pct_change(out, ENTITY, {"r1": ("x", 1), "r90": ("x", 90), "rn": ("n", 3)}, **how)
    out = windows.moving_average(out, ENTITY, {"m20": ("x", 20), "m200": ("x", 200), "mn": ("n", 5)}, **how)
    out = windows.moving_average(out, ENTITY, {"full": ("x", 4)}, min_rows=0, **how)
    out = windows.rolling_std(out, ENTITY, {"s3": ("x", 3), "s90": ("x", 90)}, **how)
    out = windows.annualized_volatility(out, ENTITY, {"v22": ("r1", 22)}, **how)
    out = windows.rsi(out, ENTITY, "x", "rsi", **how)
    out = windows.lag_features(out, ENTITY, ["x", "word"], (1, 90), **how)
    return windows.trend_flag(out, ENTITY, "x", "rising", 30, **how)


def test_steps_equal_windows(daily):
    some = daily.where("entity is null or entity <> 4")
    held, plain = steps(some, arrays=True), steps(some)
    assert held.dtypes == plain.dtypes
    assert table(held) == table(plain)


def test_zero_and_nan_count_as_in_windows(daily):
    some = daily.where("entity = 4")
    for step in (lambda **how: windows.pct_change(some, ENTITY, {"r": ("x", 1)}, **how), lambda **how: windows.rsi(some, ENTITY, "x", "rsi", **how),
                 lambda **how: windows.trend_flag(some, ENTITY, "x", "up", 3, **how), lambda **how: windows.moving_average(some, ENTITY, {"m": ("x", 2)}, **how)):
        assert table(step(arrays=True)) == table(step())


def test_equal_values_have_no_deviation(spark):
    df = spark.range(50).select(F.lit(1).alias("entity"), F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("dt"), F.lit(0.1).alias("x"))
    out = windows.rolling_std(df, ENTITY, {"s": ("x", 30)}, arrays=True)
    assert {r["s"] for r in out.collect()} == {None, 0.0}


def test_steps_share_one_pass(daily):
    text = steps(daily, arrays=True)._jdf.queryExecution().executedPlan().toString()
    assert text.count("FlatMapGroupsInArrow") == 1 and "Window" not in text


def test_another_panel_takes_a_pass_of_its_own(daily):
    other = Panel(("word",), "dt", ("entity", "n"))
    both = windows.lag_features(windows.lag_features(daily, ENTITY, ["x"], (1,), arrays=True), other, ["x_lag1"], (2,), arrays=True)
    plain = windows.lag_features(windows.lag_features(daily, ENTITY, ["x"], (1,)), other, ["x_lag1"], (2,))
    assert table(both) == table(plain)


def test_clips_and_fills_equal_windows(daily):
    some = daily.where("entity is null or entity <> 4")
    for probs in ((0.001, 0.999), (0.1, 0.85)):
        out = [fill.fill_after_merge(hygiene.winsorize(some, ENTITY, ["x", "n"], probs, arrays=a), ENTITY, ["x", "n", "word"], arrays=a) for a in (True, False)]
        assert out[0].dtypes == out[1].dtypes and table(out[0]) == table(out[1])


def test_entity_features_take_one_pass(daily):
    df = daily.select("entity", "dt", F.col("x").alias("price"), F.col("n").alias("volume"), *[F.col("x").alias(c) for c in ("revenue", "net_income", "assets", "equity")])
    text = panels.entity_features(df, ENTITY)._jdf.queryExecution().executedPlan().toString()
    assert text.count("FlatMapGroupsInArrow") == 1 and "Window" not in text


def test_repair_reads_each_row_once_up_to_the_fills(daily, monkeypatch):
    written = []

    def kept(df):
        written.append(df._jdf.queryExecution().executedPlan().toString())
        return df.localCheckpoint()

    monkeypatch.setattr("pitpanel.plans.repair.stable", kept)
    monkeypatch.setattr("pitpanel.operators.hygiene.stable", kept)
    repair_merged(daily, ENTITY, cut_lineage=True)
    (text,) = written
    assert text.count("FlatMapGroupsInArrow") == 1 and "Window" not in text and "Join" not in text
