"""Small worked examples and invariants."""

import datetime as dt
import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pitpanel import Panel
from pitpanel.operators import (blocks, checks, dedupe, drift, expectations as ex, features, fill, hygiene, joins, merge,
                                outliers, profile, quantiles, slices, windows)
from pitpanel.plans import suites
from pitpanel.sources import readers, sinks

DATED = Panel((), "dt")
ENTITY = Panel(("entity",), "dt")


def days(n, start=dt.date(2020, 1, 1)):
    return [start + dt.timedelta(days=i) for i in range(n)]


def series(spark, values, entity=None, name="x"):
    rows = [(d, v) if entity is None else (entity, d, v) for d, v in zip(days(len(values)), values)]
    cols = f"dt date, {name} double" if entity is None else f"entity string, dt date, {name} double"
    return spark.createDataFrame(rows, cols)


def column(df, name, *order):
    return [r[name] for r in df.orderBy(*(order or ("dt",))).collect()]


def test_moving_average(spark):
    out = windows.moving_average(series(spark, [float(i) for i in range(1, 11)]), DATED, {"m": ("x", 5)})
    got = column(out, "m")
    assert got[0] == 1 and got[4] == 3 and got[9] == 8


def test_returns(spark):
    got = column(windows.pct_change(series(spark, [100.0, 105.0, 110.0, 108.0, 112.0]), DATED, {"r": ("x", 1)}), "r")
    assert got[0] is None and got[1] == pytest.approx(5.0) and got[2] == pytest.approx(4.7619, abs=1e-3)


def test_pct_change_pads_but_rsi_does_not(spark):
    df = series(spark, [100.0, None, 110.0])
    assert column(windows.pct_change(df, DATED, {"r": ("x", 1)}), "r") == [None, 0.0, pytest.approx(10.0)]
    assert column(windows.rsi(df, DATED, "x", "r"), "r") == [None, None, None]  # the step over the gap is no move


def test_zero_base_gives_null_not_infinity(spark):
    assert column(windows.pct_change(series(spark, [0.0, 5.0]), DATED, {"r": ("x", 1)}), "r") == [None, None]


def test_macd_matches_pandas(spark):
    values = [10.0, 11.0, None, None, 9.0, 12.5, 13.0, None, 12.0]
    got = windows.macd(series(spark, values, "A"), ENTITY, "x")
    s = pd.Series(values, dtype="float64")
    line = s.ewm(span=12, adjust=False).mean() - s.ewm(span=26, adjust=False).mean()
    assert column(got, "macd") == pytest.approx(list(line))
    assert column(got, "macd_signal") == pytest.approx(list(line.ewm(span=9, adjust=False).mean()))


def test_rolling_features_match_pandas(spark):
    values = [float((i * 37) % 101) if i % 7 else None for i in range(300)]
    s = pd.Series(values, dtype="float64")
    df = series(spark, values)
    out = windows.moving_average(df, DATED, {"m": ("x", 22)})
    out = windows.rolling_std(out, DATED, {"s": ("x", 22)})
    out = windows.rsi(out, DATED, "x", "r")
    d = s.diff()
    g, l = d.where(d > 0, 0).rolling(14, min_periods=1).mean(), (-d.where(d < 0, 0)).rolling(14, min_periods=1).mean()
    expected = {"m": s.rolling(22, min_periods=1).mean(), "s": s.rolling(22, min_periods=1).std(), "r": 100 - 100 / (1 + g / l.replace(0, float("nan")))}
    for name, want in expected.items():
        for a, b in zip(column(out, name), want):
            assert (a is None and math.isnan(b)) or a == pytest.approx(b, abs=1e-9), name


def test_long_frames_are_composed(spark):
    """Gaps, equal values, an infinity and whole numbers, two entities; frames of many rows are not read row by row."""
    rng = np.random.default_rng(3)
    rows = []
    for e in (None, 7):
        x = rng.lognormal(3, 2, 500)
        x[rng.random(500) < 0.2] = np.nan
        x[100:300] = 0.1
        x[350] = np.inf if e else 1.0
        rows += [(e, dt.date(2020, 1, 1) + dt.timedelta(days=i), None if math.isnan(v) else float(v), i * i) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "entity long, dt date, x double, k long").repartition(5)
    by = Panel(("entity",), "dt")
    out = windows.moving_average(df, by, {"a": ("x", 200), "b": ("k", 50), "c": ("x", 5)})
    out = windows.moving_average(out, by, {"full": ("x", 150)}, min_rows=100)
    out = windows.rolling_std(out, by, {"d": ("x", 130), "f": ("k", 250)})
    assert out.columns == ["entity", "dt", "x", "k", "a", "b", "c", "full", "d", "f"]
    text = out._jdf.queryExecution().executedPlan().toString()
    assert not any(f"RowFrame, -{n - 1}, currentrow" in text for n in (50, 130, 150, 200, 250))
    got = out.orderBy("dt").toPandas()
    for e in (None, 7):
        g = got[got.entity.isna() if e is None else got.entity == e].reset_index(drop=True)
        for name, c, n, how, need in (("a", "x", 200, "mean", 1), ("b", "k", 50, "mean", 1), ("c", "x", 5, "mean", 1), ("full", "x", 150, "mean", 100), ("d", "x", 130, "std", 1), ("f", "k", 250, "std", 1)):
            for i in range(len(g)):
                v = g[c][max(0, i - n + 1):i + 1].dropna().to_numpy("float64")
                with np.errstate(invalid="ignore"):
                    want = np.nan if len(v) < max(need, 2 if how == "std" else 1) else v.mean() if how == "mean" else 0.0 if len(set(v)) == 1 and np.isfinite(v).all() else v.std(ddof=1)
                assert g[name][i] == pytest.approx(want, rel=1e-12, abs=0, nan_ok=True), (e, name, i)


def test_macd_orders_and_weighs_each_row_once(spark):
    df = series(spark, [float(i % 9) if i % 4 else None for i in range(300)])
    text = windows.macd(df, DATED, "x")._jdf.queryExecution().optimizedPlan().toString()
    assert "array_sort(" not in text and text.lower().count("pow(") <= 4


def test_fill_within_group(spark):
    df = series(spark, [1.0, None, 3.0], "A").unionByName(series(spark, [None, 10.0, None], "B"))
    assert column(fill.forward_fill(df, ENTITY, ["x"]), "x", "entity", "dt") == [1, 1, 3, None, 10, 10]
    assert column(fill.forward_backward_fill(df, ENTITY, ["x"]), "x", "entity", "dt") == [1, 1, 3, 10, 10, 10]


def test_fill_is_idempotent_and_blocks_change_nothing(spark):
    values = [float(i) if i % 5 == 0 and i > 20 else None for i in range(200)]
    df = series(spark, values, "A").unionByName(series(spark, values[::-1], "B"))
    once = fill.fill_no_lookahead(df, ENTITY, ["x"])
    want = column(once, "x", "entity", "dt")
    assert column(fill.fill_no_lookahead(once, ENTITY, ["x"]), "x", "entity", "dt") == want
    for n in (1, 3, 8):
        cut = blocks.fill_forward(df, ["entity"], ["dt"], ["x"], n_blocks=n)
        assert column(cut, "x", "entity", "dt") == column(fill.forward_fill(df, ENTITY, ["x"]), "x", "entity", "dt")
    assert column(fill.fill_no_lookahead(df, ENTITY, ["x"], blocked=True), "x", "entity", "dt") == want
    assert (column(fill.forward_backward_fill(df, ENTITY, ["x"], blocked=True), "x", "entity", "dt")
            == column(fill.forward_backward_fill(df, ENTITY, ["x"]), "x", "entity", "dt"))


def test_hot_key_spreads_over_blocks(spark):
    df = spark.range(20_000).select(F.when(F.col("id") % 10 < 7, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    sizes = blocks.range_blocks(df, ["k", "id"], 8).filter("k = 'hot'").groupBy(blocks.BLOCK).count().collect()
    assert len(sizes) >= 4 and max(r["count"] for r in sizes) < 14_000 * 0.4


def test_halo_windows_equal_plain_windows(spark):
    df = series(spark, [float((i * 13) % 17) for i in range(400)], "A").unionByName(series(spark, [2.0, 1.0], "B"))

    def build(w):
        return {"l": F.lag("x", 7).over(w), "m": F.sum("x").over(w.rowsBetween(-6, 0))}

    cut = blocks.with_halo(df, ["entity"], ["dt"], 7, build, slab_rows=10)
    plain = df.withColumns(build(ENTITY.ordered()))
    assert cut.count() == df.count()
    assert sorted(map(tuple, cut.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


def test_no_value_before_it_was_known(spark):
    st = spark.createDataFrame([("A", dt.date(2020, 3, 31), 1.0), ("A", dt.date(2020, 6, 30), 2.0)], "entity string, dt date, revenue double")
    daily = fill.quarterly_to_daily(fill.reporting_lag(st, "dt", 45), ENTITY)
    rows = {r["dt"]: r["revenue"] for r in daily.collect()}
    assert min(rows) == dt.date(2020, 5, 15) and rows[dt.date(2020, 8, 13)] == 1.0 and rows[dt.date(2020, 8, 14)] == 2.0


def test_quarterly_to_daily_fills_per_column_and_leads_with_nulls(spark):
    st = spark.createDataFrame(
        [("A", dt.date(2020, 1, 1), 1.0, 5.0, None), ("A", dt.date(2020, 1, 4), 2.0, None, "Tech"), ("B", dt.date(2020, 1, 3), 9.0, 9.0, None)],
        "entity string, dt date, a double, b double, grp string")
    out = fill.quarterly_to_daily(st, ENTITY, {"grp": "=Unknown"})
    got = {(r["entity"], r["dt"].day): (r["a"], r["b"], r["grp"]) for r in out.collect()}
    assert len(got) == 8
    assert got["A", 3] == (1.0, 5.0, None) and got["A", 4] == (2.0, 5.0, None)
    assert got["B", 2] == (None, None, "Unknown") and got["B", 4] == (9.0, 9.0, "Unknown")


def test_outer_merge_of_offset_ranges(spark):
    a = spark.createDataFrame([(d, 1.0) for d in days(10)], "dt date, a double")
    b = spark.createDataFrame([(d, 2.0) for d in days(11, dt.date(2020, 1, 5))], "dt date, b double")
    assert merge.merge_outer(a, b, ["dt"]).count() == 15
    assert merge.add_context(a, b, "dt").count() == a.count()


def test_winsorize(spark):
    df = series(spark, [float(i) for i in range(1, 12)] + [1000.0], "A")
    for large in (False, True):
        got = column(hygiene.winsorize(df, ENTITY, ["x"], (0.01, 0.95), large=large), "x")
        assert max(got) < 1000 and len(got) == 12
        assert max(got) == pytest.approx(float(pd.Series([*range(1, 12), 1000]).quantile(0.95)))
    few = series(spark, [1.0, 2.0, 1000.0], "A")
    assert max(column(hygiene.winsorize(few, ENTITY, ["x"]), "x")) == 1000


def test_large_quantiles_equal_pandas(spark):
    values = [float((i * i) % 977) for i in range(1500)]
    df = spark.createDataFrame([("h" if i % 3 else "c", v) for i, v in enumerate(values)], "k string, v double")
    got = {(r["k"], r["p"]): r["value"] for r in quantiles.large_quantiles(df, ["k"], ["v"], [0.0, 0.05, 0.5, 0.999, 1.0]).collect()}
    for k in ("h", "c"):
        s = pd.Series([v for i, v in enumerate(values) if (k == "h") == bool(i % 3)])
        for p in (0.0, 0.05, 0.5, 0.999, 1.0):
            assert got[k, p] == pytest.approx(s.quantile(p))
    rough = {r["k"]: r["v_q5"] for r in quantiles.approximate_quantiles(df, ["k"], ["v"], [0.5]).collect()}
    assert rough["h"] == pytest.approx(got["h", 0.5], abs=3)


def test_inf_constants_ratios_suffixes(spark):
    df = spark.createDataFrame([(1.0, 5.0, 5.0, -2000.0, -3.0), (float("inf"), 5.0, 5.0 + 1e-12, 1.0, 2.0), (float("-inf"), 5.0, 5.0, 1.0, 2.0)],
                               "x double, constant double, tiny double, net_margin double, current_ratio double")
    assert [r["x"] for r in hygiene.inf_to_null(df).collect()].count(None) == 2
    assert hygiene.constant_columns(hygiene.inf_to_null(df), []) == ["x", "constant", "tiny"]
    fixed = hygiene.ratio_repair(df).collect()[0]
    assert fixed["net_margin"] == -1000 and fixed["current_ratio"] == 3
    named = spark.createDataFrame([(1, 2, 3, 4)], "Value int, Value_x int, GDP_fred int, GDP_macro int")
    assert hygiene.resolve_duplicate_columns(named).columns == ["Value", "GDP"]


def test_dedupe_is_deterministic(spark):
    df = spark.createDataFrame([("A", dt.date(2020, 1, 1), i, float(i)) for i in range(5)], "entity string, dt date, _ord int, v double")
    assert dedupe.keep_last(df, ENTITY.keys, ["_ord"]).collect()[0]["v"] == 4
    assert dedupe.keep_first(df, ENTITY.keys, ["_ord"]).collect()[0]["v"] == 0
    assert tuple(dedupe.duplicate_count(df, ENTITY.keys).collect()[0]) == (4, 5, 1)


def test_rules_and_jumps(spark):
    df = spark.createDataFrame([(v,) for v in (15.0, 20.0, -5.0, 18.0, 22.0)], "vix double")
    assert outliers.rule_report(df).collect()[0]["count"] == 1
    d2 = spark.createDataFrame([(2.0, 10.0), (3.0, 15.0), (150.0, 200.0), (4.0, -50.0), (5.0, 25.0)], "debt_to_equity double, profit_margin double")
    assert {r["column"]: r["count"] for r in outliers.rule_report(d2).collect()} == {"debt_to_equity": 1, "profit_margin": 1}
    jumps = outliers.jump_flags(series(spark, [100.0, 102.0, 105.0, 300.0, 108.0], "A"), ENTITY, ["x"], min_rows=5)
    assert sum(column(jumps, "x_jump_flag")) == 2 and jumps.count() == 5


def test_representation_and_weights(spark):
    df = spark.createDataFrame([(k,) for k, n in (("A", 100), ("B", 100), ("C", 10)) for _ in range(n)], "k string")
    status = {r["k"]: r["status"] for r in slices.representation_bias(df, "k").collect()}
    assert status["C"] == "under" and status["A"] == "over"
    assert slices.sample_weights(df, "k").agg(F.sum("weight")).first()[0] == pytest.approx(3.0)
    assert slices.imbalance_ratio(df, "k").first()["imbalance_ratio"] == 10


def test_drift(spark):
    rows = [(dt.date(2005 if i < 200 else 2020, 1, 1) + dt.timedelta(days=i % 200), 10.0 + i % 7 if i < 200 else 15.0 + i % 7 * 1.5, 1.0 + i % 5) for i in range(400)]
    df = spark.createDataFrame(rows, "dt date, moved double, same double")
    got = {r["feature"]: r for r in drift.drift_report(df, "dt", ["moved", "same"], (2005, 2010), (2020, 2025)).collect()}
    a, b = [r[1] for r in rows[:200]], [r[1] for r in rows[200:]]
    brute = max(abs(sum(x <= v for x in a) / 200 - sum(x <= v for x in b) / 200) for v in a + b)
    assert got["moved"]["ks_statistic"] == pytest.approx(brute) and got["moved"]["severity"] in ("HIGH", "MEDIUM")
    assert got["same"]["severity"] == "STABLE"
    flagged = drift.drift_flag(df, drift.drift_report(df, "dt", ["moved", "same"], (2005, 2010), (2020, 2025)))
    assert flagged.agg(F.sum("feature_drift_flag")).first()[0] == 400


def test_salted_join_equals_plain_join(spark):
    left = spark.range(1000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    right = left.select("k").distinct().withColumn("v", F.col("k") * 10)
    for how in ("left", "inner"):
        some = right.filter("k < 500") if how == "left" else right
        plain = left.join(some, "k", how)
        salted = joins.join_checked(left, some, ["k"], how, max_rows=0, hot_rows=50, salts=7)
        assert sorted(map(tuple, salted.select("k", "id", "v").collect()), key=str) == sorted(map(tuple, plain.select("k", "id", "v").collect()), key=str)


def test_calendar_join_refuses_repeated_days(spark):
    left = series(spark, [1.0, 2.0])
    twice = series(spark, [5.0], name="y").unionByName(series(spark, [6.0], name="y"))
    assert joins.join_calendar(left, series(spark, [5.0], name="y"), "dt").count() == 2
    with pytest.raises(Exception, match="more than once"):
        joins.join_calendar(left, twice, "dt").collect()
    with pytest.raises(ValueError):
        joins.join_calendar(left, series(spark, [5.0]).withColumn("dt", F.lit("x")), "dt")


def test_asof_keeps_statement_dated_on_a_missing_day(spark):
    left = spark.createDataFrame([("A", d, 1.0) for d in (dt.date(2020, 1, 1), dt.date(2020, 1, 6))], "entity string, dt date, p double")
    right = spark.createDataFrame([("A", dt.date(2020, 1, 4), 7.0)], "entity string, dt date, v double")
    assert column(fill.asof_join(left, right, ENTITY, ["v"]), "v") == [None, 7.0]
    assert column(fill.exact_date_join_fill(left, right, ENTITY, ["v"]), "v") == [None, None]


def test_statement_payload_keys_and_text(spark):
    text = '{"quarterlyReports":[{"fiscalDateEnding":"2020-03-31","totalRevenue":"None","revenue":"5"},{"date":"2020-06-30","totalRevenue":"","revenue":"7.5"},{"date":"2020-09-30","totalRevenue":"0"},{"date":"soon","revenue":"n/a"}]}'
    df = spark.createDataFrame([("A", text)], "entity string, payload string")
    out = readers.statement_rows(df, "entity", "payload", {"revenue": ["totalRevenue", "revenue"]})
    assert column(out, "revenue") == [None, None, 7.5, 0.0]
    assert [d and d.month for d in column(out, "dt")] == [None, 3, 6, 9]


def test_csv_round_trip_and_report(spark, tmp_path):
    df = series(spark, [1.0, None, 3.0], "A")
    sinks.write_csv(df, str(tmp_path / "c"))
    back = readers.read_csv(spark, str(tmp_path / "c"), "entity string, dt date, x double", ["dt"])
    assert column(back, "x") == [1.0, None, 3.0] and back.schema["dt"].dataType.simpleString() == "date"
    sinks.write_parquet(df, str(tmp_path / "p"), partition_by=["entity"])
    assert spark.read.parquet(str(tmp_path / "p")).count() == 3
    for run in ("t1", "t2"):
        sinks.write_report(df, str(tmp_path / "r"), run)
    assert spark.read.json(str(tmp_path / "r")).groupBy("run_ts").count().count() == 2


def test_expectations(spark):
    df = spark.createDataFrame([("A", dt.date(2020, 1, 1), 1.0), ("A", dt.date(2020, 1, 1), None), ("B", dt.date(2020, 1, 2), 3.0)], "Company string, Date date, GDP double")
    suite = [*ex.exist("Date", "CPI"), *ex.not_null("GDP", mostly=0.9), *ex.between("GDP", 2, None, 0.5), *ex.unique("Company"),
             *ex.unique_together("Company", "Date"), *ex.distinct_between("Company", 2, 2), *ex.between("CPI", 0, 1)]
    got = [(r["success"], r["severity"]) for r in ex.evaluate(df, suite, "s").orderBy("position").collect()]
    assert [g[0] for g in got] == [True, False, False, True, False, False, True, False]
    assert got[1][1] == "CRITICAL" and got[2][1] == "CRITICAL" and got[3][1] == "ERROR"
    assert not ex.gate(ex.evaluate(df, suite, "s"), "CRITICAL").first()["passed"]
    assert ex.severity_of(ex.mean_between("x", 0, 1)[0]) == "ERROR"
    empty = ex.evaluate(df.limit(0), suite[2:4], "s")
    assert all(r["success"] for r in empty.collect())


def test_suites_evaluate_on_any_table(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, 1), 1.0)], "Date date, GDP double")
    for suite in (suites.RAW_MACRO, suites.CLEAN_MACRO, suites.CLEAN_MERGED_PANEL, suites.merged_macro("2020-01-01", "2020-12-31")):
        assert ex.evaluate(df, suite, "s", other=df).count() == len(suite)


def test_checks_and_remediation(spark):
    df = spark.createDataFrame([("2020-01-01", "A", 1.0, float("inf"), None), ("2020-01-01", "A", 1.0, 2.0, None), ("2020-03-15", "A", 3.0, 2.0, None)],
                               "Date string, Company string, Stock_Price double, Close double, empty double")
    panel = Panel(("Company",), "Date")
    rules = checks.rules_for("company_prices")
    assert rules.required == ("Date", "Company") and "Close" in rules.keys
    issues = checks.critical(df, "company_prices", rules).unionByName(checks.errors(df, "company_prices", rules, panel))
    names = {(r["check_name"], r["column"]) for r in issues.collect()}
    assert {("date column type", "Date"), ("no null columns", "empty"), ("no inf values", "Close"), ("no duplicate rows", None)} <= names
    fixed, log = checks.remediate(df, issues, panel)
    assert fixed.count() == 2 and "empty" not in fixed.columns and fixed.schema["Date"].dataType.simpleString() == "date"
    assert log.filter("fix_applied").count() == 4
    later = checks.validate(fixed, "company_prices", panel, rules)
    counts = checks.issue_counts(later, ["company_prices"]).first()
    assert counts["critical"] == 0 and counts["passed"] and counts["warning"] >= 1


def test_history_keeps_latest(spark):
    runs = spark.range(500).select(F.lit("d").alias("dataset"), F.col("id").alias("run"))
    kept = checks.recent_runs(runs, ["dataset"], ["run"], 100)
    assert checks.append_history(runs, runs.drop("run")).count() == 1000
    assert kept.count() == 100 and kept.agg(F.min("run")).first()[0] == 400


def test_stress_index_sign_and_scale(spark):
    rows = [(d, float(i % 13), float(i % 13) * 2 + i % 3, 5.0 - i % 13) for i, d in enumerate(days(200))]
    df = spark.createDataFrame(rows, "dt date, vix double, ted double, rate double")
    out = features.stress_index(df, DATED, ["vix", "ted", "rate"], "vix")
    assert out.count() == 200 and out.stat.corr("stress_index", "vix") > 0.9
    assert features.stress_index(df, DATED, ["vix", "nope"], "vix") is df


def test_macd_blocked_matches_pandas_with_a_hot_entity(spark, monkeypatch):
    from pitpanel.operators import recursive

    monkeypatch.setattr(recursive, "SLAB", 8)
    rows = [("hot", k, None if k % 7 in (2, 3) or k < 5 else float((k * 37) % 101)) for k in range(700)]
    rows += [(None, k, float(k)) for k in range(20)] + [("empty", k, None) for k in range(9)] + [("one", 0, 4.0)]
    df = spark.createDataFrame(rows, "entity string, k int, x double")
    want = {}
    for e in {r[0] for r in rows}:
        s = pd.Series([r[2] for r in rows if r[0] == e], dtype="float64")
        line = s.ewm(span=12, adjust=False).mean() - s.ewm(span=26, adjust=False).mean()
        want |= {(e, k): (a, b) for k, (a, b) in enumerate(zip(line, line.ewm(span=9, adjust=False).mean()))}
    for blocked in (True, False):
        out = windows.macd(df, Panel(("entity",), "k"), "x", blocked=blocked)
        assert "Python" not in out._jdf.queryExecution().toString() and "Pandas" not in out._jdf.queryExecution().toString()
        got = {(r["entity"], r["k"]): (r["macd"], r["macd_signal"]) for r in out.collect()}
        assert got.keys() == want.keys()
        for key, (a, b) in want.items():
            assert (got[key] == (None, None)) if a != a else got[key] == pytest.approx((a, b), abs=1e-9), key


def test_stacked_merge(spark):
    a = spark.createDataFrame([("x", 1, 1.0, "p"), (None, 1, 2.0, None), (None, 2, None, "q")], "e string, d int, u double, s string")
    b = spark.createDataFrame([("x", 1, 7, "no"), (None, 1, 8, "no"), ("y", None, 9, "no")], "e string, d int, v int, s string")
    got = sorted(map(str, merge.merge_stacked(a, b, ["e", "d"]).collect()))
    assert got == sorted(map(str, merge.merge_outer(a, b, ["e", "d"]).select("e", "d", "u", "s", "v").collect())) and len(got) == 4
    with pytest.raises(Exception, match="more than once"):
        merge.merge_stacked(a.union(a), b, ["e", "d"]).count()


@pytest.mark.parametrize("sizes", [(7, 9), (20, 20), (31, 50)])
def test_exact_ks_counts_paths(spark, sizes):
    from functools import lru_cache
    from math import comb

    from pitpanel.operators import drift

    n, m = sizes
    for hits in (2, 5, 9):
        d = hits / max(n, m)
        reach = round(d * n * m)

        @lru_cache(None)
        def inside(i, j):
            if abs(i * m - j * n) >= reach:
                return 0
            if i == 0 and j == 0:
                return 1
            return (inside(i - 1, j) if i else 0) + (inside(i, j - 1) if j else 0)

        want = 1 - inside(n, m) / comb(n + m, n)
        row = spark.range(1).select(F.lit(d).alias("d"), F.lit(n).cast("long").alias("n"), F.lit(m).cast("long").alias("m"))
        for a, b in (("n", "m"), ("m", "n")):
            assert row.select(drift.ks_exact_p(F.col("d"), F.col(a), F.col(b))).first()[0] == pytest.approx(want, abs=1e-9)


def test_slice_pairs_equal_all_pairs(spark):
    import random

    from pitpanel.operators import drift, slices

    rng = random.Random(3)
    rows = [(f"s{k}" if k else None, rng.gauss(k % 5 / 4, 1 + (k % 3) / 5) if rng.random() > 0.1 else None) for k in range(30) for _ in range(20 + (k * 37) % 190)]
    rows += [("same", 1.0)] * 40
    df = spark.createDataFrame(rows, "s string, x double")
    got = {frozenset((r["slice1"], r["slice2"])): r for r in slices.slice_ks_pairs(df, "s", None, "x").collect()}
    by = {}
    for s, x in rows:
        if x is not None:
            by.setdefault(s, []).append(x)
    pairs = []
    for a in by:
        for b in by:
            if str(a) < str(b):
                both = sorted(set(by[a] + by[b]))
                d = max(abs(sum(v <= x for v in by[a]) / len(by[a]) - sum(v <= x for v in by[b]) / len(by[b])) for x in both)
                pairs.append((a, b, d, len(by[a]), len(by[b])))
    table = spark.createDataFrame(pairs, "a string, b string, d double, n long, m long").withColumn("p", drift.ks_p(F.col("d"), F.col("n"), F.col("m")))
    for r in table.collect():
        key = frozenset((r["a"], r["b"]))
        tested = r["n"] >= 30 and r["m"] >= 30
        assert (key in got) == (not tested or r["p"] < 0.05), r
        if key in got:
            assert got[key]["ks_statistic"] == pytest.approx(r["d"]) and got[key]["tested"] == tested


def test_slice_pairs_take_each_value_once(spark, monkeypatch):
    """Ties over batches and parts, a NaN, a null slice; a value reaches the walk once, however many pairs there are."""
    monkeypatch.setattr(slices, "PART_ROWS", 500)
    sizes, walk = [], slices._exact_gaps

    def counting(rows, cdf, left):
        sizes.append((rows.count(), left.count()))
        return walk(rows, cdf, left)

    monkeypatch.setattr(slices, "_exact_gaps", counting)
    rng = np.random.default_rng(5)
    rows = [(None if k == 0 else f"s{k}", float(np.round(x, 1))) for k in range(6) for x in rng.normal(k / 5, 1, 400)]
    rows += [("s1", float("nan"))] * 9 + [("s2", 0.5)] * 700
    df = spark.createDataFrame(rows, "s string, x double")
    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = {frozenset((r["slice1"], r["slice2"])): r["ks_statistic"] for r in slices.slice_ks_pairs(df, "s", None, "x", alpha=1.1).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    by = {}
    for s, x in rows:
        by.setdefault(s, []).append(np.inf if x != x else x)
    want = {}
    for a, b in itertools.combinations(by, 2):
        both = np.array(sorted(set(by[a] + by[b])))
        want[frozenset((a, b))] = np.abs(np.searchsorted(np.sort(by[a]), both, "right") / len(by[a]) - np.searchsorted(np.sort(by[b]), both, "right") / len(by[b])).max()
    assert got == want
    assert sizes == [(len(rows), 15)]


def test_wide_correlations(spark):
    import numpy as np

    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 120)) @ rng.normal(size=(120, 120)) * 1e3 + 1e6
    x[rng.random(x.shape) < 0.2] = np.nan
    x[:, 5] = 3.0
    x[:, 6] = np.nan
    frame = pd.DataFrame(x, columns=[f"c{k}" for k in range(120)])
    df = spark.createDataFrame(frame).select(*[F.nanvl(c, F.lit(None).cast("double")).alias(c) for c in frame.columns])
    got = {(r["a"], r["b"]): r["correlation"] for r in profile.corr_matrix(df, list(frame.columns)).collect()}
    want = frame.corr()
    assert len(got) == 120 * 120
    for (a, b), r in got.items():
        w = want.loc[a, b]
        assert (r is None) if w != w else r == pytest.approx(w, abs=1e-8), (a, b)


def test_bracketed_quantiles_equal_numpy(spark, monkeypatch):
    import numpy as np

    from pitpanel.operators import quantiles

    monkeypatch.setattr(quantiles, "SKETCH", 200)
    rng = np.random.default_rng(4)
    parts = {"a": rng.normal(size=5000), None: np.round(rng.exponential(size=3000), 1), "c": np.full(900, 2.0), "d": rng.normal(size=3), "e": np.array([np.nan])}
    rows = [(k, None if v != v else float(v)) for k, values in parts.items() for v in values]
    df = spark.createDataFrame(rows, "k string, x double")
    probs = [0.0, 0.001, 0.25, 0.5, 0.9, 0.999, 1.0]
    for by in (["k"], []):
        got = {(r["k"] if by else "all", r["p"]): (r["value"], r["n"]) for r in quantiles.bracketed_quantiles(df, by, ["x"], probs).collect()}
        for k, values in (parts if by else {"all": np.concatenate(list(parts.values()))}).items():
            values = values[~np.isnan(values)]
            for p in probs:
                assert ((k, p) in got) == (len(values) > 0)
                if len(values):
                    assert got[k, p] == (pytest.approx(np.quantile(values, p)), len(values)), (k, p)


def test_runs_are_read_once(spark, tmp_path):
    from pitpanel.sources.runs import append_run, read_runs

    folder = f"file://{tmp_path}/runs"
    assert read_runs(spark, folder) is None
    first = spark.createDataFrame([(1, "a"), (2, "b")], "n int, s string")
    assert append_run(first, folder, "r-1") and not append_run(first, folder, "r-1")
    first.write.parquet(f"{folder}/attempt-half")
    assert append_run(first.drop("s").withColumn("n", F.col("n") + 10), folder, "r.2")
    assert sorted((r["run"], r["n"], r["s"]) for r in read_runs(spark, folder).collect()) == [("r-1", 1, "a"), ("r-1", 2, "b"), ("r.2", 11, None), ("r.2", 12, None)]
    with pytest.raises(ValueError):
        append_run(first, folder, "../x")


def test_late_rows_are_told(spark):
    from pitpanel.operators.incremental import extend_panel, late_rows, panel_state

    panel = Panel(("e",), "d")
    day = lambda k: dt.date(2020, 1, k)
    state = panel_state(spark.createDataFrame([("a", day(k), float(k)) for k in range(1, 6)] + [(None, day(3), 1.0)], "e string, d date, x double"), panel, ["x"], 2)
    assert state.count() == 3
    batch = spark.createDataFrame([("a", day(5), 9.0), ("a", day(6), 7.0), (None, day(4), None), ("new", day(1), 2.0)], "e string, d date, x double")
    assert [tuple(r) for r in late_rows(state, batch, panel).collect()] == [("a", day(5), 9.0)]
    out = extend_panel(state, batch, panel, lambda df: windows.lag_features(fill.forward_fill(df, panel, ["x"]), panel, ["x"], [1]))
    assert sorted(map(str, ((r["e"], r["x"], r["x_lag1"]) for r in out.collect()))) == sorted(map(str, [("a", 7.0, 5.0), (None, 1.0, 1.0), ("new", 2.0, None)]))


def test_suites_over_one_table_evaluate_it_twice(spark):
    rows = [("a", 1.0, "x y"), ("a", -0.0, None), ("b", 0.0, "x"), (None, None, "x y")]
    df = spark.createDataFrame(rows, "k string, v double, t string")
    suite = [*ex.unique("k"), *ex.unique("v"), *ex.unique_together("k", "t"), *ex.distinct_between("t", 1, 2), *ex.rows_equal_other(), *ex.between("v", 0, 1)]
    out = ex.evaluate_all(df, {"one": suite, "two": suite[::-1]}, other=df)
    got = {(r["suite"], r["position"]): (r["observed"], r["success"]) for r in out.collect()}
    want = [(2.0, False), (2.0, False), (0.0, True), (2.0, True), (4.0, True), (1.0, True)]
    assert [got["one", k] for k in range(6)] == want and [got["two", 5 - k] for k in range(6)] == want
    assert out._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") <= 2


def test_quantiles_of_small_groups_are_sorted_in_one_aggregate(spark, monkeypatch):
    rng = np.random.default_rng(11)
    rows = [(f"g{k}", float(x)) for k in range(30) for x in rng.normal(size=5 + k)] + [(None, 1.0), (None, 2.0), ("empty", None)]
    df = spark.createDataFrame(rows, "k string, x double")
    probs = [0.0, 0.001, 0.5, 0.999, 1.0]

    def check(df, rows):
        values = {}
        for k, x in rows:
            values.setdefault(k, []).append(x)
        got = {(r["k"], r["p"]): (r["value"], r["n"]) for r in quantiles.bracketed_quantiles(df, ["k"], ["x"], probs).collect()}
        assert set(got) == {(k, p) for k, v in values.items() if v != [None] for p in probs}
        assert all(n == len(values[k]) and abs(v - np.quantile(values[k], p)) < 1e-12 for (k, p), (v, n) in got.items())

    with monkeypatch.context() as m:
        m.setattr(quantiles, "running_totals", None)  # brackets would call it
        check(df, rows)
    monkeypatch.setattr(quantiles, "SKETCH", 100)
    large = [("large", float(x)) for x in rng.normal(size=500)] + [(None, float(x)) for x in rng.normal(size=300)]
    check(df.unionByName(spark.createDataFrame(large, "k string, x double")), rows + large)
