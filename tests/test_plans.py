"""Plan shape: what reaches the scan, what is shuffled, what is never built."""

import pytest
from pyspark.sql import functions as F

from catalog import REGISTRY
from catalog.views import ENTITY, prices
from pitpanel.operators import checks, windows


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_filter_and_columns_reach_the_scan(spark, sf):
    text = plan(REGISTRY.queries["period_filter"](spark, sf))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double,o_orderdate:timestamp" in text


@pytest.mark.parametrize("name", ["entity_panel", "merge_entity_macro", "slice_ks_pairs", "temporal_slices", "drift_report", "threshold_flags",
                                  "health_score", "winsorize_global", "checkpoint_verdict", "quarterly_to_daily"])
def test_no_cross_join(spark, sf, name):
    text = plan(REGISTRY.queries[name](spark, sf))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_chained_windows_share_one_shuffle(spark, sf):
    base = prices(spark, sf)
    out = windows.pct_change(base, ENTITY, {"r": ("price", 1)})
    out = windows.moving_average(out, ENTITY, {"m": ("price", 20)})
    out = windows.annualized_volatility(out, ENTITY, {"v": ("r", 22)})
    out = windows.rsi(out, ENTITY, "price", "rsi")
    assert plan(out).count("Exchange hashpartitioning(entity") <= plan(base).count("Exchange hashpartitioning(entity") + 1
    assert plan(out).count("+- Sort [entity") == 1


def test_daily_grain_is_reached_before_the_join(spark, sf):
    text = plan(prices(spark, sf))
    assert text.index("Join") < text.index("HashAggregate")  # printed top down: the join sits above the aggregate
    assert text.count("partial_sum") >= 1


def test_history_limit_is_applied_before_the_shuffle(spark):
    runs = spark.range(500).select((F.col("id") % 3).alias("dataset"), F.col("id").alias("run"))
    assert "WindowGroupLimit" in plan(checks.recent_runs(runs, ["dataset"], ["run"], 100))


def test_merge_quality_compares_the_keys_of_the_panels(spark, sf):
    text = plan(REGISTRY.queries["merge_quality"](spark, sf))
    assert "l_suppkey" in text and "c_custkey" not in text
    assert "statements" in REGISTRY.sql["merge_quality"] and "merge_quality_customers" in REGISTRY.sql
