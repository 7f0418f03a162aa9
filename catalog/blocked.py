"""Ordered operators at the grain of single events: an event type with any number of rows spreads over blocks.

A fifth of the values and, by key arithmetic, a sixth of the types are null.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import REGISTRY
from catalog.features import f32, rows
from catalog.views import read_table, show
from pitpanel import Panel
from pitpanel.operators import fill, outliers, windows

q = REGISTRY.add

BY_TYPE = Panel(("kind",), "ts", ("event_id",))
EV = """ev AS (SELECT event_id, ts, CASE WHEN event_id % 6 <> 0 THEN event_type END AS kind, CASE WHEN event_id % 5 <> 0 THEN value END AS v FROM events)"""
W = "WINDOW w AS (PARTITION BY kind ORDER BY ts, event_id)"
PAD = "pad AS (SELECT *, last_value(v IGNORE NULLS) OVER (PARTITION BY kind ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS p FROM ev)"


def ev(spark, sf):
    e = read_table(spark, sf, "events")
    return e.select("event_id", "ts", F.when(F.col("event_id") % 6 != 0, F.col("event_type")).alias("kind"), F.when(F.col("event_id") % 5 != 0, F.col("value")).alias("v"))


@q("forward_fill_null_keys_blocked", f"WITH {EV}, {PAD} SELECT event_id, kind, p AS v FROM pad")
def _(spark, sf):
    return fill.forward_fill(ev(spark, sf), BY_TYPE, ["v"], blocked=True).select("event_id", "kind", "v")


@q("pct_change_blocked", f"WITH {EV}, {PAD} SELECT event_id, " + ", ".join(f32(f"(p / nullif(lag(p, {n}) OVER w, 0) - 1) * 100", f"change_{n}") for n in (1, 22)) + f" FROM pad {W}")
def _(spark, sf):
    out = windows.pct_change(ev(spark, sf), BY_TYPE, {"change_1": ("v", 1), "change_22": ("v", 22)}, blocked=True)
    return show(out, "event_id", change_1=-1, change_22=-1)


@q("rolling_std_blocked", f"WITH {EV} SELECT event_id, round(stddev_samp(v) OVER (w {rows(30)}), 4) AS std30 FROM ev {W}")
def _(spark, sf):
    return show(windows.rolling_std(ev(spark, sf), BY_TYPE, {"std30": ("v", 30)}, blocked=True), "event_id", std30=4)


@q("annualized_vol_blocked", f"WITH {EV} SELECT event_id, round(stddev_samp(v) OVER (w {rows(22)}) * sqrt(252), 4) AS vol FROM ev {W}")
def _(spark, sf):
    return show(windows.annualized_volatility(ev(spark, sf), BY_TYPE, {"vol": ("v", 22)}, blocked=True), "event_id", vol=4)


@q("relative_to_average_blocked", f"WITH {EV} SELECT event_id, {f32(f'v / nullif(avg(v) OVER (w {rows(20)}), 0)', 'vs20')} FROM ev {W}")
def _(spark, sf):
    return show(windows.relative_to_average(ev(spark, sf), BY_TYPE, {"vs20": ("v", 20)}, blocked=True), "event_id", vs20=-1)


@q("rsi_blocked", f"""
WITH {EV}, d AS (SELECT *, v - lag(v) OVER w AS step FROM ev {W}),
g AS (SELECT event_id, avg(CASE WHEN step > 0 THEN step ELSE 0 END) OVER (w {rows(14)}) AS gain,
             avg(CASE WHEN step < 0 THEN -step ELSE 0 END) OVER (w {rows(14)}) AS loss FROM d {W})
SELECT event_id, round(CASE WHEN loss > 1e-9 THEN 100 - 100 / (1 + gain / loss) END, 4) AS rsi FROM g""")
def _(spark, sf):
    return show(windows.rsi(ev(spark, sf), BY_TYPE, "v", "rsi", blocked=True), "event_id", rsi=4)


@q("trend_flag_blocked", f"""
WITH {EV} SELECT event_id, CASE WHEN count(v) OVER f > 0 THEN
   CASE WHEN count(*) OVER f > 1 AND last_value(v) OVER f > first_value(v) OVER f THEN 1 ELSE 0 END END AS trend
FROM ev WINDOW f AS (PARTITION BY kind ORDER BY ts, event_id {rows(40)})""")
def _(spark, sf):
    return windows.trend_flag(ev(spark, sf), BY_TYPE, "v", "trend", 40, blocked=True).select("event_id", "trend")


@q("base_index_hot_keys", f"WITH {EV} SELECT event_id, {f32('v / nullif(first_value(v) OVER w, 0) * 100', 'base')} FROM ev {W}")
def _(spark, sf):
    return show(windows.base_index(ev(spark, sf), BY_TYPE, "v", "base"), "event_id", base=-1)


@q("forward_targets_blocked", f"WITH {EV} SELECT event_id, " + ", ".join(f32(f"(lead(v, {n}) OVER w / nullif(v, 0) - 1) * 100", f"next_{n}") for n in (1, 30)) + f" FROM ev {W}")
def _(spark, sf):
    return show(windows.forward_targets(ev(spark, sf), BY_TYPE, "v", {"next_1": 1, "next_30": 30}, blocked=True), "event_id", next_1=-1, next_30=-1)


@q("date_gap_blocked", f"""
WITH {EV} SELECT kind, CAST(max(gap) AS BIGINT) AS max_gap_days, CASE WHEN max(gap) > 0 THEN 1 ELSE 0 END AS gap_warning
FROM (SELECT kind, CAST(ts AS DATE) - lag(CAST(ts AS DATE)) OVER w AS gap FROM ev {W}) GROUP BY kind""")
def _(spark, sf):
    return windows.max_date_gap(ev(spark, sf), BY_TYPE, 0, blocked=True).withColumn("max_gap_days", F.col("max_gap_days").cast("long"))


@q("jump_flags_blocked", f"""
WITH {EV}, {PAD}, m AS (SELECT event_id, kind, (p / nullif(lag(p) OVER w, 0) - 1) * 100 AS move, count(*) OVER (PARTITION BY kind) AS n FROM pad {W})
SELECT event_id, CASE WHEN n >= 10 AND abs(move) > 50 THEN 1 ELSE 0 END AS v_jump_flag FROM m""")
def _(spark, sf):
    return outliers.jump_flags(ev(spark, sf), BY_TYPE, ["v"], blocked=True).select("event_id", "v_jump_flag")


@q("median_fill_large", f"WITH {EV}, m AS (SELECT kind, quantile_cont(v, 0.5) AS med FROM ev GROUP BY kind) SELECT event_id, {f32('coalesce(v, med)', 'v')} FROM ev JOIN m ON ev.kind IS NOT DISTINCT FROM m.kind")
def _(spark, sf):
    return show(fill.median_fill(ev(spark, sf), BY_TYPE, ["v"], large=True), "event_id", v=-1)


@q("asof_join_blocked", f"""
WITH {EV}, l AS (SELECT event_id, ts, kind FROM ev WHERE event_id % 2 = 0), r AS (SELECT event_id AS right_id, ts, kind, v FROM ev WHERE event_id % 2 = 1 AND v IS NOT NULL),
stacked AS (SELECT event_id, ts, kind, NULL AS v, 1 AS side, event_id AS tie FROM l UNION ALL SELECT NULL, ts, kind, v, 0, right_id FROM r),
f AS (SELECT *, last_value(v IGNORE NULLS) OVER (PARTITION BY kind ORDER BY ts, side, tie ROWS UNBOUNDED PRECEDING) AS known FROM stacked)
SELECT event_id, known AS v FROM f WHERE side = 1""")
def _(spark, sf):
    e = ev(spark, sf)
    left = e.where("event_id % 2 = 0").drop("v").withColumn("tie", F.col("event_id"))
    right = e.where("event_id % 2 = 1 and v is not null").withColumnRenamed("event_id", "tie")
    return fill.asof_join(left, right, Panel(("kind",), "ts", ("tie",)), ["v"], blocked=True).select("event_id", "v")
