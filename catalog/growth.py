"""Recursions, panels that grow by batches, reports written twice, small samples, many slices, wide tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog import REGISTRY
from catalog.audit import KS_P, LAM
from catalog.blocked import BY_TYPE, EV, ev
from catalog.features import f32, rows
from catalog.panels import ENTITY_PANEL, MACRO_F, MARKET_F, change, pad
from catalog.validation import COMPANY, MACRO_N, MARKET_N, POST, POST_COLS, POST_SQL, _post, named
from catalog.views import DATED, ENTITY, macro, market, prices, read_table, runs, show, statements
from pitpanel.operators import checks, drift, expectations, fill, profile, slices, windows
from pitpanel.operators.incremental import extend_panel, panel_state
from pitpanel.plans import panels
from pitpanel.session import shared_path, stable
from pitpanel.sources.runs import append_run, read_runs

q = REGISTRY.add

# the recursion row by row, of all event types at once
MACD_EV = f"""
WITH RECURSIVE {EV}, n AS (SELECT event_id, kind, v, row_number() OVER (PARTITION BY kind ORDER BY ts, event_id) AS i FROM ev),
e AS (
  SELECT event_id, kind, i, v AS y12, v AS y26, 1.0::DOUBLE AS w12, 1.0::DOUBLE AS w26, v - v AS s FROM n WHERE i = 1
  UNION ALL
  SELECT event_id, kind, i, y12, y26, w12, w26, CASE WHEN y12 IS NULL THEN s WHEN s IS NULL THEN y12 - y26 ELSE 0.8::DOUBLE * s + 0.2::DOUBLE * (y12 - y26) END FROM (
    SELECT n.event_id, n.kind, n.i, e.s,
      CASE WHEN n.v IS NULL THEN e.y12 WHEN e.y12 IS NULL THEN n.v ELSE (e.w12 * 11 / 13 * e.y12 + 2.0::DOUBLE / 13 * n.v) / (e.w12 * 11 / 13 + 2.0::DOUBLE / 13) END AS y12,
      CASE WHEN n.v IS NULL THEN e.y26 WHEN e.y26 IS NULL THEN n.v ELSE (e.w26 * 25 / 27 * e.y26 + 2.0::DOUBLE / 27 * n.v) / (e.w26 * 25 / 27 + 2.0::DOUBLE / 27) END AS y26,
      CASE WHEN n.v IS NULL AND e.y12 IS NOT NULL THEN e.w12 * 11 / 13 ELSE 1 END AS w12,
      CASE WHEN n.v IS NULL AND e.y26 IS NOT NULL THEN e.w26 * 25 / 27 ELSE 1 END AS w26
    FROM e JOIN n ON n.kind IS NOT DISTINCT FROM e.kind AND n.i = e.i + 1))
SELECT event_id, round(y12 - y26, 4) AS macd, round(s, 4) AS macd_signal FROM e"""


@q("macd_blocked", MACD_EV)
def _(spark, sf):
    return show(windows.macd(ev(spark, sf), BY_TYPE, "v", blocked=True), "event_id", macd=4, macd_signal=4)


LOOKBACK = 200
INCREMENTAL = f"""
WITH f AS (SELECT entity, dt, last_value(price IGNORE NULLS) OVER (PARTITION BY entity ORDER BY dt ROWS UNBOUNDED PRECEDING) AS price FROM prices),
r AS (SELECT *, (price / nullif(lag(price) OVER w, 0) - 1) * 100 AS r1 FROM f WINDOW w AS (PARTITION BY entity ORDER BY dt))
SELECT entity, dt, {f32('price', 'price')}, {f32('r1', 'return_1d')}, {f32('(price / nullif(lag(price, 22) OVER w, 0) - 1) * 100', 'return_22d')},
  {f32(f'avg(price) OVER (w {rows(LOOKBACK)})', 'ma200')}, round(stddev_samp(r1) OVER (w {rows(22)}), 4) AS std22 FROM r WINDOW w AS (PARTITION BY entity ORDER BY dt)"""


def _price_features(df: DataFrame) -> DataFrame:
    out = fill.forward_fill(df, ENTITY, ["price"])
    out = windows.pct_change(out, ENTITY, {"return_1d": ("price", 1), "return_22d": ("price", 22)})
    out = windows.moving_average(out, ENTITY, {"ma200": ("price", LOOKBACK)})
    return windows.rolling_std(out, ENTITY, {"std22": ("return_1d", 22)})


@q("incremental_panel", INCREMENTAL, "prices")
def _(spark, sf):
    p = prices(spark, sf).select("entity", "dt", "price")
    done = stable(_price_features(p.filter("dt < date'1997-01-01'")))
    state = stable(panel_state(done, ENTITY, ["price"], LOOKBACK + 22))
    parts = [done]
    for batch in (p.filter("dt >= date'1997-01-01' and dt < date'1999-06-01'"), p.filter("dt >= date'1999-06-01'")):
        new = stable(extend_panel(state, batch, ENTITY, _price_features))
        state = stable(panel_state(new, ENTITY, ["price"], LOOKBACK + 22, state))
        parts.append(new)
    every = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return show(every, "entity", "dt", price=-1, return_1d=-1, return_22d=-1, ma200=-1, std22=4)


@q("idempotent_append", """SELECT step, run_ts, event_id, duration_s, CASE WHEN event_id % 5 = 0 THEN 'fifth' ELSE 'other' END AS run FROM runs""", "runs")
def _(spark, sf):
    every, folder = runs(spark, sf).select("step", "run_ts", "event_id", "duration_s"), shared_path(spark, "runs")
    every.limit(10).write.parquet(f"{folder}/attempt-left-over")  # an attempt that never got a manifest
    for run, part in (("fifth", "event_id % 5 = 0"), ("other", "event_id % 5 <> 0"), ("fifth", "event_id % 5 = 0"), ("other", "event_id > 0")):
        append_run(every.where(part), folder, run)
    return read_runs(spark, folder)


# weekly totals of two pairs of years: samples so small that the paths of the exact test can be counted
WEEKS = """w AS (SELECT CAST(date_trunc('week', o_orderdate) AS DATE) AS dt, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / 100 AS total, CAST(count(*) AS DOUBLE) AS orders FROM orders GROUP BY 1),
  x AS (SELECT 'total' AS feature, total AS v, year(dt) <= 1997 AS ref FROM w WHERE year(dt) BETWEEN 1996 AND 1999 UNION ALL SELECT 'orders', orders, year(dt) <= 1997 FROM w WHERE year(dt) BETWEEN 1996 AND 1999),
  n AS (SELECT feature, count(*) FILTER (ref) AS n1, count(*) FILTER (NOT ref) AS n2 FROM x GROUP BY 1),
  c AS (SELECT feature, v, count(*) FILTER (ref) AS c1, count(*) FILTER (NOT ref) AS c2 FROM x GROUP BY 1, 2),
  t AS (SELECT feature, sum(c1) OVER o AS t1, sum(c2) OVER o AS t2 FROM c WINDOW o AS (PARTITION BY feature ORDER BY v)),
  d AS (SELECT t.feature, n1, n2, max(abs(CAST(t1 AS DOUBLE) / n1 - CAST(t2 AS DOUBLE) / n2)) AS d FROM t JOIN n ON t.feature = n.feature GROUP BY 1, 2, 3),
  g AS (SELECT *, least(n1, n2) AS a, greatest(n1, n2) AS b, CAST(round(d * n1 * n2) AS BIGINT) AS r FROM d)"""


@q("ks_exact_small", f"""WITH RECURSIVE {WEEKS},
p AS (SELECT feature, n1, n2, d, a, b, r, 0::BIGINT AS s, [1.0::DOUBLE] AS p FROM g UNION ALL
  SELECT feature, n1, n2, d, a, b, r, s + 1, list_transform(range(0, least(s + 1, a) + 1), lambda i: CASE WHEN s + 1 - i > b OR abs(i * b - (s + 1 - i) * a) >= r THEN 0.0::DOUBLE
    ELSE (i * CASE WHEN i > 0 THEN coalesce(p[i], 0) ELSE 0 END + (s + 1 - i) * coalesce(p[i + 1], 0)) / (s + 1) END) FROM p WHERE s < a + b)
SELECT feature, n1 AS n_reference, n2 AS n_current, round(d, 10) AS ks_statistic, round(1 - p[a + 1], 8) AS p_value FROM p WHERE s = a + b""")
def _(spark, sf):
    o = read_table(spark, sf, "orders")
    cents = F.sum(F.round(F.col("o_totalprice") * 100).cast("long")).cast("double") / 100
    weeks = o.groupBy(F.to_date(F.date_trunc("week", "o_orderdate")).alias("dt")).agg(cents.alias("total"), F.count("*").cast("double").alias("orders"))
    out = drift.ks_statistic(weeks, "dt", ["total", "orders"], (1996, 1997), (1998, 1999))
    return show(out, "feature", "n_reference", "n_current", ks_statistic=10, p_value=8)


@q("slice_ks_pairs_entities", f"""
WITH v AS (SELECT entity % 40 AS s, price AS x FROM prices WHERE price IS NOT NULL), g AS (SELECT s, count(*) AS n, avg(x) AS m FROM v GROUP BY s),
c AS (SELECT a.s AS s1, b.s AS s2, a.n AS n1, b.n AS n2, a.m - b.m AS mean_diff FROM g a JOIN g b ON a.s < b.s),
k AS (SELECT s1, s2, n1, n2, mean_diff, x, sum(CASE WHEN v.s = s1 THEN 1 ELSE 0 END) AS c1, sum(CASE WHEN v.s = s2 THEN 1 ELSE 0 END) AS c2 FROM c JOIN v ON v.s = s1 OR v.s = s2 GROUP BY ALL),
t AS (SELECT *, sum(c1) OVER w AS t1, sum(c2) OVER w AS t2 FROM k WINDOW w AS (PARTITION BY s1, s2 ORDER BY x)),
d AS (SELECT s1, s2, n1, n2, mean_diff, max(abs(CAST(t1 AS DOUBLE) / n1 - CAST(t2 AS DOUBLE) / n2)) AS d FROM t GROUP BY ALL),
l AS (SELECT *, {LAM} AS lam FROM d)
SELECT s1 AS slice1, s2 AS slice2, round(d, 10) AS ks_statistic, n1, n2, round(mean_diff, 4) AS mean_diff
FROM l WHERE n1 >= 30 AND n2 >= 30 AND CAST(n1 AS DOUBLE) * n2 > {drift.EXACT_PAIRS} AND {KS_P} < 0.05""", "prices")
def _(spark, sf):
    p = prices(spark, sf).select((F.col("entity") % 40).alias("slice"), "price")
    out = slices.slice_ks_pairs(p, "slice", None, "price")
    # the twin has the asymptotic test only
    large = out.filter(F.col("tested") & (F.col("n1").cast("double") * F.col("n2") > drift.EXACT_PAIRS))
    return show(large, "slice1", "slice2", "n1", "n2", ks_statistic=10, mean_diff=4)


WIDE = 30


def _wide_sql(k: int) -> str:
    return f"CASE WHEN (l_orderkey + {k}) % 7 = 0 THEN NULL ELSE l_quantity * ((l_linenumber * {k}) % 5 - 1) + l_extendedprice / 1000 * ((l_orderkey + {k}) % 3) END"


@q("corr_matrix_wide", "WITH x AS (SELECT " + ", ".join(f"CAST({_wide_sql(k)} AS DOUBLE) AS c{k}" for k in range(WIDE)) + " FROM lineitem) "
   + " UNION ALL ".join(f"SELECT 'c{a}' AS a, 'c{b}' AS b, round(corr(c{a}, c{b}), 6) AS correlation FROM x" for a in range(WIDE) for b in range(a + 1, WIDE)))
def _(spark, sf):
    li = read_table(spark, sf, "lineitem")
    wide = li.select(*[F.when((F.col("l_orderkey") + k) % 7 != 0, F.col("l_quantity") * ((F.col("l_linenumber") * k) % 5 - 1)
                              + F.col("l_extendedprice") / 1000 * ((F.col("l_orderkey") + k) % 3)).alias(f"c{k}") for k in range(WIDE)])
    out = profile.corr_matrix(wide, wide.columns)
    return show(out.filter(F.substring("a", 2, 9).cast("int") < F.substring("b", 2, 9).cast("int")), "a", "b", correlation=6)


@q("distinct_sketches", """SELECT 'o_custkey' AS "column", count(DISTINCT o_custkey) AS exact, count(o_custkey) AS n_values, true AS within FROM orders WHERE o_orderdate >= DATE '1996-01-01' AND o_orderdate < DATE '1999-01-01'
   UNION ALL SELECT 'o_orderkey', count(DISTINCT o_orderkey), count(o_orderkey), true FROM orders WHERE o_orderdate >= DATE '1996-01-01' AND o_orderdate < DATE '1999-01-01'""")
def _(spark, sf):
    o, columns = read_table(spark, sf, "orders"), ["o_custkey", "o_orderkey"]
    stored = stable(profile.distinct_sketches(o, "o_orderdate", columns))
    found = profile.distinct_estimates(stored, "1996-01-01", "1998-12-31")
    some = o.filter((F.col("o_orderdate") >= "1996-01-01") & (F.col("o_orderdate") < "1999-01-01"))
    exact = profile.long_report(some.agg(*[F.count_distinct(c).alias(c) for c in columns]), [[F.lit(c).alias("column"), F.col(c).alias("exact")] for c in columns])
    both = found.join(exact, "column")
    return both.select("column", "exact", "n_values", (F.abs(F.col("estimate") / F.col("exact") - 1) <= 0.05).alias("within"))


# --- checks that had no query -------------------------------------------------------------------

BY_NAME = {"macro_raw": ("macro", MACRO_N), "market_clean": ("market", {k: v for k, v in MARKET_N.items() if k != "VIX"}), "company_prices": ("prices", COMPANY)}


def _required_sql() -> str:
    parts = []
    for name, (table, names) in BY_NAME.items():
        for c in checks.rules_for(name).required:
            held = c in names
            parts.append(f"SELECT '{name}' AS dataset, '{c}' AS \"column\", {str(held).lower()} AS present, {'r' if held else 'CAST(NULL AS BIGINT)'} AS n_rows, "
                         f"{'v' if held else 'CAST(NULL AS BIGINT)'} AS n_values, {'v > 0' if held else 'false'} AS usable FROM (SELECT count(*) AS r, {f'count({names[c]})' if held else '0'} AS v FROM {table})")
    return " UNION ALL ".join(parts)


@q("required_columns_by_name", _required_sql(), "macro", "market", "prices")
def _(spark, sf):
    tables = {"macro": macro, "market": market, "prices": prices}
    frames = {name: named(tables[table](spark, sf), names) for name, (table, names) in BY_NAME.items()}
    return expectations.required_columns_report(frames, {name: checks.rules_for(name).required for name in frames})


ENTITY_MISSING = " + ".join(f"count(*) - count({c})" for c in POST_COLS)


@q("post_clean_by_entity", f"""WITH {POST} {POST_SQL} UNION ALL SELECT 'panel', 'WARNING', 'missing values by entity', CAST(entity AS VARCHAR), CAST(a AS BIGINT), round(CAST(v AS DOUBLE), 6), false
   FROM (SELECT entity, {ENTITY_MISSING} AS a, ({ENTITY_MISSING}) * 100.0 / (count(*) * 9) AS v FROM y GROUP BY entity) WHERE v > 5""", "spiked", "macro")
def _(spark, sf):
    out = checks.post_clean(_post(spark, sf), "panel", ["entity", "dt"], entity="entity")
    return out.withColumn("value", F.round("value", 6))


@q("entity_count", "SELECT 'prices' AS dataset, count(*) AS n_rows, count(DISTINCT entity) AS n_entities, min(dt) AS date_min, max(dt) AS date_max FROM prices", "prices")
def _(spark, sf):
    return profile.dataset_stats(prices(spark, sf), "prices", ENTITY.keys, "dt", entity="entity").select("dataset", "n_rows", "n_entities", "date_min", "date_max")


FILLED = "coalesce(last_value({0} IGNORE NULLS) OVER (PARTITION BY entity ORDER BY dt ROWS UNBOUNDED PRECEDING), first_value({0} IGNORE NULLS) OVER (PARTITION BY entity ORDER BY dt ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"


@q("conditional_fill_mean_blocked", "WITH s AS (SELECT (" + " + ".join(f"100.0 * (count(*) - count({c})) / count(*)" for c in ("equity", "long_debt", "short_debt")) + ") / 3 AS mean FROM statements) SELECT entity, dt, "
   + ", ".join(f"CASE WHEN mean > 1 THEN {FILLED.format(c)} ELSE {c} END AS {c}" for c in ("equity", "long_debt", "short_debt")) + " FROM statements, s", "statements")
def _(spark, sf):
    out = fill.conditional_fill(statements(spark, sf), ENTITY, ["equity", "long_debt", "short_debt"], "mean", 1.0, blocked=True)
    return out.select("entity", "dt", "equity", "long_debt", "short_debt")


@q("total_debt_blocked", f"""WITH {EV}, d AS (SELECT *, coalesce(last_value(v IGNORE NULLS) OVER (PARTITION BY kind ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), 0) AS long FROM ev)
   SELECT event_id, {f32('long + event_id % 100', 'total_debt')} FROM d""")
def _(spark, sf):
    e = ev(spark, sf).withColumn("short", (F.col("event_id") % 100).cast("double"))
    return show(fill.total_debt(e, BY_TYPE, "v", "short", blocked=True), "event_id", total_debt=-1)


# --- panels ---------------------------------------------------------------------------------------

@q("entity_panel_attributes", f"""WITH {ENTITY_PANEL}, names AS (SELECT entity, min(entity_name) AS entity_name, min(grp) AS grp FROM prices GROUP BY entity)
   SELECT mg.entity, mg.dt, coalesce(entity_name, 'Unknown') AS entity_name, coalesce(grp, 'Unknown') AS grp, {f32('mg.price', 'price')}, {f32('mg.revenue', 'revenue')}
   FROM mg LEFT JOIN names ON mg.entity = names.entity""", "prices", "statements")
def _(spark, sf):
    p = prices(spark, sf).select("entity", "dt", "price", "volume", "entity_name", "grp")
    out = panels.entity_panel(p, statements(spark, sf), market(spark, sf).select("dt", "vix"), ENTITY, debt=("long_debt", "short_debt"),
                              attributes={"entity_name": "Unknown", "grp": "Unknown"})
    return show(out, "entity", "dt", "entity_name", "grp", price=-1, revenue=-1)


@q("entity_panel_macd", f"""WITH RECURSIVE {ENTITY_PANEL}, n AS (SELECT entity, dt, price AS v, row_number() OVER (PARTITION BY entity ORDER BY dt) AS i FROM mg),
e AS (
  SELECT entity, dt, i, v AS y12, v AS y26, 1.0::DOUBLE AS w12, 1.0::DOUBLE AS w26, v - v AS s FROM n WHERE i = 1
  UNION ALL
  SELECT entity, dt, i, y12, y26, w12, w26, CASE WHEN y12 IS NULL THEN s WHEN s IS NULL THEN y12 - y26 ELSE 0.8::DOUBLE * s + 0.2::DOUBLE * (y12 - y26) END FROM (
    SELECT n.entity, n.dt, n.i, e.s,
      CASE WHEN n.v IS NULL THEN e.y12 WHEN e.y12 IS NULL THEN n.v ELSE (e.w12 * 11 / 13 * e.y12 + 2.0::DOUBLE / 13 * n.v) / (e.w12 * 11 / 13 + 2.0::DOUBLE / 13) END AS y12,
      CASE WHEN n.v IS NULL THEN e.y26 WHEN e.y26 IS NULL THEN n.v ELSE (e.w26 * 25 / 27 * e.y26 + 2.0::DOUBLE / 27 * n.v) / (e.w26 * 25 / 27 + 2.0::DOUBLE / 27) END AS y26,
      CASE WHEN n.v IS NULL AND e.y12 IS NOT NULL THEN e.w12 * 11 / 13 ELSE 1 END AS w12,
      CASE WHEN n.v IS NULL AND e.y26 IS NOT NULL THEN e.w26 * 25 / 27 ELSE 1 END AS w26
    FROM e JOIN n ON n.entity = e.entity AND n.i = e.i + 1))
SELECT entity, dt, round(y12 - y26, 4) AS price_macd, round(s, 4) AS price_macd_signal FROM e""", "prices", "statements")
def _(spark, sf):
    p = prices(spark, sf).select("entity", "dt", "price", "volume")
    out = panels.entity_panel(p, statements(spark, sf), market(spark, sf).select("dt", "vix"), ENTITY, debt=("long_debt", "short_debt"))
    return show(out, "entity", "dt", price_macd=4, price_macd_signal=4)


REF, CUR = (1996, 1997), (1999, 2000)
DRIFTED = ("price", "volume")
CONTEXT = " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS v, year(dt) BETWEEN {REF[0]} AND {REF[1]} AS ref FROM j WHERE year(dt) BETWEEN {REF[0]} AND {REF[1]} OR year(dt) BETWEEN {CUR[0]} AND {CUR[1]}" for c in DRIFTED)


@q("panel_context_flags", f"""WITH j AS (SELECT p.entity, p.dt, p.price, p.volume, m.vix FROM prices p LEFT JOIN market m ON p.dt = m.dt), x AS (SELECT * FROM ({CONTEXT}) WHERE v IS NOT NULL),
   n AS (SELECT feature, count(*) FILTER (ref) AS n1, count(*) FILTER (NOT ref) AS n2 FROM x GROUP BY 1),
   c AS (SELECT feature, v, count(*) FILTER (ref) AS c1, count(*) FILTER (NOT ref) AS c2 FROM x GROUP BY 1, 2),
   t AS (SELECT feature, sum(c1) OVER w AS t1, sum(c2) OVER w AS t2 FROM c WINDOW w AS (PARTITION BY feature ORDER BY v)),
   d AS (SELECT t.feature, n1, n2, max(abs(CAST(t1 AS DOUBLE) / n1 - CAST(t2 AS DOUBLE) / n2)) AS d FROM t JOIN n ON t.feature = n.feature GROUP BY 1, 2, 3),
   l AS (SELECT *, {LAM} AS lam FROM d), ks AS (SELECT feature, {KS_P} AS p FROM l)
SELECT entity, dt, CASE WHEN vix > 0 AND vix <= 15 THEN 'Low' WHEN vix > 15 AND vix <= 25 THEN 'Medium' WHEN vix > 25 AND vix <= 100 THEN 'High' END AS market_regime,
  CASE WHEN {" OR ".join(f"(EXISTS (SELECT 1 FROM ks WHERE feature = '{c}' AND p < 0.01) AND {c} IS NOT NULL)" for c in DRIFTED)} THEN 1 ELSE 0 END AS feature_drift_flag FROM j""", "prices", "market")
def _(spark, sf):
    joined = panels.merge.add_context(prices(spark, sf).select("entity", "dt", "price", "volume"), market(spark, sf).select("dt", "vix"), "dt")
    return panels.context_flags(joined, ENTITY, "vix", DRIFTED, REF, CUR).select("entity", "dt", "market_regime", "feature_drift_flag")


# the macro panel on its default path: leading gaps by the median of the first ten values, all features, fills both ways
def _lead(table: str, columns) -> str:
    filled = ", ".join(f"{pad(c)} AS {c}" for c in columns)
    known = ", ".join(f"count({c}) OVER (ORDER BY dt ROWS UNBOUNDED PRECEDING) AS k_{c}" for c in columns)
    median = ", ".join(f"coalesce({c}, quantile_cont(CASE WHEN k_{c} <= 10 THEN {c} END, 0.5) OVER ()) AS {c}" for c in columns)
    return f"(SELECT dt, {median} FROM (SELECT *, {known} FROM (SELECT dt, {filled} FROM {table})))"


MC, KC = ["gdp", "cpi", "unemp", "ffr", "spread", "oil", "conf", "ted"], ["vix", "idx"]
MF, KF = [n for n, _, _ in MACRO_F], [n for n, _, _ in MARKET_F]
ALL = [*MC, *MF, *KC, *KF]
DIGITS = {n: d for n, _, d in (*MACRO_F, *MARKET_F)} | {c: -1 for c in (*MC, *KC)}
FILL_ALL = "coalesce(" + pad("{0}") + ", first_value({0} IGNORE NULLS) OVER (ORDER BY dt ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"


def _shown(c: str) -> str:
    d = DIGITS[c]
    return c if d is None else f32(c, c) if d < 0 else f"round({c}, {d}) AS {c}"


@q("macro_panel_full", f"""
WITH cm AS {_lead('macro', MC)}, ck AS {_lead('market', KC)},
mp AS (SELECT *, {pad('gdp')} AS p_gdp, {pad('cpi')} AS p_cpi FROM cm), mi AS (SELECT *, {change('p_cpi', 12)} AS infl FROM mp WINDOW w AS (ORDER BY dt)),
a AS (SELECT dt, {", ".join(MC)}, {", ".join(f"{e.replace('FROM macro', 'FROM cm')} AS {n}" for n, e, _ in MACRO_F)} FROM mi WINDOW w AS (ORDER BY dt)),
kp AS (SELECT *, {pad('idx')} AS p_idx FROM ck), kr AS (SELECT *, {change('p_idx', 1)} AS r1, idx - lag(idx) OVER w AS step FROM kp WINDOW w AS (ORDER BY dt)),
b AS (SELECT dt, {", ".join(KC)}, {", ".join(f"{e} AS {n}" for n, e, _ in MARKET_F)} FROM kr WINDOW w AS (ORDER BY dt)),
j AS (SELECT coalesce(a.dt, b.dt) AS dt, a.* EXCLUDE (dt), b.* EXCLUDE (dt) FROM a FULL JOIN b ON a.dt = b.dt),
s AS (SELECT greatest({", ".join(f"100.0 * (count(*) - count({c})) / count(*)" for c in ALL)}) AS worst FROM j),
z AS (SELECT dt, {", ".join(f"CASE WHEN worst > 5 THEN {FILL_ALL.format(c)} ELSE {c} END AS {c}" for c in ALL)} FROM j, s)
SELECT dt, {", ".join(_shown(c) for c in ALL)} FROM z""", "macro", "market")
def _(spark, sf):
    out = panels.macro_panel(macro(spark, sf), market(spark, sf), DATED)
    return show(out, "dt", *[c for c in ALL if DIGITS[c] is None], **{c: DIGITS[c] for c in ALL if DIGITS[c] is not None})
