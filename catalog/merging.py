"""Joins, merge reports, profiling and wide-table hygiene."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import REGISTRY
from catalog.features import PAD, W, f32, rows
from catalog.views import (DATED, ENTITY, macro, market, prices, raw_prices, read_table, runs, show, spiked,
                           statements)
from pitpanel import Panel
from pitpanel.operators import dedupe, fill, hygiene, merge, profile, quantiles, windows
from pitpanel.plans.repair import repair_merged

q = REGISTRY.add


@q("merge_statements", """
SELECT coalesce(a.entity, b.entity) AS entity, coalesce(a.dt, b.dt) AS dt, a.revenue, a.net_income, b.equity, b.assets
FROM (SELECT * FROM statements WHERE short_debt IS NOT NULL) a FULL JOIN (SELECT * FROM statements WHERE equity IS NOT NULL) b
  ON a.entity = b.entity AND a.dt = b.dt""", "statements")
def _(spark, sf):
    st = statements(spark, sf)
    income = st.dropna(subset=["short_debt"]).select("entity", "dt", "revenue", "net_income")
    balance = st.dropna(subset=["equity"]).select("entity", "dt", "revenue", "equity", "assets")
    return merge.merge_stacked(income, balance, ["entity", "dt"])


DAILY_SQL = f"""daily AS (
 WITH b AS (SELECT min(dt) AS lo, max(dt) AS hi FROM statements),
 days AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS dt FROM b),
 e AS (SELECT DISTINCT entity FROM statements),
 g AS (SELECT e.entity, days.dt, s.revenue, s.equity FROM e, days LEFT JOIN statements s ON s.entity = e.entity AND s.dt = days.dt)
 SELECT entity, dt, {PAD.format('revenue')} AS revenue, {PAD.format('equity')} AS equity FROM g)"""


@q("merge_price_statement", f"""
WITH {DAILY_SQL}
SELECT coalesce(p.entity, d.entity) AS entity, coalesce(p.dt, d.dt) AS dt, p.price, p.volume, d.revenue, d.equity
FROM prices p FULL JOIN daily d ON p.entity = d.entity AND p.dt = d.dt""", "prices", "statements")
def _(spark, sf):
    daily = fill.quarterly_to_daily(statements(spark, sf).select("entity", "dt", "revenue", "equity"), ENTITY)
    return merge.merge_stacked(prices(spark, sf).select("entity", "dt", "price", "volume"), daily, ["entity", "dt"])


# every eleventh entity loses its name: prices and statements of all of them are one entity, and meet in one row per day
NAMELESS = "CASE WHEN entity % 11 <> 0 THEN entity END"


@q("merge_null_entity", f"""
WITH p AS (SELECT {NAMELESS} AS entity, dt, sum(volume) AS volume FROM prices GROUP BY 1, 2),
s AS (SELECT {NAMELESS} AS entity, dt, CAST(sum(CAST(round(revenue * 100) AS BIGINT)) AS DOUBLE) / 100 AS revenue FROM statements GROUP BY 1, 2)
SELECT coalesce(p.entity, s.entity) AS entity, coalesce(p.dt, s.dt) AS dt, CAST(p.volume AS BIGINT) AS volume, s.revenue
FROM p FULL JOIN s ON p.entity IS NOT DISTINCT FROM s.entity AND p.dt = s.dt""", "prices", "statements")
def _(spark, sf):
    p, s = _nameless(spark, sf)
    return merge.merge_stacked(p, s, ["entity", "dt"])


@q("exact_date_null_entity", f"""
WITH p AS (SELECT {NAMELESS} AS entity, dt, CAST(sum(volume) AS BIGINT) AS volume FROM prices GROUP BY 1, 2),
s AS (SELECT {NAMELESS} AS entity, dt, CAST(sum(CAST(round(revenue * 100) AS BIGINT)) AS DOUBLE) / 100 AS revenue FROM statements GROUP BY 1, 2),
j AS (SELECT p.*, s.revenue AS r FROM p LEFT JOIN s ON p.entity IS NOT DISTINCT FROM s.entity AND p.dt = s.dt)
SELECT entity, dt, volume, last_value(r IGNORE NULLS) OVER (PARTITION BY entity ORDER BY dt ROWS UNBOUNDED PRECEDING) AS revenue FROM j""", "prices", "statements")
def _(spark, sf):
    p, s = _nameless(spark, sf)
    return fill.exact_date_join_fill(p, s, ENTITY, ["revenue"])


def _nameless(spark, sf):
    entity = F.when(F.col("entity") % 11 != 0, F.col("entity")).alias("entity")
    p = prices(spark, sf).groupBy(entity, "dt").agg(F.sum("volume").alias("volume"))
    cents = F.sum(F.round(F.col("revenue") * 100).cast("long")).cast("double") / 100
    return p, statements(spark, sf).groupBy(entity, "dt").agg(cents.alias("revenue"))


@q("merge_null_safe", """
SELECT coalesce(a.entity, b.entity) AS entity, coalesce(a.g, b.g) AS g, a.n, b.m
FROM (SELECT entity, CASE WHEN grp = 'ASIA' THEN NULL ELSE grp END AS g, count(*) AS n FROM prices WHERE volume >= 12 GROUP BY 1, 2) a
FULL JOIN (SELECT entity, CASE WHEN grp = 'ASIA' THEN NULL ELSE grp END AS g, count(*) AS m FROM prices WHERE volume < 12 GROUP BY 1, 2) b
ON a.entity = b.entity AND a.g IS NOT DISTINCT FROM b.g""", "prices")
def _(spark, sf):
    p = prices(spark, sf).withColumn("g", F.when(F.col("grp") != "ASIA", F.col("grp")))
    a = p.filter("volume >= 12").groupBy("entity", "g").agg(F.count("*").alias("n"))
    b = p.filter("volume < 12").groupBy("entity", "g").agg(F.count("*").alias("m"))
    return merge.merge_outer(a, b, ["entity", "g"], null_safe=["g"])


@q("merge_macro_market", """
SELECT coalesce(a.dt, b.dt) AS dt, a.gdp, a.oil AS level_fred, b.idx AS level_market, b.vix FROM macro a FULL JOIN market b ON a.dt = b.dt""",
   "macro", "market")
def _(spark, sf):
    a = macro(spark, sf).select("dt", "gdp", F.col("oil").alias("level"))
    b = market(spark, sf).select("dt", F.col("idx").alias("level"), "vix")
    return merge.merge_series(a, b, "dt")


@q("merge_entity_macro", "SELECT p.entity, p.dt, p.price, m.gdp, m.ted, m.oil AS price_macro FROM prices p LEFT JOIN macro m ON p.dt = m.dt",
   "prices", "macro")
def _(spark, sf):
    context = macro(spark, sf).select("dt", "gdp", "ted", F.col("oil").alias("price"))
    return merge.add_context(prices(spark, sf).select("entity", "dt", "price"), context, "dt")


@q("attribute_map", "SELECT s.entity, s.dt, s.revenue, p.grp FROM statements s LEFT JOIN (SELECT entity, min(grp) AS grp FROM prices GROUP BY 1) p ON s.entity = p.entity",
   "statements", "prices")
def _(spark, sf):
    return merge.attribute_map(statements(spark, sf).select("entity", "dt", "revenue"), prices(spark, sf), "entity", "grp")


@q("date_overlap", """SELECT count(CASE WHEN a.dt IS NOT NULL AND b.dt IS NOT NULL THEN 1 END) AS common, count(CASE WHEN b.dt IS NULL THEN 1 END) AS left_only,
   count(CASE WHEN a.dt IS NULL THEN 1 END) AS right_only FROM (SELECT DISTINCT dt FROM prices) a FULL JOIN (SELECT DISTINCT dt FROM macro) b ON a.dt = b.dt""", "prices", "macro")
def _(spark, sf):
    return merge.date_overlap(prices(spark, sf), macro(spark, sf), "dt")


@q("date_alignment", """SELECT greatest(a.lo, b.lo) AS overlap_start, least(a.hi, b.hi) AS overlap_end,
   CAST(greatest(least(a.hi, b.hi) - greatest(a.lo, b.lo), 0) AS BIGINT) AS overlap_days, least(a.hi, b.hi) >= greatest(a.lo, b.lo) AS aligned
   FROM (SELECT min(dt) AS lo, max(dt) AS hi FROM prices) a, (SELECT min(dt) AS lo, max(dt) AS hi FROM macro) b""", "prices", "macro")
def _(spark, sf):
    return merge.date_alignment(prices(spark, sf), macro(spark, sf), "dt")


@q("merge_quality", """
WITH s AS (SELECT DISTINCT entity FROM statements WHERE equity IS NOT NULL), p AS (SELECT DISTINCT entity FROM prices WHERE price > 2000),
m AS (SELECT entity FROM s WHERE entity IN (SELECT entity FROM p))
SELECT (SELECT count(*) FROM s) AS left_keys, (SELECT count(*) FROM p) AS right_keys, (SELECT count(*) FROM m) AS merged_keys,
 (SELECT count(*) FROM m) AS left_kept, ((SELECT count(*) FROM s) - (SELECT count(*) FROM m)) * 100.0::DOUBLE / (SELECT count(*) FROM s) AS lost_pct""",
   "statements", "prices")
def _(spark, sf):
    a = statements(spark, sf).dropna(subset=["equity"]).select("entity", "equity")
    b = prices(spark, sf).filter("price > 2000").select("entity", "price")
    out = merge.merge_quality(a, b, a.join(b.select("entity").distinct(), "entity", "left_semi"), "entity")
    return out.withColumn("lost_pct", (F.col("left_keys") - F.col("left_kept")) * 100.0 / F.col("left_keys"))


@q("merge_quality_customers", """
WITH s AS (SELECT DISTINCT c_custkey AS k FROM customer), p AS (SELECT DISTINCT o_custkey AS k FROM orders), m AS (SELECT k FROM s WHERE k IN (SELECT k FROM p))
SELECT (SELECT count(*) FROM s) AS left_keys, (SELECT count(*) FROM p) AS right_keys, (SELECT count(*) FROM m) AS merged_keys,
 (SELECT count(*) FROM m) AS left_kept, round(((SELECT count(*) FROM s) - (SELECT count(*) FROM m)) * 100.0::DOUBLE / (SELECT count(*) FROM s), 8) AS lost_pct""")
def _(spark, sf):
    a = read_table(spark, sf, "customer").select(F.col("c_custkey").alias("k"))
    b = read_table(spark, sf, "orders").select(F.col("o_custkey").alias("k"))
    return merge.merge_quality(a, b, a.join(b.distinct(), "k", "left_semi"), "k").withColumn("lost_pct", F.round("lost_pct", 8))


def _columns_sql(select: str) -> str:
    """Names and non-null counts of the columns of a query, from its rows."""
    return f"(SELECT c, count(nullif(v, '~null~')) AS n FROM (UNPIVOT (SELECT coalesce(COLUMNS(*)::VARCHAR, '~null~') FROM ({select})) ON COLUMNS(*) INTO NAME c VALUE v) GROUP BY c)"


@q("column_set_diff", f"""WITH a AS {_columns_sql('SELECT * FROM prices')}, b AS {_columns_sql('SELECT entity, dt, price, volume, high AS close FROM prices')}
   SELECT coalesce(a.c, b.c) AS "column", CASE WHEN a.c IS NULL THEN 'added' WHEN b.c IS NULL THEN 'removed' ELSE 'common' END AS status, coalesce(a.n, b.n) AS non_null FROM a FULL JOIN b ON a.c = b.c""", "prices")
def _(spark, sf):
    p = prices(spark, sf)
    after = p.select("entity", "dt", "price", "volume", F.col("high").alias("close"))
    filled = profile.null_profile(p.withColumn("close", F.col("high")))
    n = profile.value_counts(p.select(F.lit(1).alias("k")), "k").select("n").scalar()
    return merge.column_set_diff(p, after).join(filled, "column").select("column", "status", (n - F.col("nulls")).alias("non_null"))


SUFFIXED = "(_x|_y|_fred|_market|_macro|_company|_dup|_fin)$"


@q("suffix_report", f"""WITH k AS {_columns_sql('SELECT p.entity, p.dt, p.price, m.gdp AS gdp_fred, m.oil AS price_macro FROM prices p LEFT JOIN macro m ON p.dt = m.dt')}
   SELECT regexp_replace(c, '{SUFFIXED}', '') AS base, c AS "column", regexp_replace(c, '{SUFFIXED}', '') IN (SELECT c FROM k) AS base_exists, n AS non_null FROM k WHERE regexp_matches(c, '{SUFFIXED}')""", "prices", "macro")
def _(spark, sf):
    context = macro(spark, sf).select("dt", F.col("gdp").alias("gdp_fred"), F.col("oil").alias("price"))
    merged = merge.add_context(prices(spark, sf).select("entity", "dt", "price"), context, "dt")
    filled = profile.null_profile(merged, ["price_macro", "gdp_fred"])
    n = merged.agg(F.count("*").alias("n")).scalar()
    return merge.suffix_report(merged).join(filled, "column").select("base", "column", "base_exists", (n - F.col("nulls")).alias("non_null"))


def _missing_sql(table: str, cols: list[str]) -> str:
    return " + ".join(f"sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)" for c in cols)


MACRO_COLS = ["dt", "gdp", "cpi", "unemp", "ffr", "spread", "oil", "conf", "ted"]
PRICE_COLS = ["entity", "entity_name", "grp", "dt", "price", "high", "low", "volume"]


@q("merge_report", " UNION ALL ".join(
    f"SELECT '{n}' AS pipeline, count(*) AS n_rows, CAST({len(c)} AS INTEGER) AS n_columns, {f32(f'({_missing_sql(t, c)}) * 100.0 / (count(*) * {len(c)})', 'missing_pct')}, "
    f"min(dt) AS date_min, max(dt) AS date_max FROM {t}" for n, t, c in (("macro", "macro", MACRO_COLS), ("merged", "prices", PRICE_COLS))), "macro", "prices")
def _(spark, sf):
    out = merge.merge_report({"macro": macro(spark, sf), "merged": prices(spark, sf)}, "dt")
    return show(out, "pipeline", "n_rows", "n_columns", "date_min", "date_max", missing_pct=-1)


# --- profiling ---------------------------------------------------------------------------------

def _stats_sql(table: str, cols: list[str], numeric: list[str], keys: str, name: str, extra: str = "") -> str:
    nulls = [f"sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)" for c in cols]
    total = " + ".join(nulls)
    dev = {c: f"CASE WHEN count(*) FILTER (abs({c}) = 'Infinity'::DOUBLE) = 0 THEN stddev_samp({c}) FILTER (abs({c}) <> 'Infinity'::DOUBLE) END" for c in numeric}
    means = ", ".join(f"avg({c})" for c in numeric)
    stds = ", ".join(dev[c] for c in numeric)
    return f"""SELECT '{name}' AS dataset, count(*) AS n_rows, CAST({len(cols)} AS INTEGER) AS n_cols, min(dt) AS date_min, max(dt) AS date_max,
      CAST(max(dt) - min(dt) AS BIGINT) AS date_range_days, CAST({total} AS BIGINT) AS total_missing,
      round(CAST({total} AS DOUBLE) / (count(*) * {len(cols)}) * 100, 2) AS missing_pct,
      CAST({' + '.join(f'CASE WHEN {x} > 0 THEN 1 ELSE 0 END' for x in nulls)} AS INTEGER) AS cols_with_missing,
      CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT {keys} FROM {table})) AS BIGINT) AS duplicates,
      CAST({len(numeric)} AS INTEGER) AS n_numeric_cols, CAST({len(cols) - len(numeric)} AS INTEGER) AS n_categorical_cols,
      round(list_avg([{means}]), 4) AS mean_value, round(list_avg([{stds}]), 4) AS std_value {extra} FROM {table}"""


RAW_COLS = [*PRICE_COLS, "_ord"]
RAW_NUM = ["entity", "price", "high", "low", "volume", "_ord"]


@q("dataset_stats", _stats_sql("raw_prices", RAW_COLS, RAW_NUM, "entity, dt", "prices"), "raw_prices")
def _(spark, sf):
    out = profile.dataset_stats(raw_prices(spark, sf), "prices", ENTITY.keys, "dt")
    return out.withColumns({c: F.round(c, 4) for c in ("mean_value", "std_value")})


@q("postmerge_stats", _stats_sql("spiked", ["entity", "grp", "dt", "volume", "price", "high", "low"], ["entity", "volume", "price", "high", "low"], "entity, dt", "spiked",
   ", CAST(count(*) FILTER (abs(price) = 'Infinity'::DOUBLE) + count(*) FILTER (abs(high) = 'Infinity'::DOUBLE) AS BIGINT) AS inf_values, "
   "count(*) FILTER (price < 0) AS invalid_negatives").replace("round(list_avg([avg(entity), avg(volume), avg(price), avg(high), avg(low)]), 4) AS mean_value", "0 AS mean_value"), "spiked")
def _(spark, sf):
    out = profile.dataset_stats(spiked(spark, sf), "spiked", ENTITY.keys, "dt", ["price", "volume"], post_merge=True)
    # the mean of a column holding +inf and -inf is not a number; the other figures are compared
    return out.drop("mean_value", "std_value")


REGISTRY.sql["postmerge_stats"] = REGISTRY.sql["postmerge_stats"].replace("SELECT 'spiked' AS dataset", "SELECT * EXCLUDE (mean_value, std_value) FROM (SELECT 'spiked' AS dataset") + ")"


@q("before_after_report", f"""
WITH a AS ({_stats_sql("raw_prices", RAW_COLS, RAW_NUM, "entity, dt", "prices")}),
d AS (SELECT * FROM raw_prices QUALIFY row_number() OVER (PARTITION BY entity, dt ORDER BY _ord DESC) = 1),
b AS ({_stats_sql("d", RAW_COLS, RAW_NUM, "entity, dt", "prices")}),
u AS (UNPIVOT (SELECT """ + ", ".join(f"CAST(a.{c} AS DOUBLE) AS {c}" for c in profile.COMPARED) + """ FROM a) ON COLUMNS(*) INTO NAME metric VALUE before),
v AS (UNPIVOT (SELECT """ + ", ".join(f"CAST(b.{c} AS DOUBLE) AS {c}" for c in profile.COMPARED) + """ FROM b) ON COLUMNS(*) INTO NAME metric VALUE "after")
SELECT u.metric, before, "after", round("after" - before, 4) AS change FROM u JOIN v ON u.metric = v.metric""", "raw_prices")
def _(spark, sf):
    raw = raw_prices(spark, sf)
    clean = dedupe.keep_last(raw, ENTITY.keys, ["_ord"])
    out = profile.before_after_report(*[profile.dataset_stats(d, "prices", ENTITY.keys, "dt") for d in (raw, clean)])
    return show(out, "metric", "before", "after", change=4)


def _profile_sql(table: str, cols: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls, (count(*) - count({c})) * 100.0::DOUBLE / count(*) AS p FROM {table}" for c in cols)


@q("null_profile", f"""SELECT "column", nulls, {f32('p', 'null_pct')}, CASE WHEN p > 50 THEN 'over 50' WHEN p > 20 THEN 'over 20' WHEN p > 5 THEN 'over 5' ELSE 'low' END AS level
   FROM ({_profile_sql('macro', MACRO_COLS)})""", "macro")
def _(spark, sf):
    return show(profile.null_profile(macro(spark, sf)), "column", "nulls", "level", null_pct=-1)


@q("null_by_source", f"""WITH j AS (SELECT p.price, p.volume, m.* EXCLUDE (dt) FROM prices p LEFT JOIN macro m ON p.dt = m.dt)
   SELECT CASE WHEN "column" IN ('price', 'volume') THEN 'company' ELSE 'macro' END AS source, count(*) AS n_columns, {f32('avg(p)', 'mean_null_pct')}
   FROM ({_profile_sql('j', ['price', 'volume', 'gdp', 'cpi', 'ffr', 'ted'])}) GROUP BY 1""", "prices", "macro")
def _(spark, sf):
    j = merge.add_context(prices(spark, sf).select("dt", "price", "volume"), macro(spark, sf), "dt")
    return show(profile.null_by_source(j, {"company": ["price", "volume"], "macro": ["gdp", "cpi", "ffr", "ted"]}), "source", "n_columns", mean_null_pct=-1)


@q("null_by_entity", f"""SELECT entity, count(*) AS n_rows, count(*) - count(price) AS missing_cells, {f32('(count(*) - count(price)) * 100.0 / (count(*) * 8)', 'missing_pct')},
   (count(*) - count(price)) * 100.0 / (count(*) * 8) > 1.8 AS above_limit FROM prices GROUP BY entity""", "prices")
def _(spark, sf):
    return show(profile.null_by_entity(prices(spark, sf), "entity", 1.8), "entity", "n_rows", "missing_cells", "above_limit", missing_pct=-1)


@q("key_availability", "SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count({c}) AS available, {f32(f'count({c}) * 100.0 / count(*)', 'available_pct')} FROM prices WHERE entity = 7" for c in ("price", "volume", "high")) + ")", "prices")
def _(spark, sf):
    return show(profile.key_availability(prices(spark, sf), "entity", 7, ["price", "volume", "high"]), "column", "available", available_pct=-1)


@q("describe_numeric", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, "
    + ", ".join(f32(f"quantile_cont({c}, {p})", n) for n, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))) + " FROM lineitem"
    for c in ("l_quantity", "l_extendedprice", "l_discount")) + ")")
def _(spark, sf):
    out = profile.describe_numeric(read_table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])
    return show(out, "column", "count", "min", "max", mean=4, std=4, q25=-1, q50=-1, q75=-1)


R1 = f"p AS (SELECT *, {PAD.format('price')} AS pad FROM prices), r AS (SELECT *, (pad / nullif(lag(pad, 1) OVER w, 0) - 1) * 100 AS r1 FROM p {W})"


@q("risk_return", f"""WITH {R1} SELECT entity, round(avg(r1), 4) AS mean_return, round(stddev_samp(r1), 4) AS volatility,
   round(CASE WHEN stddev_samp(r1) > 0 THEN avg(r1) / stddev_samp(r1) ELSE 0 END, 4) AS sharpe FROM r GROUP BY entity""", "prices")
def _(spark, sf):
    r = windows.pct_change(prices(spark, sf), ENTITY, {"r1": ("price", 1)})
    return show(profile.risk_return(r, "entity", "r1"), "entity", mean_return=4, volatility=4, sharpe=4)


CORR = ["gdp", "cpi", "unemp", "ffr", "spread", "oil", "ted", "idx"]
CTX = "j AS (SELECT macro.*, vix, idx FROM macro LEFT JOIN market ON macro.dt = market.dt)"


@q("corr_with_target", f"WITH {CTX} " + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", round(corr({c}, vix), 6) AS correlation FROM j" for c in CORR), "macro", "market")
def _(spark, sf):
    j = merge.add_context(macro(spark, sf), market(spark, sf), "dt")
    return show(profile.corr_with_target(j, "vix", CORR), "column", correlation=6)


@q("corr_matrix", f"WITH {CTX} " + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS correlation FROM j" for a in ("vix", "idx", "ted", "ffr") for b in ("vix", "idx", "ted", "ffr")), "macro", "market")
def _(spark, sf):
    j = merge.add_context(macro(spark, sf), market(spark, sf), "dt")
    return show(profile.corr_matrix(j, ["vix", "idx", "ted", "ffr"]), "a", "b", correlation=6)


@q("stress_periods", "SELECT * FROM (" + " UNION ALL ".join(f"""SELECT '{c}' AS "column", count(*) FILTER (vix > 30) AS stress_days,
   {f32('count(*) FILTER (vix > 30) * 100.0 / count(*)', 'stress_pct')}, min(dt) FILTER (vix > 30) AS first_day, max(dt) FILTER (vix > 30) AS last_day,
   round(avg({c}) FILTER (vix > 30), 4) AS stress_mean, round(avg({c}) FILTER (coalesce(vix <= 30, true)), 4) AS normal_mean,
   round(avg({c}) FILTER (vix > 30) - avg({c}) FILTER (coalesce(vix <= 30, true)), 4) AS difference FROM market""" for c in ("vix", "idx")) + ")", "market")
def _(spark, sf):
    out = profile.stress_periods(market(spark, sf), "dt", "vix", 30.0, ["vix", "idx"])
    return show(out, "column", "stress_days", "first_day", "last_day", stress_pct=-1, stress_mean=4, normal_mean=4, difference=4)


@q("value_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def _(spark, sf):
    return profile.value_counts(read_table(spark, sf, "events"), "event_type")


@q("distinct_report", "SELECT grp, count(DISTINCT entity) AS n_entity, count(DISTINCT dt) AS n_dt, array_to_string(list_sort(list(DISTINCT year(dt))), ',') AS years FROM prices GROUP BY grp", "prices")
def _(spark, sf):
    return profile.distinct_report(prices(spark, sf), "grp", ["entity", "dt"], "dt").withColumn("years", F.concat_ws(",", F.col("years").cast("array<string>")))


@q("grouped_quantiles", "SELECT entity, " + ", ".join(f32(f"quantile_cont(price, {p})", n) for n, p in (("price_q001", 0.001), ("price_q5", 0.5), ("price_q999", 0.999))) + " FROM prices GROUP BY entity", "prices")
def _(spark, sf):
    out = quantiles.grouped_quantiles(prices(spark, sf), ["entity"], ["price"], [0.001, 0.5, 0.999])
    return show(out, "entity", price_q001=-1, price_q5=-1, price_q999=-1)


@q("grouped_quantiles_large", "SELECT * FROM (" + " UNION ALL ".join(f"SELECT l_returnflag, '{c}' AS \"column\", {p}::DOUBLE AS p, count({c}) AS n, {f32(f'quantile_cont({c}, {p})', 'value')} FROM lineitem GROUP BY 1"
   for c in ("l_quantity", "l_extendedprice") for p in (0.001, 0.25, 0.5, 0.999)) + ")")
def _(spark, sf):
    out = quantiles.large_quantiles(read_table(spark, sf, "lineitem"), ["l_returnflag"], ["l_quantity", "l_extendedprice"], [0.001, 0.25, 0.5, 0.999])
    return show(out, "l_returnflag", "column", "p", "n", value=-1)


@q("run_metrics_summary", f"""SELECT step, count(*) AS total_runs, count(*) FILTER (success) * 100.0::DOUBLE / count(*) AS success_rate, round(avg(duration_s), 6) AS avg_duration,
   min(duration_s) AS min_duration, max(duration_s) AS max_duration, max(run_ts) AS last_run, arg_max(duration_s, (run_ts, event_id)) AS last_duration,
   arg_max(success, (run_ts, event_id)) AS last_success, count(*) FILTER (duration_s > 50) AS slow_runs FROM runs GROUP BY step""", "runs")
def _(spark, sf):
    out = profile.run_metrics_summary(runs(spark, sf), order=("run_ts", "event_id"), slow_seconds=50.0)
    return out.withColumn("avg_duration", F.round("avg_duration", 6))


@q("validation_metrics_summary", """SELECT step, CAST(run_ts AS DATE) AS day, count(*) AS total_expectations, count(*) FILTER (NOT success) AS failed_expectations,
   (count(*) - count(*) FILTER (NOT success)) * 100.0::DOUBLE / count(*) AS success_rate FROM runs GROUP BY 1, 2""", "runs")
def _(spark, sf):
    return profile.validation_metrics_summary(runs(spark, sf), "step", F.to_date("run_ts"), "success")


# --- hygiene -----------------------------------------------------------------------------------

@q("resolve_duplicate_columns", "SELECT p.entity, p.dt, p.price, m.gdp, m.ted, m.oil AS level FROM prices p LEFT JOIN macro m ON p.dt = m.dt", "prices", "macro")
def _(spark, sf):
    p = prices(spark, sf).select("entity", "dt", "price", F.col("high").alias("price_dup"), F.col("low").alias("price_x"))
    m = macro(spark, sf).select("dt", F.col("gdp").alias("gdp_fred"), F.col("ted").alias("ted_macro"), F.col("oil").alias("level_market"), F.col("conf").alias("level_y"))
    return hygiene.resolve_duplicate_columns(merge.add_context(p, m, "dt"))


@q("inf_to_null", "SELECT entity, dt, CASE WHEN abs(price) = 'Infinity'::DOUBLE THEN NULL ELSE price END AS price, CASE WHEN abs(high) = 'Infinity'::DOUBLE THEN NULL ELSE high END AS high FROM spiked", "spiked")
def _(spark, sf):
    return hygiene.inf_to_null(spiked(spark, sf)).select("entity", "dt", "price", "high")


@q("inf_counts", "SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) FILTER (abs({c}) = 'Infinity'::DOUBLE) AS inf_values FROM spiked" for c in ("price", "high", "low")) + ")", "spiked")
def _(spark, sf):
    return hygiene.inf_counts(spiked(spark, sf))


@q("winsorize_grouped", f"""WITH b AS (SELECT entity, """ + ", ".join(f"quantile_cont({c}, 0.001) AS lo_{c}, quantile_cont({c}, 0.999) AS hi_{c}, count({c}) AS n_{c}" for c in ("price", "volume")) + """ FROM prices GROUP BY entity)
   SELECT p.entity, dt, """ + ", ".join(f32(f"CASE WHEN n_{c} > 10 AND {c} < lo_{c} THEN lo_{c} WHEN n_{c} > 10 AND {c} > hi_{c} THEN hi_{c} ELSE {c} END", c) for c in ("price", "volume")) + " FROM prices p JOIN b ON p.entity = b.entity", "prices")
def _(spark, sf):
    return show(hygiene.winsorize(prices(spark, sf), ENTITY, ["price", "volume"]), "entity", "dt", price=-1, volume=-1)


@q("winsorize_global", f"""WITH b AS (SELECT """ + ", ".join(f"quantile_cont({c}, 0.001) AS lo_{c}, quantile_cont({c}, 0.999) AS hi_{c}" for c in ("l_extendedprice", "l_quantity")) + """ FROM lineitem)
   SELECT l_orderkey, l_linenumber, """ + ", ".join(f32(f"CASE WHEN {c} < lo_{c} THEN lo_{c} WHEN {c} > hi_{c} THEN hi_{c} ELSE {c} END", c) for c in ("l_extendedprice", "l_quantity")) + " FROM lineitem, b")
def _(spark, sf):
    li = read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")
    return show(hygiene.winsorize(li, DATED, ["l_extendedprice", "l_quantity"], large=True), "l_orderkey", "l_linenumber", l_extendedprice=-1, l_quantity=-1)


BACK = "first_value({0} IGNORE NULLS) OVER (PARTITION BY entity ORDER BY dt ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"


@q("fill_after_merge", "SELECT entity, dt, " + ", ".join(f"coalesce({PAD.format(c)}, {BACK.format(c)}) AS {c}" for c in ("equity", "long_debt", "short_debt")) + " FROM statements", "statements")
def _(spark, sf):
    return fill.fill_after_merge(statements(spark, sf).select("entity", "dt", "equity", "long_debt", "short_debt"), ENTITY)


@q("constant_columns", """SELECT c AS "column" FROM (UNPIVOT (SELECT coalesce(COLUMNS(*)::VARCHAR, '~null~') FROM (
   SELECT * EXCLUDE (entity, dt, grp), 5.0::DOUBLE AS fixed, CAST(NULL AS DOUBLE) AS empty, CASE WHEN volume % 2 = 0 THEN 1e-12 ELSE 0.0 END AS nearly FROM prices)) ON COLUMNS(*) INTO NAME c VALUE v)
   GROUP BY c HAVING count(DISTINCT v) <= 1 OR (count(DISTINCT v) = 2 AND stddev_samp(TRY_CAST(v AS DOUBLE)) < 1e-10)""", "prices")
def _(spark, sf):
    p = prices(spark, sf).withColumns({
        "fixed": F.lit(5.0), "empty": F.lit(None).cast("double"), "nearly": F.when(F.col("volume") % 2 == 0, 1e-12).otherwise(0.0)})
    found = hygiene.constant_columns(p, ["entity", "dt", "grp"])
    return spark.createDataFrame([(c,) for c in found], "column string")


@q("ratio_repair", f"""SELECT entity, dt, least(greatest((price - 1500) * 10, -1000), 1000) AS price_vs_ma, abs(least(greatest(price - 1500, -1000), 1000)) AS current_ratio, (price - 1500) * 10 AS level FROM prices WHERE price IS NOT NULL
   UNION ALL SELECT entity, dt, NULL, NULL, NULL FROM prices WHERE price IS NULL""", "prices")
def _(spark, sf):
    x = F.col("price") - 1500.0
    return hygiene.ratio_repair(prices(spark, sf).select("entity", "dt", (x * 10).alias("price_vs_ma"), x.alias("current_ratio"), (x * 10).alias("level")))


HYG_W = "OVER (PARTITION BY entity)"


@q("hygiene_sequence", f"""
WITH a AS (SELECT s.entity, s.dt, s._ord, CASE WHEN abs(s.price) = 'Infinity'::DOUBLE THEN NULL ELSE s.price END AS price, CAST(volume AS DOUBLE) AS volume, (low - 1500) * 10 AS price_pct, m.gdp FROM (
      SELECT *, 0 AS _ord FROM spiked UNION ALL SELECT *, 1 AS _ord FROM spiked WHERE day(dt) = 1) s LEFT JOIN macro m ON s.dt = m.dt),
w AS (SELECT entity, dt, _ord, """ + ", ".join(f"""CASE WHEN count({c}) {HYG_W} > 10 AND {c} < quantile_cont({c}, 0.001) {HYG_W} THEN quantile_cont({c}, 0.001) {HYG_W}
      WHEN count({c}) {HYG_W} > 10 AND {c} > quantile_cont({c}, 0.999) {HYG_W} THEN quantile_cont({c}, 0.999) {HYG_W} ELSE {c} END AS {c}""" for c in ("price", "volume", "price_pct", "gdp")) + """ FROM a),
f AS (SELECT entity, dt, _ord, """ + ", ".join(f"coalesce(last_value({c} IGNORE NULLS) OVER (PARTITION BY entity ORDER BY dt, _ord ROWS UNBOUNDED PRECEDING), first_value({c} IGNORE NULLS) OVER (PARTITION BY entity ORDER BY dt, _ord ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS {c}" for c in ("price", "volume", "price_pct", "gdp")) + f""" FROM w)
SELECT entity, dt, {f32('price', 'price')}, {f32('volume', 'volume')}, {f32('least(greatest(price_pct, -1000), 1000)', 'price_pct')}, {f32('gdp', 'gdp')},
  CAST(CAST(volume_text AS FLOAT) AS DOUBLE) AS volume_text FROM (SELECT f.*, CAST(v.volume AS DOUBLE) AS volume_text FROM f JOIN prices v ON f.entity = v.entity AND f.dt = v.dt WHERE _ord = 0)""", "spiked", "macro")
def _(spark, sf):
    s = spiked(spark, sf).withColumns({
        "price_pct": (F.col("low") - 1500) * 10, "fixed": F.lit(1.0), "price_dup": F.col("low"), "volume_text": F.col("volume").cast("string")})
    s = s.withColumn("_ord", F.lit(0)).unionByName(s.filter(F.day("dt") == 1).withColumn("_ord", F.lit(1)))
    merged = merge.add_context(s.drop("high", "low", "grp"), macro(spark, sf).select("dt", F.col("gdp").alias("gdp_macro")), "dt")
    out = repair_merged(merged, Panel(("entity",), "dt", ("_ord",)), cut_lineage=True)
    return show(out, "entity", "dt", price=-1, volume=-1, price_pct=-1, gdp=-1, volume_text=-1)
