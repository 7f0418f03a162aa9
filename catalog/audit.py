"""Outliers, rules, jumps, slices, bias and drift."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import REGISTRY
from catalog.features import PAD, W, f32
from catalog.merging import CTX, R1
from catalog.views import DATED, ENTITY, macro, market, prices, read_table, runs, show, statements
from pitpanel.functions.columns import ratio
from pitpanel.operators import drift, merge, outliers, slices, windows

q = REGISTRY.add


def _bounds(cols, table="prices", by="entity"):
    return (f"SELECT {by}, count(*) AS n, " + ", ".join(
        f"count({c}) AS n_{c}, quantile_cont({c}, 0.25) - 3 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS lo_{c}, "
        f"quantile_cont({c}, 0.75) + 3 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS hi_{c}" for c in cols)
        + f" FROM {table} GROUP BY {by}")


def _narrow(spark, sf):
    """Prices with a heavier tail, so that three quartile distances are exceeded."""
    p = prices(spark, sf)
    return p.select("entity", "grp", "dt", "price", (F.col("volume") * F.col("volume")).cast("double").alias("turnover"))


NARROW = "n AS (SELECT entity, grp, dt, price, CAST(volume * volume AS DOUBLE) AS turnover FROM prices)"


@q("iqr_outliers", f"""WITH {NARROW}, b AS ({_bounds(['price', 'turnover'], 'n')})
   SELECT n.entity, dt, CASE WHEN price < lo_price OR price > hi_price THEN 1 ELSE 0 END AS price_outlier_flag,
          CASE WHEN turnover < lo_turnover OR turnover > hi_turnover THEN 1 ELSE 0 END AS turnover_outlier_flag FROM n JOIN b ON n.entity = b.entity""", "prices")
def _(spark, sf):
    out = outliers.iqr_flags(_narrow(spark, sf), ENTITY, ["price", "turnover"])
    return out.select("entity", "dt", "price_outlier_flag", "turnover_outlier_flag")


REPORT_SQL = f"""WITH {NARROW}, b AS ({_bounds(['price', 'turnover'], 'n')}),
   h AS (SELECT n.entity, dt, 'price' AS "column", price AS v, b.n AS size, n_price AS valid FROM n JOIN b ON n.entity = b.entity WHERE price < lo_price OR price > hi_price
         UNION ALL SELECT n.entity, dt, 'turnover', turnover, b.n, n_turnover FROM n JOIN b ON n.entity = b.entity WHERE turnover < lo_turnover OR turnover > hi_turnover)
   SELECT entity, "column", count(*) AS n_outliers, round(min(v), 2) AS min_outlier, round(max(v), 2) AS max_outlier,
          array_to_string(list_sort(list(DISTINCT year(dt))), ',') AS outlier_years, round(CAST(count(*) AS DOUBLE) / max({{}}) * 100, 2) AS pct FROM h GROUP BY 1, 2"""


@q("outlier_report", REPORT_SQL.format("size"), "prices")
def _(spark, sf):
    out = outliers.outlier_report(_narrow(spark, sf), ENTITY, ["price", "turnover"])
    return out.withColumn("outlier_years", F.concat_ws(",", F.col("outlier_years").cast("array<string>")))


@q("outlier_report_global", f"""WITH b AS (SELECT 1 AS k, quantile_cont(l_extendedprice / l_quantity, 0.25) AS a, quantile_cont(l_extendedprice / l_quantity, 0.75) AS z FROM lineitem),
   h AS (SELECT l_shipdate, l_extendedprice / l_quantity AS v FROM lineitem, b WHERE l_extendedprice / l_quantity < a - 1.5 * (z - a) OR l_extendedprice / l_quantity > z + 1.5 * (z - a))
   SELECT 'unit' AS "column", count(*) AS n_outliers, round(min(v), 2) AS min_outlier, round(max(v), 2) AS max_outlier, array_to_string(list_sort(list(DISTINCT year(l_shipdate))), ',') AS outlier_years,
   round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM lineitem) * 100, 2) AS pct FROM h HAVING count(*) > 0""")
def _(spark, sf):
    li = read_table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("dt"), (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit"))
    out = outliers.outlier_report(li, DATED, ["unit"], factor=1.5, large=True)
    return out.withColumn("outlier_years", F.concat_ws(",", F.col("outlier_years").cast("array<string>")))


@q("anomaly_iqr_flags", REPORT_SQL.format("valid"), "prices")
def _(spark, sf):
    out = outliers.outlier_report(_narrow(spark, sf), ENTITY, ["price", "turnover"], min_valid=10, share_of="valid")
    return out.withColumn("outlier_years", F.concat_ws(",", F.col("outlier_years").cast("array<string>")))


STMT = """st AS (SELECT entity, dt, net_income / nullif(revenue, 0) * 100 AS profit_margin, net_income / nullif(equity, 0) * 100 AS roe,
   (coalesce(long_debt, 0) + coalesce(short_debt, 0)) / nullif(equity, 0) AS debt_to_equity, equity - assets * 0.45 AS total_assets,
   (revenue / nullif(lag(revenue) OVER (PARTITION BY entity ORDER BY dt), 0) - 1) * 100 AS gdp_growth_90d FROM statements)"""


def _ruled(spark, sf):
    st = statements(spark, sf)
    st = windows.pct_change(st, ENTITY, {"gdp_growth_90d": ("revenue", 1)})
    debt = F.coalesce("long_debt", F.lit(0.0)) + F.coalesce("short_debt", F.lit(0.0))
    return st.select(
        "entity", "dt", ratio(F.col("net_income"), F.col("revenue"), 100.0).alias("profit_margin"),
        ratio(F.col("net_income"), F.col("equity"), 100.0).alias("roe"), ratio(debt, F.col("equity")).alias("debt_to_equity"),
        (F.col("equity") - F.col("assets") * 0.45).alias("total_assets"), "gdp_growth_90d")


RULES_SQL = [("profit_margin", "profit_margin < -100 OR profit_margin > 100", "profit_margin_extreme_flag", "HIGH"), ("roe", "roe < -200 OR roe > 200", "roe_extreme_flag", "HIGH"),
             ("debt_to_equity", "debt_to_equity < 0 OR debt_to_equity > 100", "debt_to_equity_extreme_flag", "HIGH"), ("total_assets", "total_assets < 0", "total_assets_negative_flag", "CRITICAL"),
             ("gdp_growth_90d", "abs(gdp_growth_90d) > 20", "gdp_growth_extreme_flag", "CRITICAL")]


@q("anomaly_rule_flags", f"WITH {STMT} SELECT entity, dt, " + ", ".join(f"CASE WHEN {c} THEN 1 ELSE 0 END AS {f}" for _, c, f, _ in RULES_SQL) + " FROM st", "statements")
def _(spark, sf):
    return outliers.rule_flags(_ruled(spark, sf)).select("entity", "dt", *[f for _, _, f, _ in RULES_SQL])


RULE_COUNTS = " UNION ALL ".join(f"SELECT '{col}' AS \"column\", count(*) AS count, '{s}' AS severity FROM st WHERE {c}" for col, c, _, s in RULES_SQL)


@q("rule_violations", f"WITH {STMT} SELECT * FROM ({RULE_COUNTS}) WHERE count > 0", "statements")
def _(spark, sf):
    return outliers.rule_report(_ruled(spark, sf)).select("column", "count", "severity")


JUMPS = f"""pp AS (SELECT *, {PAD.format('price')} AS pad, count(*) OVER (PARTITION BY entity) AS n FROM prices),
   jj AS (SELECT entity, dt, CASE WHEN n >= 10 AND abs((pad / nullif(lag(pad) OVER w, 0) - 1) * 100) > 50 THEN 1 ELSE 0 END AS price_jump_flag FROM pp {W})"""


@q("anomaly_jump_flags", f"WITH {JUMPS} SELECT * FROM jj", "prices")
def _(spark, sf):
    return outliers.jump_flags(prices(spark, sf), ENTITY, ["price"]).select("entity", "dt", "price_jump_flag")


JUMP_SEVERITY = """SELECT entity, 'price' AS "column", count(*) AS count, array_to_string(list_sort(list(DISTINCT year(dt))), ',') AS years, bool_or(year(dt) IN (1996, 2001)) AS is_crisis,
   CASE WHEN bool_or(year(dt) IN (1996, 2001)) THEN 'LOW' ELSE 'HIGH' END AS severity FROM jj WHERE price_jump_flag = 1 GROUP BY entity"""


def _jumps(spark, sf):
    flagged = outliers.jump_flags(prices(spark, sf), ENTITY, ["price"])
    return outliers.jump_severity(flagged, ENTITY, ["price"], crisis_years=(1996, 2001))


@q("jump_severity", f"WITH {JUMPS} {JUMP_SEVERITY}", "prices")
def _(spark, sf):
    return _jumps(spark, sf).withColumn("years", F.concat_ws(",", F.col("years").cast("array<string>")))


@q("anomaly_summary", f"""WITH {JUMPS}, {STMT}, o AS ({REPORT_SQL.format('valid')}), r AS (SELECT * FROM ({RULE_COUNTS}) WHERE count > 0), j AS ({JUMP_SEVERITY})
   SELECT CAST(coalesce((SELECT sum(n_outliers) FROM o), 0) + coalesce((SELECT sum(count) FROM r), 0) AS BIGINT) AS total_count,
   CAST(coalesce((SELECT sum(count) FROM r WHERE severity = 'CRITICAL'), 0) + coalesce((SELECT sum(count) FROM j WHERE NOT is_crisis), 0) AS BIGINT) AS critical_count,
   (SELECT count(DISTINCT "column") FROM o) AS outlier_columns, (SELECT count(*) FROM r) AS broken_rules, CAST(coalesce((SELECT sum(count) FROM j), 0) AS BIGINT) AS jumps""", "prices", "statements")
def _(spark, sf):
    found = outliers.outlier_report(_narrow(spark, sf), ENTITY, ["price", "turnover"], min_valid=10, share_of="valid")
    return outliers.anomaly_summary(found, outliers.rule_report(_ruled(spark, sf)), _jumps(spark, sf))


# --- slices ------------------------------------------------------------------------------------

def _returns(spark, sf):
    return windows.pct_change(prices(spark, sf), ENTITY, {"r1": ("price", 1)}).select("entity", "grp", "dt", "price", "volume", "r1")


def _slice_sql(key: str, table: str = "r") -> str:
    return (f"{key}, count(*) AS n_samples, round((count(*) * 2 - count(price) - count(r1)) * 100.0::DOUBLE / (count(*) * 6), 2) AS missing_pct, "
            "CAST(max(dt) - min(dt) AS BIGINT) AS date_range_days, round(avg(r1), 4) AS return_mean, round(stddev_samp(r1), 4) AS return_std")


@q("slice_metrics", f"""WITH {R1} SELECT {_slice_sql("'grp' AS dimension, grp AS slice")}, {f32('avg(volume)', 'level_mean')} FROM r GROUP BY grp
   UNION ALL SELECT {_slice_sql("'entity', CAST(entity AS VARCHAR)")}, {f32('avg(volume)', 'level_mean')} FROM r GROUP BY entity""", "prices")
def _(spark, sf):
    out = slices.slice_metrics(_returns(spark, sf), ["grp", "entity"], "dt", "r1", "volume")
    return show(out, *[c for c in out.columns if c != "level_mean"], level_mean=-1)


PERIODS = {"early": (1995, 1996), "middle": (1997, 1998), "late": (1999, 2000), "last": (2001, 2001), "overlap": (1998, 2000)}
TEMPORAL = " UNION ALL ".join(f"SELECT {_slice_sql(chr(39) + p + chr(39) + ' AS period')} FROM r WHERE year(dt) BETWEEN {a} AND {b} HAVING count(*) > 0" for p, (a, b) in PERIODS.items())


@q("temporal_slices", f"WITH {R1} {TEMPORAL}", "prices")
def _(spark, sf):
    return slices.temporal_slices(_returns(spark, sf), "dt", PERIODS, "r1")


@q("regime_slices", f"""WITH {R1}, j AS (SELECT r.*, vix FROM r LEFT JOIN market ON r.dt = market.dt)
   SELECT CASE WHEN vix > 0 AND vix <= 15 THEN 'Low' WHEN vix > 15 AND vix <= 25 THEN 'Medium' WHEN vix > 25 AND vix <= 100 THEN 'High' END AS regime, count(*) AS n_samples,
   round((count(*) * 3 - count(price) - count(r1) - count(vix)) * 100.0::DOUBLE / (count(*) * 7), 2) AS missing_pct, CAST(max(dt) - min(dt) AS BIGINT) AS date_range_days,
   round(avg(r1), 4) AS return_mean, round(stddev_samp(r1), 4) AS return_std FROM j GROUP BY 1""", "prices", "market")
def _(spark, sf):
    j = merge.add_context(_returns(spark, sf), market(spark, sf).select("dt", "vix"), "dt")
    return slices.regime_slices(j, "dt", "vix", "regime", "r1")


KS_P = """CASE WHEN lam < 0.2 THEN 1.0::DOUBLE ELSE greatest(0.0::DOUBLE, least(1.0::DOUBLE,
   2 * list_sum(list_transform(generate_series(1, 100), lambda k: (CASE WHEN k % 2 = 1 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END) * exp(-2.0::DOUBLE * k * k * lam * lam))))) END"""
GROUPS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
LAM = "(sqrt(CAST(n1 AS DOUBLE) * n2 / (n1 + n2)) + 0.12 + 0.11 / sqrt(CAST(n1 AS DOUBLE) * n2 / (n1 + n2))) * d"


@q("slice_ks_pairs", f"""
WITH v AS (SELECT grp, price AS x FROM prices WHERE price IS NOT NULL), g AS (SELECT grp, count(*) AS n, avg(x) AS m FROM v GROUP BY grp),
c AS (SELECT a.grp AS s1, b.grp AS s2, a.n AS n1, b.n AS n2, a.m - b.m AS mean_diff FROM g a JOIN g b ON a.grp < b.grp),
k AS (SELECT s1, s2, n1, n2, mean_diff, x, sum(CASE WHEN v.grp = s1 THEN 1 ELSE 0 END) AS c1, sum(CASE WHEN v.grp = s2 THEN 1 ELSE 0 END) AS c2 FROM c JOIN v ON v.grp = s1 OR v.grp = s2 GROUP BY ALL),
t AS (SELECT *, sum(c1) OVER w AS t1, sum(c2) OVER w AS t2 FROM k WINDOW w AS (PARTITION BY s1, s2 ORDER BY x)),
d AS (SELECT s1, s2, n1, n2, mean_diff, max(abs(CAST(t1 AS DOUBLE) / n1 - CAST(t2 AS DOUBLE) / n2)) AS d FROM t GROUP BY ALL),
l AS (SELECT *, {LAM} AS lam FROM d)
SELECT 'price' AS feature, s1 AS slice1, s2 AS slice2, round(d, 10) AS ks_statistic, n1, n2, round(mean_diff, 4) AS mean_diff, round({KS_P}, 8) AS p_value
FROM l WHERE n1 >= 30 AND n2 >= 30 AND {KS_P} < 0.5""", "prices")
def _(spark, sf):
    out = slices.slice_ks_pairs(prices(spark, sf), "grp", GROUPS, "price", alpha=0.5)
    return show(out, "feature", "slice1", "slice2", "n1", "n2", ks_statistic=10, mean_diff=4, p_value=8)


REPR = "SELECT s_nationkey, count(*) AS n_samples, CAST(count(*) AS DOUBLE) / (SELECT avg(n) FROM (SELECT count(*) AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY s_nationkey)) - 1 AS dev FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY s_nationkey"


@q("representation_bias", f"SELECT s_nationkey, n_samples, {f32('dev', 'deviation')}, CASE WHEN dev < -0.3 THEN 'under' WHEN dev > 0.3 THEN 'over' ELSE 'balanced' END AS status FROM ({REPR})")
def _(spark, sf):
    li = read_table(spark, sf, "lineitem").select("l_suppkey").join(read_table(spark, sf, "supplier").select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    return show(slices.representation_bias(li, "s_nationkey"), "s_nationkey", "n_samples", "status", deviation=-1)


@q("imbalance_ratio", f"SELECT max(n) AS max_samples, min(n) AS min_samples, {f32('CAST(max(n) AS DOUBLE) / min(n)', 'imbalance_ratio')}, CAST(max(n) AS DOUBLE) / min(n) > 5 AS imbalanced FROM (SELECT count(*) AS n FROM prices GROUP BY grp)", "prices")
def _(spark, sf):
    return show(slices.imbalance_ratio(prices(spark, sf), "grp"), "max_samples", "min_samples", "imbalanced", imbalance_ratio=-1)


@q("temporal_quality_bias", f"WITH {R1} SELECT 'Temporal Quality Bias' AS type, period, 'MEDIUM' AS severity, missing_pct FROM ({TEMPORAL}) WHERE missing_pct > 2.3", "prices")
def _(spark, sf):
    return slices.temporal_quality_bias(slices.temporal_slices(_returns(spark, sf), "dt", PERIODS, "r1"), 2.3)


@q("sample_weights", "SELECT event_id, event_type, 1.0::DOUBLE / count(*) OVER (PARTITION BY event_type) AS weight FROM events")
def _(spark, sf):
    return slices.sample_weights(read_table(spark, sf, "events").select("event_id", "event_type"), "event_type")


@q("bias_report", f"""WITH {R1}, t AS (SELECT 'Representation Bias' AS type, 'HIGH' AS severity, (SELECT count(*) FROM (SELECT entity, count(*) AS n FROM prices GROUP BY 1) WHERE abs(n / (SELECT avg(n) FROM (SELECT count(*) AS n FROM prices GROUP BY entity)) - 1) > 0.01) AS n
   UNION ALL SELECT 'Sector Imbalance', 'MEDIUM', (SELECT CASE WHEN CAST(max(n) AS DOUBLE) / min(n) > 5 THEN 1 ELSE 0 END FROM (SELECT count(*) AS n FROM prices GROUP BY grp))
   UNION ALL SELECT 'Temporal Quality Bias', 'MEDIUM', (SELECT count(*) FROM ({TEMPORAL}) WHERE missing_pct > 2.3))
   SELECT type, severity, CAST(n AS BIGINT) AS n FROM t WHERE n > 0 UNION ALL SELECT 'none', 'INFO', 0 WHERE (SELECT sum(n) FROM t) = 0""", "prices")
def _(spark, sf):
    p = prices(spark, sf)
    temporal = slices.temporal_quality_bias(slices.temporal_slices(_returns(spark, sf), "dt", PERIODS, "r1"), 2.3)
    return slices.bias_report(slices.representation_bias(p, "entity", 0.01), slices.imbalance_ratio(p, "grp"), temporal).drop("advice")


# --- drift -------------------------------------------------------------------------------------

FEATURES = {"l_quantity": "l_quantity", "l_extendedprice": "l_extendedprice", "late": "CASE WHEN l_orderkey % 3 = 0 THEN NULL WHEN l_shipdate >= DATE '2000-01-01' THEN l_quantity * 1.7 ELSE l_quantity END", "l_tax": "l_tax"}
REFERENCE, CURRENT = (1995, 1996), (2000, 2001)
DRIFT_LONG = "all_x AS (" + " UNION ALL ".join(f"SELECT '{n}' AS feature, {e} AS v, year(l_shipdate) BETWEEN 1995 AND 1996 AS ref FROM lineitem WHERE year(l_shipdate) BETWEEN 1995 AND 1996 OR year(l_shipdate) BETWEEN 2000 AND 2001" for n, e in FEATURES.items()) + "), x AS (SELECT * FROM all_x WHERE v IS NOT NULL)"
KS_SQL = f"""{DRIFT_LONG}, n AS (SELECT feature, count(*) FILTER (ref) AS n1, count(*) FILTER (NOT ref) AS n2 FROM x GROUP BY 1),
   c AS (SELECT feature, v, count(*) FILTER (ref) AS c1, count(*) FILTER (NOT ref) AS c2 FROM x GROUP BY 1, 2),
   t AS (SELECT feature, sum(c1) OVER w AS t1, sum(c2) OVER w AS t2 FROM c WINDOW w AS (PARTITION BY feature ORDER BY v)),
   d AS (SELECT t.feature, n1, n2, max(abs(CAST(t1 AS DOUBLE) / n1 - CAST(t2 AS DOUBLE) / n2)) AS d FROM t JOIN n ON t.feature = n.feature GROUP BY 1, 2, 3),
   l AS (SELECT *, {LAM} AS lam FROM d), ks AS (SELECT feature, n1, n2, d, {KS_P} AS p FROM l),
   m AS (SELECT feature, avg(v) FILTER (ref) AS mr, avg(v) FILTER (NOT ref) AS mc, stddev_samp(v) FILTER (ref) AS sr, stddev_samp(v) FILTER (NOT ref) AS sc FROM x GROUP BY 1)"""


def _features(spark, sf):
    li = read_table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("dt"), "l_quantity", "l_extendedprice", "l_tax",
                     F.when(F.col("l_orderkey") % 3 == 0, None).when(F.col("l_shipdate") >= "2000-01-01", F.col("l_quantity") * 1.7)
                     .otherwise(F.col("l_quantity")).alias("late"))


@q("ks_statistic", f"WITH {KS_SQL} SELECT feature, n1 AS n_reference, n2 AS n_current, round(d, 10) AS ks_statistic, round(p, 8) AS p_value FROM ks")
def _(spark, sf):
    out = drift.ks_statistic(_features(spark, sf), "dt", list(FEATURES), REFERENCE, CURRENT)
    return show(out, "feature", "n_reference", "n_current", ks_statistic=10, p_value=8)


CHANGES = "round((mc - mr) / (abs(mr) + 1e-6) * 100, 4) AS mean_change_pct, round((sc - sr) / (abs(sr) + 1e-6) * 100, 4) AS std_change_pct"


@q("drift_moments", f"WITH {KS_SQL} SELECT feature, round(mr, 4) AS mean_reference, round(mc, 4) AS mean_current, {CHANGES} FROM m")
def _(spark, sf):
    out = drift.drift_moments(_features(spark, sf), "dt", list(FEATURES), REFERENCE, CURRENT)
    return show(out, "feature", mean_reference=4, mean_current=4, mean_change_pct=4, std_change_pct=4)


SEVERITY = "CASE WHEN p < 0.01 AND abs((mc - mr) / (abs(mr) + 1e-6) * 100) > 50 THEN 'HIGH' WHEN p < 0.01 THEN 'MEDIUM' WHEN p < 0.05 THEN 'LOW' ELSE 'STABLE' END"


@q("drift_report", f"WITH {KS_SQL} SELECT ks.feature, round(d, 10) AS ks_statistic, round(p, 8) AS p_value, {CHANGES}, {SEVERITY} AS severity FROM ks JOIN m ON ks.feature = m.feature")
def _(spark, sf):
    out = drift.drift_report(_features(spark, sf), "dt", list(FEATURES), REFERENCE, CURRENT)
    return show(out, "feature", "severity", ks_statistic=10, p_value=8, mean_change_pct=4, std_change_pct=4)


@q("drift_flag", f"""WITH {KS_SQL} SELECT l_orderkey, l_linenumber, CASE WHEN EXISTS (SELECT 1 FROM ks WHERE feature <> 'late' AND p < 0.01) THEN 1
   WHEN EXISTS (SELECT 1 FROM ks WHERE feature = 'late' AND p < 0.01) AND l_orderkey % 3 <> 0 THEN 1 ELSE 0 END AS feature_drift_flag FROM lineitem""")
def _(spark, sf):
    rows = _features(spark, sf)
    report = drift.drift_report(rows, "dt", list(FEATURES), REFERENCE, CURRENT)
    return drift.drift_flag(rows, report).select("l_orderkey", "l_linenumber", "feature_drift_flag")


@q("drift_recommendations", f"""WITH {KS_SQL}, s AS (SELECT {SEVERITY} AS severity FROM ks JOIN m ON ks.feature = m.feature),
   sc AS (SELECT count(*) FILTER (severity = 'HIGH') AS high, count(*) FILTER (severity = 'MEDIUM') AS medium, count(*) FILTER (severity = 'LOW') AS low FROM s)
   SELECT *, 'no drift to mitigate' AS advice FROM sc WHERE high + medium + low = 0 UNION ALL SELECT *, 'normalise the high-drift features by period' FROM sc WHERE high > 0
   UNION ALL SELECT *, 'validate on later periods, not on random splits' FROM sc WHERE medium > 0 UNION ALL SELECT *, 'monitor drift in production' FROM sc WHERE high + medium + low > 0""")
def _(spark, sf):
    return drift.drift_recommendations(drift.drift_report(_features(spark, sf), "dt", list(FEATURES), REFERENCE, CURRENT))


@q("run_drift", f"""WITH d AS (SELECT step, CAST(run_ts AS DATE) AS day, count(*) AS n_rows, count(*) FILTER (NOT success) * 100.0::DOUBLE / count(*) AS missing_pct FROM runs GROUP BY 1, 2),
   l AS (SELECT *, lag(n_rows) OVER w AS pn, lag(missing_pct) OVER w AS pm FROM d WINDOW w AS (PARTITION BY step ORDER BY day))
   SELECT step, day, n_rows, missing_pct, {f32('CAST(n_rows - pn AS DOUBLE) / nullif(pn, 0)', 'row_change')}, coalesce(abs(CAST(n_rows - pn AS DOUBLE) / nullif(pn, 0)) > 0.2, false) AS row_drift,
   coalesce(missing_pct > pm * 1.2::DOUBLE, false) AS missing_drift FROM l""", "runs")
def _(spark, sf):
    daily = runs(spark, sf).groupBy("step", F.to_date("run_ts").alias("day")).agg(
        F.count("*").alias("n_rows"), (F.count(F.when(~F.col("success"), 1)) * 100.0 / F.count("*")).alias("missing_pct"))
    return show(drift.run_drift(daily, "day", by=["step"]), "step", "day", "n_rows", "missing_pct", "row_drift", "missing_drift", row_change=-1)
