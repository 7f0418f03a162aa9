"""Nulls, fills, de-duplication, reporting lag, as-of expansion, clean pipelines."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import REGISTRY
from catalog.views import DATED, ENTITY, macro, market, prices, raw_prices, read_table, runs, show, statements
from pitpanel import Panel
from pitpanel.operators import blocks, dedupe, fill, windows
from pitpanel.operators.joins import join_calendar
from pitpanel.plans import clean

q = REGISTRY.add

FILL = "last_value({0} IGNORE NULLS) OVER (PARTITION BY entity ORDER BY dt ROWS UNBOUNDED PRECEDING)"
FILL_D = "last_value({0} IGNORE NULLS) OVER (ORDER BY dt ROWS UNBOUNDED PRECEDING)"
BACK_D = "first_value({0} IGNORE NULLS) OVER (ORDER BY dt ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
MACRO = ["gdp", "cpi", "unemp", "ffr", "spread", "oil", "conf", "ted"]


@q("flagship_returns_with_market", f"""
WITH d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY entity, dt ORDER BY _ord DESC) AS rn
                          FROM raw_prices) WHERE rn = 1),
f AS (SELECT entity, grp, dt, volume, {FILL.format("price")} AS price FROM d),
r AS (SELECT *, (price / nullif(lag(price, 1) OVER w, 0) - 1) * 100 AS return_1d,
             (price / nullif(lag(price, 22) OVER w, 0) - 1) * 100 AS return_22d,
             avg(price) OVER (w ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS ma20
      FROM f WINDOW w AS (PARTITION BY entity ORDER BY dt)),
v AS (SELECT *, stddev_samp(return_1d) OVER (PARTITION BY entity ORDER BY dt
              ROWS BETWEEN 21 PRECEDING AND CURRENT ROW) * sqrt(252) AS volatility_22d FROM r)
SELECT entity, grp, v.dt, volume, CAST(CAST(price AS FLOAT) AS DOUBLE) AS price,
       CAST(CAST(return_1d AS FLOAT) AS DOUBLE) AS return_1d,
       CAST(CAST(return_22d AS FLOAT) AS DOUBLE) AS return_22d,
       CAST(CAST(ma20 AS FLOAT) AS DOUBLE) AS ma20, round(volatility_22d, 4) AS volatility_22d,
       CAST(CAST(vix AS FLOAT) AS DOUBLE) AS vix, CAST(CAST(idx AS FLOAT) AS DOUBLE) AS idx
FROM v LEFT JOIN market ON v.dt = market.dt
""", "raw_prices", "market")
def _(spark, sf):
    daily = dedupe.keep_last(raw_prices(spark, sf), ENTITY.keys, ["_ord"])
    out = fill.forward_fill(daily, ENTITY, ["price"])
    out = windows.pct_change(out, ENTITY, {"return_1d": ("price", 1), "return_22d": ("price", 22)})
    out = windows.moving_average(out, ENTITY, {"ma20": ("price", 20)})
    out = windows.annualized_volatility(out, ENTITY, {"volatility_22d": ("return_1d", 22)})
    out = join_calendar(out, market(spark, sf), "dt")
    return show(out, "entity", "grp", "dt", "volume", price=-1, return_1d=-1, return_22d=-1, ma20=-1,
                volatility_22d=4, vix=-1, idx=-1)


@q("reporting_lag", "SELECT entity, CAST(dt + INTERVAL 45 DAY AS DATE) AS dt, revenue, equity FROM statements", "statements")
def _(spark, sf):
    return fill.reporting_lag(statements(spark, sf), "dt", 45).select("entity", "dt", "revenue", "equity")


@q("reporting_lag_per_series", """
SELECT CAST(dt + INTERVAL 1 DAY * CASE series WHEN 'gdp' THEN 45 WHEN 'cpi' THEN 15 ELSE 0 END AS DATE) AS dt,
       series, value FROM (SELECT dt, 'gdp' AS series, gdp AS value FROM macro UNION ALL
                           SELECT dt, 'cpi', cpi FROM macro UNION ALL SELECT dt, 'oil', oil FROM macro)
WHERE value IS NOT NULL""", "macro")
def _(spark, sf):
    long = macro(spark, sf).unpivot(["dt"], ["gdp", "cpi", "oil"], "series", "value").dropna(subset=["value"])
    return fill.reporting_lag(long, "dt", {"gdp": 45, "cpi": 15}, "series")


@q("ffill_grouped", f"SELECT entity, dt, {FILL.format('price')} AS price, volume FROM prices", "prices")
def _(spark, sf):
    return fill.forward_fill(prices(spark, sf), ENTITY, ["price"]).select("entity", "dt", "price", "volume")


@q("ffill_grouped_blocked", """
SELECT event_id, event_type, ts,
       last_value(v IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS v
FROM (SELECT *, CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS v FROM events)""")
def _(spark, sf):
    ev = read_table(spark, sf, "events").withColumn("v", F.when(F.col("event_id") % 3 != 0, F.col("value")))
    by_type = Panel(("event_type",), "ts", ("event_id",))
    return fill.forward_fill(ev, by_type, ["v"], blocked=True).select("event_id", "event_type", "ts", "v")


@q("ffill_global", "SELECT dt, " + ", ".join(f"{FILL_D.format(c)} AS {c}" for c in MACRO) + " FROM macro", "macro")
def _(spark, sf):
    return fill.forward_fill(macro(spark, sf), DATED, MACRO)


@q("ffill_global_blocked", "SELECT dt, " + ", ".join(f"{FILL_D.format(c)} AS {c}" for c in MACRO) + " FROM macro", "macro")
def _(spark, sf):
    return fill.forward_fill(macro(spark, sf), DATED, MACRO, blocked=True)


LEAD_MEDIAN = """
WITH f AS (SELECT *, last_value(price IGNORE NULLS) OVER w AS ff FROM {0} WINDOW w AS (PARTITION BY entity ORDER BY {1} ROWS UNBOUNDED PRECEDING)),
k AS (SELECT *, count(ff) OVER (PARTITION BY entity ORDER BY {1} ROWS UNBOUNDED PRECEDING) AS k FROM f),
m AS (SELECT entity, quantile_cont(CASE WHEN k <= 10 THEN ff END, 0.5) AS m FROM k GROUP BY entity)
SELECT k.entity, dt, {2} CAST(CAST(coalesce(ff, m) AS FLOAT) AS DOUBLE) AS price FROM k JOIN m ON k.entity = m.entity"""


@q("leading_median_fill", LEAD_MEDIAN.format("prices", "dt", ""), "prices")
def _(spark, sf):
    return show(fill.fill_no_lookahead(prices(spark, sf), ENTITY, ["price"]), "entity", "dt", price=-1)


@q("leading_median_fill_blocked", LEAD_MEDIAN.format("raw_prices", "dt, _ord", "_ord,"), "raw_prices")
def _(spark, sf):
    panel = Panel(("entity",), "dt", ("_ord",))
    return show(fill.fill_no_lookahead(raw_prices(spark, sf), panel, ["price"], blocked=True),
                "entity", "dt", "_ord", price=-1)


@q("ffill_bfill", "SELECT dt, " + ", ".join(f"coalesce({FILL_D.format(c)}, {BACK_D.format(c)}) AS {c}" for c in MACRO) + " FROM macro", "macro")
def _(spark, sf):
    return fill.forward_backward_fill(macro(spark, sf), DATED, MACRO)


@q("conditional_fill", "WITH s AS (SELECT greatest(" + ", ".join(f"100.0 * (count(*) - count({c})) / count(*)" for c in MACRO)
   + ") AS worst FROM macro) SELECT dt, " + ", ".join(
    f"CASE WHEN worst > 5 THEN coalesce({FILL_D.format(c)}, {BACK_D.format(c)}) ELSE {c} END AS {c}" for c in MACRO)
   + " FROM macro, s", "macro")
def _(spark, sf):
    return fill.conditional_fill(macro(spark, sf), DATED, MACRO, "any", 5.0)


@q("median_fill", """
SELECT p.entity, dt, CAST(CAST(coalesce(price, m) AS FLOAT) AS DOUBLE) AS price
FROM prices p JOIN (SELECT entity, quantile_cont(price, 0.5) AS m FROM prices GROUP BY entity) g ON p.entity = g.entity""", "prices")
def _(spark, sf):
    return show(fill.median_fill(prices(spark, sf), ENTITY, ["price"]), "entity", "dt", price=-1)


@q("total_debt", f"""
SELECT entity, dt, {FILL.format('long_debt')} AS long_debt, short_debt,
       coalesce({FILL.format('long_debt')}, 0) + coalesce(short_debt, 0) AS total_debt FROM statements""", "statements")
def _(spark, sf):
    out = fill.total_debt(statements(spark, sf), ENTITY, "long_debt", "short_debt")
    return out.select("entity", "dt", "long_debt", "short_debt", "total_debt")


for _name, _pick, _dir in [("dedupe_keep_last", dedupe.keep_last, "DESC"), ("dedupe_keep_first", dedupe.keep_first, "ASC")]:
    @q(_name, f"""SELECT entity, dt, price, volume FROM (
         SELECT *, row_number() OVER (PARTITION BY entity, dt ORDER BY _ord {_dir}) AS rn FROM raw_prices) WHERE rn = 1""", "raw_prices")
    def _(spark, sf, pick=_pick):
        return pick(raw_prices(spark, sf), ENTITY.keys, ["_ord"]).select("entity", "dt", "price", "volume")


@q("duplicate_count", """
SELECT CAST(sum(n - 1) AS BIGINT) AS extra_rows, CAST(coalesce(sum(CASE WHEN n > 1 THEN n END), 0) AS BIGINT) AS member_rows,
       count(CASE WHEN n > 1 THEN 1 END) AS repeated_keys
FROM (SELECT count(*) AS n FROM raw_prices GROUP BY entity, dt)""", "raw_prices")
def _(spark, sf):
    return dedupe.duplicate_count(raw_prices(spark, sf), ENTITY.keys)


def _lead_fill_sql(source: str, order: str, part: str, cols: list[str], keep: str, extra: str = "") -> str:
    """Forward fill + median of the first ten valid rows, per part, for several columns."""
    over = f"OVER ({('PARTITION BY ' + part) if part else ''} ORDER BY {order} ROWS UNBOUNDED PRECEDING)"
    whole = f"OVER ({('PARTITION BY ' + part) if part else ''})"
    f = ", ".join(f"last_value({c} IGNORE NULLS) {over} AS f_{c}" for c in cols)
    k = ", ".join(f"count(f_{c}) {over} AS k_{c}" for c in cols)
    m = ", ".join(f"coalesce(f_{c}, quantile_cont(CASE WHEN k_{c} <= 10 THEN f_{c} END, 0.5) {whole}) AS n_{c}" for c in cols)
    out = ", ".join(f"CAST(CAST(n_{c} AS FLOAT) AS DOUBLE) AS {c}" for c in cols)
    return (f"WITH f AS (SELECT *, {f} FROM {source}), k AS (SELECT *, {k} FROM f), m AS (SELECT *, {m} FROM k) "
            f"SELECT {keep}, {out} FROM m {extra}")


@q("clean_macro", _lead_fill_sql("macro", "dt", "", MACRO, "dt"), "macro")
def _(spark, sf):
    raw = macro(spark, sf).withColumnRenamed("dt", "DATE")
    out = clean.clean_series(raw, DATED, rename={"DATE": "dt"})
    return show(out, "dt", **{c: -1 for c in MACRO})


@q("clean_market", _lead_fill_sql("market", "dt", "", ["vix", "idx"], "dt"), "market")
def _(spark, sf):
    raw = market(spark, sf).withColumnRenamed("idx", "SP500")
    out = clean.clean_series(raw, DATED, rename={"SP500": "idx"})
    return show(out, "dt", vix=-1, idx=-1)


@q("clean_prices", _lead_fill_sql(
    "raw_prices", "dt, _ord", "entity", ["price", "volume"], "entity, grp, dt",
    "QUALIFY row_number() OVER (PARTITION BY entity, dt ORDER BY _ord DESC) = 1"), "raw_prices")
def _(spark, sf):
    out = clean.clean_prices(raw_prices(spark, sf), Panel(("entity",), "dt", ("_ord",)),
                             price_candidates=("adj_price", "price", "close"),
                             keep=("entity", "grp", "dt", "_ord", "volume"), price="price")
    return show(out.withColumn("volume", F.col("volume").cast("double")), "entity", "grp", "dt", price=-1, volume=-1)


@q("clean_statements", f"""
WITH s AS (SELECT * REPLACE (CAST(dt + INTERVAL 45 DAY AS DATE) AS dt, {FILL.format('long_debt')} AS long_debt) FROM statements),
t AS (SELECT *, coalesce(long_debt, 0) + coalesce(short_debt, 0) AS total_debt FROM s),
f AS (SELECT entity, dt, revenue, total_debt, {FILL.format('equity')} AS equity, {FILL.format('short_debt')} AS short_debt FROM t),
k AS (SELECT *, count(equity) OVER w AS k_equity, count(short_debt) OVER w AS k_short FROM f
      WINDOW w AS (PARTITION BY entity ORDER BY dt ROWS UNBOUNDED PRECEDING))
SELECT entity, dt, revenue, total_debt,
       CAST(CAST(coalesce(equity, quantile_cont(CASE WHEN k_equity <= 10 THEN equity END, 0.5) OVER (PARTITION BY entity)) AS FLOAT) AS DOUBLE) AS equity,
       CAST(CAST(coalesce(short_debt, quantile_cont(CASE WHEN k_short <= 10 THEN short_debt END, 0.5) OVER (PARTITION BY entity)) AS FLOAT) AS DOUBLE) AS short_debt
FROM k""", "statements")
def _(spark, sf):
    out = clean.clean_statements(statements(spark, sf), ENTITY, lag_days=45, debt=("long_debt", "short_debt"))
    return show(out, "entity", "dt", "revenue", "total_debt", equity=-1, short_debt=-1)


@q("quarterly_to_daily", f"""
WITH b AS (SELECT min(dt) AS lo, max(dt) AS hi FROM statements),
days AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS dt FROM b),
e AS (SELECT DISTINCT entity FROM statements),
g AS (SELECT e.entity, days.dt, s.revenue, s.equity FROM e, days LEFT JOIN statements s ON s.entity = e.entity AND s.dt = days.dt),
n AS (SELECT DISTINCT s_suppkey, s_name FROM supplier)
SELECT entity, dt, s_name AS entity_name, {FILL.format('revenue')} AS revenue, {FILL.format('equity')} AS equity
FROM g JOIN n ON s_suppkey = entity""", "statements")
def _(spark, sf):
    names = read_table(spark, sf, "supplier").select(F.col("s_suppkey").alias("entity"), F.col("s_name").alias("entity_name"))
    st = statements(spark, sf).select("entity", "dt", "revenue", "equity").join(names, "entity")
    return fill.quarterly_to_daily(st, ENTITY, {"entity_name": "=Unknown"})


@q("asof_statement", """
SELECT p.entity, p.dt, p.price, s.revenue, e.equity FROM prices p
ASOF LEFT JOIN statements s ON p.entity = s.entity AND p.dt >= s.dt
ASOF LEFT JOIN (SELECT * FROM statements WHERE equity IS NOT NULL) e ON p.entity = e.entity AND p.dt >= e.dt""", "prices", "statements")
def _(spark, sf):
    left = prices(spark, sf).select("entity", "dt", "price")
    return fill.asof_join(left, statements(spark, sf), ENTITY, ["revenue", "equity"])


@q("exact_date_statement", f"""
SELECT entity, dt, price, {FILL.format('revenue')} AS revenue FROM
 (SELECT p.entity, p.dt, p.price, s.revenue FROM prices p LEFT JOIN statements s ON p.entity = s.entity AND p.dt = s.dt)""", "prices", "statements")
def _(spark, sf):
    left = prices(spark, sf).select("entity", "dt", "price")
    return fill.exact_date_join_fill(left, statements(spark, sf), ENTITY, ["revenue"])


@q("row_positions_blocked", """
SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS position FROM events""")
def _(spark, sf):
    ev = read_table(spark, sf, "events").select("event_id", "event_type", "ts")
    return blocks.row_positions(ev, ["event_type"], ["ts", "event_id"], "position").drop("ts")
