"""Window features, scalar features and ratios."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import REGISTRY
from catalog.views import DATED, ENTITY, macro, market, prices, read_table, show, statements
from pitpanel import Panel
from pitpanel.functions import columns as col
from pitpanel.operators import features, fill, windows
from pitpanel.operators.joins import join_calendar

q = REGISTRY.add

W = "WINDOW w AS (PARTITION BY entity ORDER BY dt)"
PAD = "last_value({0} IGNORE NULLS) OVER (PARTITION BY entity ORDER BY dt ROWS UNBOUNDED PRECEDING)"


def f32(expr: str, name: str) -> str:
    return f"CAST(CAST({expr} AS FLOAT) AS DOUBLE) AS {name}"


def rows(n: int) -> str:
    return f"ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW"


@q("lag_features", "SELECT entity, dt, " + ", ".join(f"lag({c}, {n}) OVER w AS {c}_lag{n}" for c in ("price", "volume") for n in (1, 5, 22))
   + f" FROM prices {W}", "prices")
def _(spark, sf):
    out = windows.lag_features(prices(spark, sf), ENTITY, ["price", "volume"], (1, 5, 22))
    return out.select("entity", "dt", *[f"{c}_lag{n}" for c in ("price", "volume") for n in (1, 5, 22)])


@q("lag_features_blocked", """
SELECT event_id, event_type, lag(value, 1) OVER w AS value_lag1, lag(value, 90) OVER w AS value_lag90
FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)""")
def _(spark, sf):
    ev = read_table(spark, sf, "events").select("event_id", "event_type", "ts", "value")
    by_type = Panel(("event_type",), "ts", ("event_id",))
    return windows.lag_features(ev, by_type, ["value"], (1, 90), blocked=True).drop("ts", "value")


@q("pct_change_padded", f"""
WITH p AS (SELECT *, {PAD.format('price')} AS pad FROM prices)
SELECT entity, dt, """ + ", ".join(f32(f"(pad / nullif(lag(pad, {n}) OVER w, 0) - 1) * 100", f"return_{n}d") for n in (1, 5, 22, 90, 252))
   + f", {f32('pad / nullif(lag(pad, 22) OVER w, 0) - 1', 'momentum_22d')} FROM p {W}", "prices")
def _(spark, sf):
    out = windows.pct_change(prices(spark, sf), ENTITY, {f"return_{n}d": ("price", n) for n in (1, 5, 22, 90, 252)})
    out = windows.pct_change(out, ENTITY, {"momentum_22d": ("price", 22)}, scale=1.0)
    return show(out, "entity", "dt", **{f"return_{n}d": -1 for n in (1, 5, 22, 90, 252)}, momentum_22d=-1)


@q("moving_average", "SELECT entity, dt, " + ", ".join(f32(f"avg(price) OVER (w {rows(n)})", f"ma{n}") for n in (5, 20, 50, 200))
   + f" FROM prices {W}", "prices")
def _(spark, sf):
    out = windows.moving_average(prices(spark, sf), ENTITY, {f"ma{n}": ("price", n) for n in (5, 20, 50, 200)})
    return show(out, "entity", "dt", ma5=-1, ma20=-1, ma50=-1, ma200=-1)


@q("moving_average_blocked", f"SELECT event_id, event_type, {f32(f'avg(value) OVER (w {rows(50)})', 'ma50')} "
   "FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)")
def _(spark, sf):
    ev = read_table(spark, sf, "events").select("event_id", "event_type", "ts", "value")
    by_type = Panel(("event_type",), "ts", ("event_id",))
    return show(windows.moving_average(ev, by_type, {"ma50": ("value", 50)}, blocked=True), "event_id", "event_type", ma50=-1)


@q("rolling_std", f"SELECT entity, dt, round(stddev_samp(price) OVER (w {rows(22)}), 4) AS std22, "
   f"round(stddev_samp(price) OVER (w {rows(30)}), 4) AS std30 FROM prices {W}", "prices")
def _(spark, sf):
    out = windows.rolling_std(prices(spark, sf), ENTITY, {"std22": ("price", 22), "std30": ("price", 30)})
    return show(out, "entity", "dt", std22=4, std30=4)


RETURN_1D = f"""p AS (SELECT *, {PAD.format('price')} AS pad FROM prices),
r AS (SELECT *, (pad / nullif(lag(pad, 1) OVER w, 0) - 1) * 100 AS r1 FROM p {W})"""


@q("annualized_vol", f"WITH {RETURN_1D} SELECT entity, dt, " + ", ".join(
    f"round(stddev_samp(r1) OVER (w {rows(n)}) * sqrt(252), 4) AS volatility_{n}d" for n in (22, 90)) + f" FROM r {W}", "prices")
def _(spark, sf):
    out = windows.pct_change(prices(spark, sf), ENTITY, {"r1": ("price", 1)})
    out = windows.annualized_volatility(out, ENTITY, {"volatility_22d": ("r1", 22), "volatility_90d": ("r1", 90)})
    return show(out, "entity", "dt", volatility_22d=4, volatility_90d=4)


@q("price_vs_ma", "SELECT entity, dt, " + ", ".join(f32(f"price / nullif(avg(price) OVER (w {rows(n)}), 0)", f"vs_ma{n}") for n in (50, 200))
   + ", " + f32(f"volume / nullif(avg(volume) OVER (w {rows(20)}), 0)", "volume_vs_ma20") + f" FROM prices {W}", "prices")
def _(spark, sf):
    out = windows.relative_to_average(prices(spark, sf), ENTITY, {
        "vs_ma50": ("price", 50), "vs_ma200": ("price", 200), "volume_vs_ma20": ("volume", 20)})
    return show(out, "entity", "dt", vs_ma50=-1, vs_ma200=-1, volume_vs_ma20=-1)


@q("rsi_14", f"""
WITH d AS (SELECT entity, dt, price - lag(price) OVER w AS step FROM prices {W}),
g AS (SELECT entity, dt, avg(CASE WHEN step > 0 THEN step ELSE 0 END) OVER (w {rows(14)}) AS gain,
             avg(CASE WHEN step < 0 THEN -step ELSE 0 END) OVER (w {rows(14)}) AS loss FROM d {W})
SELECT entity, dt, round(CASE WHEN loss > 1e-9 THEN 100 - 100 / (1 + gain / loss) END, 4) AS rsi FROM g""", "prices")
def _(spark, sf):
    return show(windows.rsi(prices(spark, sf), ENTITY, "price", "rsi"), "entity", "dt", rsi=4)


# nulls carry the average forward while its weight decays; the recursive query walks the rows of all entities at once
MACD_SQL = """
WITH RECURSIVE n AS (SELECT entity, dt, price, row_number() OVER (PARTITION BY entity ORDER BY dt) AS i FROM prices),
e AS (
  SELECT entity, dt, i, price AS x, price AS y12, price AS y26, 1.0::DOUBLE AS w12, 1.0::DOUBLE AS w26 FROM n WHERE i = 1
  UNION ALL
  SELECT n.entity, n.dt, n.i, n.price,
    CASE WHEN n.price IS NULL THEN e.y12 WHEN e.y12 IS NULL THEN n.price
         ELSE (e.w12 * 11 / 13 * e.y12 + 2.0::DOUBLE / 13 * n.price) / (e.w12 * 11 / 13 + 2.0::DOUBLE / 13) END,
    CASE WHEN n.price IS NULL THEN e.y26 WHEN e.y26 IS NULL THEN n.price
         ELSE (e.w26 * 25 / 27 * e.y26 + 2.0::DOUBLE / 27 * n.price) / (e.w26 * 25 / 27 + 2.0::DOUBLE / 27) END,
    CASE WHEN n.price IS NULL AND e.y12 IS NOT NULL THEN e.w12 * 11 / 13 ELSE 1 END,
    CASE WHEN n.price IS NULL AND e.y26 IS NOT NULL THEN e.w26 * 25 / 27 ELSE 1 END
  FROM e JOIN n ON n.entity = e.entity AND n.i = e.i + 1),
s AS (
  SELECT entity, dt, i, y12 - y26 AS m, y12 - y26 AS s FROM e WHERE i = 1
  UNION ALL
  SELECT e.entity, e.dt, e.i, e.y12 - e.y26,
    CASE WHEN e.y12 IS NULL THEN s.s WHEN s.s IS NULL THEN e.y12 - e.y26 ELSE 0.8::DOUBLE * s.s + 0.2::DOUBLE * (e.y12 - e.y26) END
  FROM s JOIN e ON e.entity = s.entity AND e.i = s.i + 1)
SELECT entity, dt, round(m, 4) AS macd, round(s, 4) AS macd_signal FROM s"""


@q("macd", MACD_SQL, "prices")
def _(spark, sf):
    out = windows.macd(prices(spark, sf).select("entity", "dt", "price"), ENTITY, "price")
    return show(out, "entity", "dt", macd=4, macd_signal=4)


@q("trend_flag", f"""
SELECT entity, dt, CASE WHEN count(price) OVER f > 0 THEN
   CASE WHEN count(*) OVER f > 1 AND last_value(price) OVER f > first_value(price) OVER f THEN 1 ELSE 0 END END AS trend_90d
FROM prices WINDOW f AS (PARTITION BY entity ORDER BY dt {rows(90)})""", "prices")
def _(spark, sf):
    return windows.trend_flag(prices(spark, sf), ENTITY, "price", "trend_90d").select("entity", "dt", "trend_90d")


@q("inflation_ma", f"""
WITH p AS (SELECT dt, last_value(cpi IGNORE NULLS) OVER (ORDER BY dt ROWS UNBOUNDED PRECEDING) AS pad FROM macro),
i AS (SELECT dt, (pad / nullif(lag(pad, 12) OVER (ORDER BY dt), 0) - 1) * 100 AS inflation FROM p)
SELECT dt, {f32('inflation', 'inflation')}, round(avg(inflation) OVER (ORDER BY dt {rows(90)}), 4) AS inflation_ma3m FROM i""", "macro")
def _(spark, sf):
    out = windows.pct_change(macro(spark, sf), DATED, {"inflation": ("cpi", 12)})
    out = windows.moving_average(out, DATED, {"inflation_ma3m": ("inflation", 90)})
    return show(out, "dt", inflation=-1, inflation_ma3m=4)


@q("date_gap_check", """
SELECT entity, CAST(max(gap) AS BIGINT) AS max_gap_days, CASE WHEN max(gap) > 30 THEN 1 ELSE 0 END AS gap_warning
FROM (SELECT entity, dt - lag(dt) OVER (PARTITION BY entity ORDER BY dt) AS gap FROM prices) GROUP BY entity""", "prices")
def _(spark, sf):
    return windows.max_date_gap(prices(spark, sf), ENTITY).withColumn("max_gap_days", F.col("max_gap_days").cast("long"))


@q("base100_index", "SELECT entity, dt, " + f32("high / nullif(first_value(high) OVER (PARTITION BY entity ORDER BY dt), 0) * 100", "index100")
   + " FROM prices", "prices")
def _(spark, sf):
    return show(windows.base_index(prices(spark, sf), ENTITY, "high", "index100"), "entity", "dt", index100=-1)


@q("forward_targets", "SELECT entity, dt, " + ", ".join(f32(f"(lead(price, {n}) OVER w / nullif(price, 0) - 1) * 100", f"return_next_{n}d") for n in (1, 5))
   + f" FROM prices {W}", "prices")
def _(spark, sf):
    out = windows.forward_targets(prices(spark, sf), ENTITY, "price", {"return_next_1d": 1, "return_next_5d": 5})
    return show(out, "entity", "dt", return_next_1d=-1, return_next_5d=-1)


@q("statement_next", "SELECT entity, dt, lead(revenue) OVER w AS revenue_next_q FROM statements " + W, "statements")
def _(spark, sf):
    st = statements(spark, sf)
    return st.select("entity", "dt", F.lead("revenue").over(ENTITY.ordered()).alias("revenue_next_q"))


# --- scalar features ---------------------------------------------------------------------------

@q("regime_bins", """SELECT dt, vix, CASE WHEN vix > 0 AND vix <= 15 THEN 'Low' WHEN vix > 15 AND vix <= 25 THEN 'Medium'
   WHEN vix > 25 AND vix <= 100 THEN 'High' END AS regime FROM market""", "market")
def _(spark, sf):
    return market(spark, sf).select("dt", "vix", features.volatility_regime(F.col("vix")).alias("regime"))


@q("threshold_flags", """SELECT dt, CASE WHEN spread < 0 THEN 1 ELSE 0 END AS spread_inverted,
   CASE WHEN ted > (SELECT quantile_cont(ted, 0.75) FROM macro) THEN 1 ELSE 0 END AS ted_high FROM macro""", "macro")
def _(spark, sf):
    m = macro(spark, sf)
    out = features.below_flag(m, "spread", 0.0, "spread_inverted")
    return features.above_quantile_flag(out, "ted", 0.75, "ted_high").select("dt", "spread_inverted", "ted_high")


@q("threshold_flags_entity", """SELECT entity, dt,
   CASE WHEN price > (SELECT quantile_cont(price, 0.75) FROM prices) THEN 1 ELSE 0 END AS price_high FROM prices""", "prices")
def _(spark, sf):
    p = prices(spark, sf)
    return features.above_quantile_flag(p, "price", 0.75, "price_high", large=True).select("entity", "dt", "price_high")


RATIOS = {
    "profit_margin": "net_income / nullif(revenue, 0) * 100", "roa": "net_income / nullif(assets, 0) * 100",
    "roe": "net_income / nullif(equity, 0) * 100",
    "debt_to_assets": "(coalesce(long_debt, 0) + coalesce(short_debt, 0)) / nullif(assets, 0) * 100",
    "cash_ratio": "cash / nullif(liabilities, 0)", "price_to_book": "revenue / nullif(equity / 1e9, 0)",
}


@q("financial_ratios", "SELECT entity, dt, " + ", ".join(f32(e, n) for n, e in RATIOS.items()) + " FROM statements", "statements")
def _(spark, sf):
    st = statements(spark, sf)
    st = st.withColumn("total_debt", F.coalesce("long_debt", F.lit(0.0)) + F.coalesce("short_debt", F.lit(0.0)))
    out = features.financial_ratios(st, features.Statement(price="revenue"))
    return show(out, "entity", "dt", **{n: -1 for n in RATIOS})


@q("growth_rates", f"""
WITH p AS (SELECT entity, dt, {PAD.format('equity')} AS e, revenue AS r FROM statements)
SELECT entity, dt, {f32('(r / nullif(lag(r, 1) OVER w, 0) - 1) * 100', 'revenue_qoq')},
       {f32('(r / nullif(lag(r, 4) OVER w, 0) - 1) * 100', 'revenue_yoy')},
       {f32('(e / nullif(lag(e, 4) OVER w, 0) - 1) * 100', 'equity_yoy')} FROM p {W}""", "statements")
def _(spark, sf):
    out = windows.pct_change(statements(spark, sf), ENTITY, {
        "revenue_qoq": ("revenue", 1), "revenue_yoy": ("revenue", 4), "equity_yoy": ("equity", 4)})
    return show(out, "entity", "dt", revenue_qoq=-1, revenue_yoy=-1, equity_yoy=-1)


MACRO_FILLED = "m AS (SELECT dt, " + ", ".join(
    f"last_value({c} IGNORE NULLS) OVER (ORDER BY dt ROWS UNBOUNDED PRECEDING) AS {c}" for c in ("gdp", "cpi", "unemp", "ffr", "spread", "ted")) + " FROM macro)"
MACRO_X = f"""{MACRO_FILLED},
g AS (SELECT m.*, (gdp / nullif(lag(gdp, 90) OVER (ORDER BY m.dt), 0) - 1) * 100 AS gdp_growth,
             (cpi / nullif(lag(cpi, 12) OVER (ORDER BY m.dt), 0) - 1) * 100 AS inflation FROM m),
k AS (SELECT dt, vix, last_value(idx IGNORE NULLS) OVER (ORDER BY dt ROWS UNBOUNDED PRECEDING) AS idx FROM market),
h AS (SELECT dt, vix, (idx / nullif(lag(idx, 22) OVER (ORDER BY dt), 0) - 1) * 100 AS market_return_22d FROM k),
x AS (SELECT g.*, vix, market_return_22d FROM g LEFT JOIN h ON g.dt = h.dt)"""


def macro_context(spark, sf):
    m = fill.forward_fill(macro(spark, sf), DATED, ["gdp", "cpi", "unemp", "ffr", "spread", "ted"])
    m = windows.pct_change(m, DATED, {"gdp_growth": ("gdp", 90), "inflation": ("cpi", 12)})
    k = windows.pct_change(market(spark, sf), DATED, {"market_return_22d": ("idx", 22)})
    return join_calendar(m, k.select("dt", "vix", "market_return_22d"), "dt")


@q("macro_interactions", f"""
WITH {MACRO_X}
SELECT dt, {f32('ffr - inflation', 'real_interest_rate')}, {f32('ffr * (1 / nullif(spread + 0.01::DOUBLE, 0))', 'monetary_tightness')},
  {f32('inflation * (1 / nullif(gdp_growth + 0.01::DOUBLE, 0))', 'stagflation_risk')}, {f32('unemp * abs(gdp_growth)', 'unemployment_gdp')},
  {f32('vix * abs(market_return_22d)', 'vix_return')}, {f32('vix * ted', 'financial_stress')},
  CASE WHEN vix > (SELECT quantile_cont(vix, 0.75) FROM x) THEN 1 ELSE 0 END AS high_volatility_regime,
  CASE WHEN spread < 0 THEN 1 ELSE 0 END AS recession_signal,
  CASE WHEN ted > (SELECT quantile_cont(ted, 0.75) FROM x) THEN 1 ELSE 0 END AS credit_stress_regime FROM x""", "macro", "market")
def _(spark, sf):
    out = features.macro_interactions(macro_context(spark, sf))
    return show(out, "dt", "high_volatility_regime", "recession_signal", "credit_stress_regime",
                **{n: -1 for n in ("real_interest_rate", "monetary_tightness", "stagflation_risk", "unemployment_gdp",
                                   "vix_return", "financial_stress")})


ENTITY_X = {
    "revenue_to_gdp": "revenue / nullif(gdp * 1e9, 0)", "unemployment_revenue": "unemp * abs(revenue_yoy)",
    "gdp_revenue_sync": "gdp_growth * revenue_qoq", "interest_burden": "ffr * total_debt / 1e9",
    "leverage_sensitivity": "ffr * debt_to_equity", "refinancing_risk": "(1 / nullif(spread + 0.01::DOUBLE, 0)) * debt_to_assets",
    "inflation_margin_pressure": "inflation * (1 / nullif(profit_margin + 0.01::DOUBLE, 0))",
    "profit_under_stress": "roe * (1 / nullif(vix + 1, 0))",
    "liquidity_buffer": "current_ratio * (1 / nullif(ted + 0.01::DOUBLE, 0))",
    "market_beta": "least(greatest(revenue_qoq / nullif(market_return_22d + 1e-6, 0), -5), 5)",
    "relative_performance": "revenue_yoy - market_return_22d",
    "crisis_leverage": "debt_to_equity * high_vol", "recession_margin": "(1 / nullif(profit_margin + 0.01::DOUBLE, 0)) * recession",
}


@q("entity_interactions", f"""
WITH {MACRO_X},
z AS (SELECT x.*, CASE WHEN vix > (SELECT quantile_cont(vix, 0.75) FROM x) THEN 1 ELSE 0 END AS high_vol,
             CASE WHEN spread < 0 THEN 1 ELSE 0 END AS recession FROM x),
s AS (SELECT *, coalesce(long_debt, 0) + coalesce(short_debt, 0) AS total_debt,
        (revenue / nullif(lag(revenue, 1) OVER w, 0) - 1) * 100 AS revenue_qoq,
        (revenue / nullif(lag(revenue, 4) OVER w, 0) - 1) * 100 AS revenue_yoy,
        net_income / nullif(revenue, 0) * 100 AS profit_margin, net_income / nullif(equity, 0) * 100 AS roe,
        (coalesce(long_debt, 0) + coalesce(short_debt, 0)) / nullif(assets, 0) * 100 AS debt_to_assets,
        (coalesce(long_debt, 0) + coalesce(short_debt, 0)) / nullif(equity, 0) AS debt_to_equity,
        assets / nullif(liabilities, 0) AS current_ratio FROM statements {W}),
j AS (SELECT s.*, z.* EXCLUDE (dt) FROM s LEFT JOIN z ON s.dt = z.dt)
SELECT entity, dt, """ + ", ".join(
    f32(f"CASE WHEN revenue_qoq IS NULL OR market_return_22d IS NULL THEN NULL ELSE {e} END" if n == "market_beta" else e, n)
    for n, e in ENTITY_X.items()) + " FROM j", "macro", "market", "statements")
def _(spark, sf):
    context = features.macro_interactions(macro_context(spark, sf))
    st = statements(spark, sf).withColumn("total_debt", F.coalesce("long_debt", F.lit(0.0)) + F.coalesce("short_debt", F.lit(0.0)))
    st = windows.pct_change(st, ENTITY, {"revenue_qoq": ("revenue", 1), "revenue_yoy": ("revenue", 4)})
    st = features.financial_ratios(st, features.Statement())
    st = st.withColumns({
        "debt_to_equity": col.ratio(F.col("total_debt"), F.col("equity")),
        "current_ratio": col.ratio(F.col("assets"), F.col("liabilities")),
    })
    names = features.EntityContext(entity_return="revenue_qoq", long_return="revenue_yoy", market_long_return="market_return_22d")
    out = features.entity_interactions(join_calendar(st, context, "dt"), names)
    return show(out, "entity", "dt", **{n: -1 for n in ENTITY_X})


STRESS = ["vix", "ted", "ffr", "unemp"]
N4 = range(4)


def _square(i: int, k: int) -> str:
    return "(" + " + ".join(f"c{i}{m} * c{m}{k}" for m in N4) + ")"


# squaring the correlation matrix over and over leaves the outer product of its first eigenvector;
# the column of the leading series then has the wanted sign
PCA_SQL = f"""
WITH RECURSIVE j AS (SELECT macro.dt, vix, ted, ffr, unemp FROM macro LEFT JOIN market ON macro.dt = market.dt),
f AS (SELECT dt, {", ".join(f"coalesce(last_value({c} IGNORE NULLS) OVER (ORDER BY dt ROWS UNBOUNDED PRECEDING), 0) AS x{i}" for i, c in enumerate(STRESS))} FROM j),
m AS (SELECT {", ".join(f"avg(x{i}) AS a{i}, stddev_samp(x{i}) AS s{i}" for i in N4)} FROM f),
z AS (SELECT dt, {", ".join(f"(x{i} - a{i}) / s{i} AS z{i}" for i in N4)} FROM f, m),
r AS (SELECT 0 AS n, {", ".join(f"corr(z{i}, z{k}) AS c{i}{k}" for i in N4 for k in N4)} FROM z
      UNION ALL SELECT n + 1, {", ".join(f"{_square(i, k)} / ({' + '.join(_square(m, m) for m in N4)})" for i in N4 for k in N4)} FROM r WHERE n < 40),
v AS (SELECT {", ".join(f"c{i}0 / sqrt({' + '.join(f'c{m}0 * c{m}0' for m in N4)}) AS v{i}" for i in N4)} FROM r WHERE n = 40)
SELECT dt, round({" + ".join(f"z{i} * v{i}" for i in N4)}, 4) AS stress_index FROM z, v"""


@q("stress_index_pca", PCA_SQL, "macro", "market")
def _(spark, sf):
    m = join_calendar(macro(spark, sf), market(spark, sf).select("dt", "vix"), "dt")
    out = features.stress_index(m, DATED, STRESS, lead="vix")
    return show(out, "dt", stress_index=4)


HEALTH = ["profit_margin", "roe", "current_ratio"]


@q("health_score", f"""
WITH r AS (SELECT entity, dt, net_income / nullif(revenue, 0) * 100 AS profit_margin, net_income / nullif(equity, 0) * 100 AS roe,
                  assets / nullif(liabilities, 0) AS current_ratio FROM statements),
f AS (SELECT entity, dt, """ + ", ".join(f"coalesce({PAD.format(c)}, 0) AS {c}" for c in HEALTH) + f"""
      FROM r), e AS (SELECT """ + ", ".join(f"quantile_cont({c}, 0.05) AS lo_{c}, quantile_cont({c}, 0.95) AS hi_{c}" for c in HEALTH) + """ FROM f)
SELECT entity, dt, round((""" + " + ".join(f"least(greatest(({c} - lo_{c}) / (hi_{c} - lo_{c} + 1e-6), 0), 1)" for c in HEALTH) + """) / 3, 6) AS health_score
FROM f, e""", "statements")
def _(spark, sf):
    st = features.financial_ratios(statements(spark, sf), features.Statement(total_debt="long_debt"))
    st = st.withColumn("current_ratio", col.ratio(F.col("assets"), F.col("liabilities")))
    return show(features.health_score(st, ENTITY, HEALTH), "entity", "dt", health_score=6)


@q("calendar_features", """SELECT entity, dt, CAST(year(dt) AS INTEGER) AS year, CAST(month(dt) AS INTEGER) AS month, CAST(quarter(dt) AS INTEGER) AS quarter,
   CAST(isodow(dt) - 1 AS INTEGER) AS day_of_week, CASE WHEN dt = last_day(dt) THEN 1 ELSE 0 END AS is_month_end FROM prices""", "prices")
def _(spark, sf):
    return prices(spark, sf).select("entity", "dt").withColumns(col.calendar(F.col("dt")))


@q("crisis_flags", """SELECT entity, dt, CASE WHEN year(dt) = 1997 THEN 1 ELSE 0 END AS crisis_1997,
   CASE WHEN year(dt) = 2000 THEN 1 ELSE 0 END AS crisis_2000 FROM prices""", "prices")
def _(spark, sf):
    return features.crisis_flags(prices(spark, sf), "dt", [1997, 2000]).select("entity", "dt", "crisis_1997", "crisis_2000")


@q("coerce_types", """SELECT event_id, ts, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, event_type AS tag,
   CASE WHEN event_id % 4 = 0 THEN NULL ELSE value END AS mostly_number,
   CASE WHEN event_id % 4 = 0 THEN CAST(value AS VARCHAR) ELSE 'n/a' END AS mostly_text FROM events""")
def _(spark, sf):
    ev = read_table(spark, sf, "events")
    text = ev.select(
        "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"),
        F.get_json_object("props", "$.k").alias("k"), F.col("event_type").alias("tag"),
        F.when(F.col("event_id") % 4 == 0, "n/a").otherwise(F.col("value").cast("string")).alias("mostly_number"),
        F.when(F.col("event_id") % 4 == 0, F.col("value").cast("string")).otherwise("n/a").alias("mostly_text"),
    )
    return features.coerce_types(text, timestamps=["ts"], keep_text=["tag"])


@q("wide_to_long", "SELECT dt, 'AFRICA' AS entity, 'price' AS metric, 1.0::DOUBLE AS value FROM market WHERE false UNION ALL "
   "SELECT dt, split_part(k, '_', 1), substr(k, strpos(k, '_') + 1), v FROM (SELECT dt, 'IDX_vix' AS k, vix AS v FROM market UNION ALL "
   "SELECT dt, 'IDX_close_level', idx FROM market UNION ALL SELECT dt, 'VOL_vix', vix * 2 FROM market) WHERE v IS NOT NULL", "market")
def _(spark, sf):
    m = market(spark, sf)
    wide = m.select("dt", F.col("vix").alias("IDX_vix"), F.col("idx").alias("IDX_close_level"), (F.col("vix") * 2).alias("VOL_vix"))
    return features.wide_to_long(wide, ["dt"])


@q("long_to_wide", """SELECT dt, """ + ", ".join(
    f"""CAST(max(CASE WHEN grp = '{g}' THEN volume END) AS BIGINT) AS "{g}_volume", CAST(count(CASE WHEN grp = '{g}' THEN price END) AS BIGINT) AS "{g}_priced" """
    for g in ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")) + " FROM prices GROUP BY dt", "prices")
def _(spark, sf):
    return features.long_to_wide(prices(spark, sf), ["dt"], "grp", ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"), {
        "volume": F.max("volume"), "priced": F.count("price")}).transform(
            lambda d: d.select("dt", *[F.coalesce(c, F.lit(0)).alias(c) if c.endswith("priced") else F.col(c) for c in d.columns if c != "dt"]))
