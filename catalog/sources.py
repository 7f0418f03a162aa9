"""Ingestion: typed scans, statement payloads, alignment, incremental skip, older loaders; basic projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import REGISTRY
from catalog.features import PAD, W, f32, rows
from catalog.views import DATED, ENTITY, macro, market, prices, read_table, runs, show, statements
from pitpanel.functions import columns as col
from pitpanel.operators import merge, windows
from pitpanel.sources import readers

q = REGISTRY.add


@q("scan_typed", "SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS l_shipdate, l_extendedprice FROM lineitem")
def _(spark, sf):
    return readers.read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("l_shipdate"), "l_extendedprice")


def _payloads(spark, sf):
    """Statements of an entity packed as the JSON text a provider would send, with 'None' for unknown values."""
    st = statements(spark, sf)
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("None"))
    odd = F.month("dt") == 3  # these reports use the alternative keys
    report = F.struct(
        F.when(~odd, F.col("dt").cast("string")).otherwise("").alias("fiscalDateEnding"),
        F.when(odd, F.col("dt").cast("string")).alias("date"),
        F.when(odd, "").otherwise(text("revenue")).alias("totalRevenue"),
        F.when(odd, text("revenue")).alias("revenue"),
        text("net_income").alias("netIncome"), text("equity").alias("totalShareholderEquity"),
        text("assets").alias("totalAssets"), text("liabilities").alias("totalCurrentLiabilities"),
    )
    # an entity has at most four reports a year, so the array is bounded by the calendar
    return st.groupBy("entity").agg(F.to_json(F.struct(F.collect_list(report).alias("quarterlyReports"))).alias("payload"))


INCOME = {"revenue": ["totalRevenue", "revenue"], "net_income": ["netIncome"]}
BALANCE = {"equity": ["totalShareholderEquity"], "assets": ["totalAssets"], "liabilities": ["totalCurrentLiabilities"]}


@q("ingest_statement_json", "SELECT entity, dt, revenue, net_income FROM statements", "statements")
def _(spark, sf):
    return readers.statement_rows(_payloads(spark, sf), "entity", "payload", INCOME)


@q("ingest_balance_ratios", """SELECT entity, dt, equity, assets, liabilities,
   assets / CASE WHEN equity = 0 THEN 1 ELSE equity END AS debt_to_equity,
   assets / CASE WHEN liabilities = 0 THEN 1 ELSE liabilities END AS current_ratio FROM statements""", "statements")
def _(spark, sf):
    out = readers.statement_rows(_payloads(spark, sf), "entity", "payload", BALANCE)
    return readers.balance_ratios(out, "assets", "equity", "assets", "liabilities")


@q("entity_tag_union", """
SELECT p.entity, p.dt, p.price, p.high AS adj_price, s_name AS entity_name, n_name AS place FROM (
  SELECT entity, dt, price, high FROM prices WHERE grp = 'ASIA' UNION ALL SELECT entity, dt, price, high FROM prices WHERE grp <> 'ASIA') p
LEFT JOIN supplier ON s_suppkey = p.entity LEFT JOIN nation ON s_nationkey = n_nationkey""", "prices")
def _(spark, sf):
    p = prices(spark, sf)
    parts = merge.union_all([p.filter(F.col("grp") == "ASIA"), p.filter(F.col("grp") != "ASIA")])
    nation = F.broadcast(read_table(spark, sf, "nation"))  # 25 rows at any scale
    dim = read_table(spark, sf, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("entity"), F.col("s_name").alias("entity_name"), F.col("n_name").alias("place"))
    return readers.tag_entities(parts, "entity", dim, ["dt", "price", "adj_price"], {"adj_price": "high"})


@q("align_series_pivot", """
SELECT coalesce(a.dt, b.dt) AS dt, gdp, cpi, vix FROM (SELECT dt, gdp, cpi FROM macro WHERE gdp IS NOT NULL OR cpi IS NOT NULL) a
FULL JOIN (SELECT dt, vix FROM market WHERE vix IS NOT NULL) b ON a.dt = b.dt""", "macro", "market")
def _(spark, sf):
    a = macro(spark, sf).unpivot(["dt"], ["gdp", "cpi"], "series", "value")
    b = market(spark, sf).unpivot(["dt"], ["vix"], "series", "value")
    return readers.align_series(merge.union_all([a, b]).dropna(subset=["value"]), "dt", "series", "value", ["gdp", "cpi", "vix"])


@q("incremental_anti_join", "SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderdate < DATE '1996-01-01')")
def _(spark, sf):
    done = read_table(spark, sf, "orders").filter(F.col("o_orderdate") < "1996-01-01").select(F.col("o_custkey").alias("c_custkey"))
    return readers.skip_processed(read_table(spark, sf, "customer"), done, "c_custkey").select("c_custkey", "c_name", "c_mktsegment")


@q("statement_derived", f"""
SELECT entity, dt, {f32('net_income / nullif(revenue, 0) * 100', 'profit_margin')},
  {f32('(revenue / nullif(lag(revenue) OVER w, 0) - 1) * 100', 'revenue_growth')},
  {f32('(net_income / nullif(lag(net_income) OVER w, 0) - 1) * 100', 'eps_growth')},
  {f32('revenue / nullif(assets, 0)', 'asset_turnover')}, {f32('net_income / nullif(equity, 0) * 100', 'roe')} FROM statements {W}""", "statements")
def _(spark, sf):
    st = statements(spark, sf)
    out = merge.statement_derived(st.select("entity", "dt", "revenue", "net_income"),
                                  st.select("entity", "dt", "assets", "equity"), ENTITY)
    return show(out, "entity", "dt", **{c: -1 for c in ("profit_margin", "revenue_growth", "eps_growth", "asset_turnover", "roe")})


@q("price_features_fullwindow", f"""
WITH p AS (SELECT *, {PAD.format('price')} AS pad FROM prices), r AS (SELECT *, (pad / nullif(lag(pad) OVER w, 0) - 1) * 100 AS r1,
   (pad / nullif(lag(pad, 5) OVER w, 0) - 1) * 100 AS r5 FROM p {W})
SELECT entity, dt, {f32('r1', 'return_1d')}, {f32('r5', 'return_5d')},
  round(CASE WHEN count(r1) OVER (w {rows(20)}) >= 20 THEN stddev_samp(r1) OVER (w {rows(20)}) END, 4) AS std20,
  {f32(f'CASE WHEN count(pad) OVER (w {rows(50)}) >= 50 THEN avg(pad) OVER (w {rows(50)}) END', 'ma50')},
  {f32(f'CASE WHEN count(volume) OVER (w {rows(20)}) >= 20 THEN avg(volume) OVER (w {rows(20)}) END', 'volume_ma20')},
  {f32('(high - low) / nullif(low, 0) * 100', 'day_range')} FROM r {W}""", "prices")
def _(spark, sf):
    out = merge.price_features_full_window(prices(spark, sf), ENTITY)
    return show(out, "entity", "dt", return_1d=-1, return_5d=-1, std20=4, ma50=-1, volume_ma20=-1, day_range=-1)


@q("macro_growth", """
WITH p AS (SELECT dt, """ + ", ".join(f"last_value({c} IGNORE NULLS) OVER (ORDER BY dt ROWS UNBOUNDED PRECEDING) AS {c}" for c in ("gdp", "cpi", "oil")) + f""" FROM macro)
SELECT dt, {f32('(gdp / nullif(lag(gdp) OVER (ORDER BY dt), 0) - 1) * 100', 'gdp_growth')},
       {f32('(cpi / nullif(lag(cpi, 4) OVER (ORDER BY dt), 0) - 1) * 100', 'inflation')},
       {f32('(oil / nullif(lag(oil) OVER (ORDER BY dt), 0) - 1) * 100', 'oil_return')} FROM p""", "macro")
def _(spark, sf):
    out = windows.pct_change(macro(spark, sf), DATED, {"gdp_growth": ("gdp", 1), "inflation": ("cpi", 4), "oil_return": ("oil", 1)})
    return show(out, "dt", gdp_growth=-1, inflation=-1, oil_return=-1)


@q("price_column_choice", "SELECT entity, dt, price AS chosen FROM prices", "prices")
def _(spark, sf):
    p = prices(spark, sf)
    return p.select("entity", "dt", col.first_existing(p, ["adj_close", "price", "high"]).alias("chosen"))


@q("column_projection", "SELECT entity, dt, price AS close, volume FROM prices", "prices")
def _(spark, sf):
    p = prices(spark, sf).withColumnRenamed("price", "close")
    return col.keep_existing(p, ["entity", "dt", "close", "volume", "adj_close"])


@q("drop_all_null_rows", "SELECT dt, gdp, cpi, ffr FROM macro WHERE gdp IS NOT NULL OR cpi IS NOT NULL OR ffr IS NOT NULL", "macro")
def _(spark, sf):
    return macro(spark, sf).select("dt", "gdp", "cpi", "ffr").dropna(how="all", subset=["gdp", "cpi", "ffr"])


@q("period_filter", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS dt, o_totalprice FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1997")
def _(spark, sf):
    return read_table(spark, sf, "orders").filter(merge.year_range("o_orderdate", 1996, 1997)).select(
        "o_orderkey", F.to_date("o_orderdate").alias("dt"), "o_totalprice")


@q("equality_slice", "SELECT entity, dt, volume FROM prices WHERE grp = 'EUROPE'", "prices")
def _(spark, sf):
    return prices(spark, sf).filter(F.col("grp") == "EUROPE").select("entity", "dt", "volume")


@q("topk_entities", "SELECT entity, n, 'top' AS side FROM (SELECT entity, count(*) AS n FROM prices GROUP BY 1 ORDER BY n DESC, entity LIMIT 5) UNION ALL "
   "SELECT entity, n, 'bottom' FROM (SELECT entity, count(*) AS n FROM prices GROUP BY 1 ORDER BY n, entity LIMIT 5)", "prices")
def _(spark, sf):
    n = prices(spark, sf).groupBy("entity").agg(F.count("*").alias("n"))
    return merge.top_bottom(n, "n", ["entity"], 5)
