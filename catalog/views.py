"""Panels derived from the given tables: as DataFrames, and as SQL text for the oracle.

Sums run over integers (cents, percent points), so both engines get bit-identical inputs whatever
the order of summation. Nulls are injected by key arithmetic because the tables hold none.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitpanel import Panel
from pitpanel.sources.readers import read_table

ENTITY = Panel(("entity",), "dt")
DATED = Panel((), "dt")

VIEWS: dict[str, str] = {
    "prices": """
      SELECT a.entity, s_name AS entity_name, r_name AS grp, a.dt,
             CASE WHEN (day(a.dt) + a.entity) % 7 = 0 THEN NULL ELSE a.gross / a.volume END AS price,
             a.high, a.low, a.volume
      FROM (SELECT l_suppkey AS entity, CAST(l_shipdate AS DATE) AS dt,
                   CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) / 100 AS gross,
                   CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS volume,
                   max(l_extendedprice / l_quantity) AS high, min(l_extendedprice / l_quantity) AS low
            FROM lineitem GROUP BY 1, 2) a
      JOIN supplier ON s_suppkey = a.entity
      JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "statements": """
      SELECT entity, dt, revenue, net - 0.95::DOUBLE * revenue AS net_income,
             CASE WHEN (month(dt) // 3 + entity) % 5 = 0 THEN NULL ELSE units * 100.0::DOUBLE END AS equity,
             units * 250.0::DOUBLE AS assets,
             CASE WHEN (month(dt) // 3 + entity) % 3 = 0 THEN NULL ELSE units * 60.0::DOUBLE END AS long_debt,
             CASE WHEN (month(dt) // 3 + entity) % 4 = 0 THEN NULL ELSE n * 90.0::DOUBLE END AS short_debt,
             tax * 10.0::DOUBLE AS cash, CASE WHEN entity % 10 = 3 THEN 0.0::DOUBLE ELSE n * 120.0::DOUBLE END AS liabilities
      FROM (SELECT l_suppkey AS entity,
                   last_day(CAST(date_trunc('quarter', l_shipdate) AS DATE) + INTERVAL 2 MONTH) AS dt,
                   CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) / 100 AS revenue,
                   CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)
                            * (100 - CAST(round(l_discount * 100) AS BIGINT))) AS DOUBLE) / 10000 AS net,
                   CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS units,
                   CAST(sum(CAST(round(l_tax * 100) AS BIGINT)) AS BIGINT) AS tax,
                   count(*) AS n
            FROM lineitem GROUP BY 1, 2)""",
    "macro": """
      SELECT dt, CASE WHEN day(dt) % 9 = 1 THEN cents / 100000.0::DOUBLE END AS gdp,
             CASE WHEN day(dt) % 4 = 1 THEN cents / n / 100000.0::DOUBLE END AS cpi,
             CAST(u AS DOUBLE) / n AS unemp,
             CASE WHEN (day(dt) + month(dt)) % 6 = 0 THEN NULL ELSE CAST(f AS DOUBLE) / n END AS ffr,
             CAST(s AS DOUBLE) / n - 5 AS spread, hi AS oil, lo AS conf,
             CASE WHEN day(dt) % 11 = 0 THEN NULL ELSE CAST(t AS DOUBLE) / n END AS ted
      FROM (SELECT CAST(o_orderdate AS DATE) AS dt,
                   CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) AS cents, count(*) AS n,
                   sum(o_custkey % 97) AS u, sum(o_custkey % 7) AS f, sum(o_custkey % 11) AS s,
                   sum(o_orderkey % 13) AS t,
                   max(o_totalprice) / 1000 AS hi, min(o_totalprice) / 1000 AS lo
            FROM orders GROUP BY 1)""",
    "market": """
      SELECT dt, CASE WHEN n1 = 0 THEN NULL ELSE CAST(q1 AS DOUBLE) / n1 END AS vix,
             CASE WHEN day(dt) % 13 = 0 THEN NULL ELSE cents / n / 10000 END AS idx
      FROM (SELECT CAST(l_shipdate AS DATE) AS dt, count(*) AS n,
                   CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) AS cents,
                   sum(CASE WHEN l_linenumber = 1 THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS q1,
                   sum(CASE WHEN l_linenumber = 1 THEN 1 ELSE 0 END) AS n1
            FROM lineitem GROUP BY 1)""",
    "runs": """
      SELECT event_type AS step, ts AS run_ts, value AS duration_s, event_id % 10 <> 0 AS success, event_id
      FROM events""",
    # every row of the first day of a month comes twice; the second copy (_ord 1) is the newer one
    "raw_prices": """
      SELECT *, 0 AS _ord FROM prices
      UNION ALL SELECT entity, entity_name, grp, dt, CASE WHEN entity % 2 = 0 THEN NULL ELSE price * 1.5::DOUBLE END,
                       high, low, volume + 1, 1 AS _ord FROM prices WHERE day(dt) = 1""",
    # infinities on a key subset
    "spiked": """
      SELECT entity, grp, dt, volume,
             CASE WHEN (volume + entity) % 50 = 7 THEN 'Infinity'::DOUBLE
                  WHEN (volume + entity) % 50 = 9 THEN '-Infinity'::DOUBLE ELSE price END AS price,
             CASE WHEN volume % 40 = 3 THEN 'Infinity'::DOUBLE ELSE high END AS high, low FROM prices""",
}

_NEEDS = {"raw_prices": ["prices"], "spiked": ["prices"]}


def oracle(body: str, *views: str) -> str:
    """``body`` with the named views in front as common table expressions."""
    order: list[str] = []

    def add(name: str) -> None:
        for need in _NEEDS.get(name, []):
            add(need)
        if name not in order:
            order.append(name)

    for v in views:
        add(v)
    if not order:
        return body
    ctes = ",\n".join(f"{v} AS ({VIEWS[v]})" for v in order)
    body = body.strip()
    if body.upper().startswith("WITH RECURSIVE"):
        return f"WITH RECURSIVE {ctes},\n{body[len('WITH RECURSIVE'):]}"
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


def _cents(c: str):
    return F.round(F.col(c) * 100).cast("long")


def prices(spark: SparkSession, sf: str) -> DataFrame:
    """Daily panel: lineitem is reduced to one row per supplier and day before anything is joined."""
    unit = F.col("l_extendedprice") / F.col("l_quantity")
    daily = (
        read_table(spark, sf, "lineitem")
        .groupBy(F.col("l_suppkey").alias("entity"), F.to_date("l_shipdate").alias("dt"))
        .agg(
            (F.sum(_cents("l_extendedprice")).cast("double") / 100).alias("gross"),
            F.sum(F.col("l_quantity").cast("long")).alias("volume"),
            F.max(unit).alias("high"),
            F.min(unit).alias("low"),
        )
    )
    places = (
        read_table(spark, sf, "nation")
        .join(F.broadcast(read_table(spark, sf, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey", F.col("r_name").alias("grp"))
    )  # 25 rows at any scale
    names = (
        read_table(spark, sf, "supplier")
        .join(F.broadcast(places), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(F.col("s_suppkey").alias("entity"), F.col("s_name").alias("entity_name"), "grp")
    )
    known = F.when((F.day("dt") + F.col("entity")) % 7 != 0, F.col("gross") / F.col("volume"))
    return daily.join(names, "entity").select(
        "entity", "entity_name", "grp", "dt", known.alias("price"), "high", "low", "volume"
    )


def statements(spark: SparkSession, sf: str) -> DataFrame:
    cents = _cents("l_extendedprice")
    quarter_end = F.last_day(F.add_months(F.date_trunc("quarter", "l_shipdate").cast("date"), 2))
    base = (
        read_table(spark, sf, "lineitem")
        .groupBy(F.col("l_suppkey").alias("entity"), quarter_end.alias("dt"))
        .agg(
            (F.sum(cents).cast("double") / 100).alias("revenue"),
            (F.sum(cents * (100 - _cents("l_discount"))).cast("double") / 10000).alias("net"),
            F.sum(F.col("l_quantity").cast("long")).alias("units"),
            F.sum(_cents("l_tax")).alias("tax"),
            F.count("*").alias("n"),
        )
    )
    phase = F.quarter("dt") + F.col("entity")
    return base.select(
        "entity", "dt", "revenue", (F.col("net") - 0.95 * F.col("revenue")).alias("net_income"),
        F.when(phase % 5 != 0, F.col("units") * 100.0).alias("equity"),
        (F.col("units") * 250.0).alias("assets"),
        F.when(phase % 3 != 0, F.col("units") * 60.0).alias("long_debt"),
        F.when(phase % 4 != 0, F.col("n") * 90.0).alias("short_debt"),
        (F.col("tax") * 10.0).alias("cash"),
        F.when(F.col("entity") % 10 == 3, 0.0).otherwise(F.col("n") * 120.0).alias("liabilities"),
    )


def macro(spark: SparkSession, sf: str) -> DataFrame:
    base = (
        read_table(spark, sf, "orders")
        .groupBy(F.to_date("o_orderdate").alias("dt"))
        .agg(
            F.sum(_cents("o_totalprice")).cast("double").alias("cents"),
            F.count("*").alias("n"),
            F.sum(F.col("o_custkey") % 97).alias("u"),
            F.sum(F.col("o_custkey") % 7).alias("f"),
            F.sum(F.col("o_custkey") % 11).alias("s"),
            F.sum(F.col("o_orderkey") % 13).alias("t"),
            (F.max("o_totalprice") / 1000).alias("oil"),
            (F.min("o_totalprice") / 1000).alias("conf"),
        )
    )
    day, n = F.day("dt"), F.col("n")
    return base.select(
        "dt",
        F.when(day % 9 == 1, F.col("cents") / 100000.0).alias("gdp"),
        F.when(day % 4 == 1, F.col("cents") / n / 100000.0).alias("cpi"),
        (F.col("u").cast("double") / n).alias("unemp"),
        F.when((day + F.month("dt")) % 6 != 0, F.col("f").cast("double") / n).alias("ffr"),
        (F.col("s").cast("double") / n - 5).alias("spread"),
        "oil", "conf",
        F.when(day % 11 != 0, F.col("t").cast("double") / n).alias("ted"),
    )


def market(spark: SparkSession, sf: str) -> DataFrame:
    first = F.col("l_linenumber") == 1
    base = (
        read_table(spark, sf, "lineitem")
        .groupBy(F.to_date("l_shipdate").alias("dt"))
        .agg(
            F.count("*").alias("n"),
            F.sum(_cents("l_extendedprice")).cast("double").alias("cents"),
            F.sum(F.when(first, F.col("l_quantity").cast("long")).otherwise(0)).alias("q1"),
            F.count(F.when(first, 1)).alias("n1"),
        )
    )
    return base.select(
        "dt",
        F.when(F.col("n1") != 0, F.col("q1").cast("double") / F.col("n1")).alias("vix"),
        F.when(F.day("dt") % 13 != 0, F.col("cents") / F.col("n") / 10000).alias("idx"),
    )


def runs(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "events").select(
        F.col("event_type").alias("step"), F.col("ts").alias("run_ts"), F.col("value").alias("duration_s"),
        (F.col("event_id") % 10 != 0).alias("success"), "event_id",
    )


def raw_prices(spark: SparkSession, sf: str) -> DataFrame:
    p = prices(spark, sf)
    newer = p.filter(F.day("dt") == 1).withColumns({
        "price": F.when(F.col("entity") % 2 != 0, F.col("price") * 1.5),
        "volume": F.col("volume") + 1,
    })
    return p.withColumn("_ord", F.lit(0)).unionByName(newer.withColumn("_ord", F.lit(1)))


def spiked(spark: SparkSession, sf: str) -> DataFrame:
    inf = float("inf")
    key = (F.col("volume") + F.col("entity")) % 50
    return prices(spark, sf).select(
        "entity", "grp", "dt", "volume",
        F.when(key == 7, F.lit(inf)).when(key == 9, F.lit(-inf)).otherwise(F.col("price")).alias("price"),
        F.when(F.col("volume") % 40 == 3, F.lit(inf)).otherwise(F.col("high")).alias("high"),
        "low",
    )


Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    """Queries and their SQL twins, filled by the catalog modules."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None, *views: str):
        def register(fn: Query) -> Query:
            if name in self.queries:
                raise ValueError(f"duplicate query {name}")
            self.queries[name] = fn
            if sql is not None:
                self.sql[name] = oracle(sql, *views)
            return fn

        return register


def single(c):
    """The value at single precision: equal on both engines although they sum in another order."""
    col = F.col(c) if isinstance(c, str) else c
    return col.cast("float").cast("double")


def show(df: DataFrame, *columns: str, **rules: int) -> DataFrame:
    """Select for comparison: names in ``rules`` are rounded (n digits) or, with -1, cut to single precision."""
    picked = [F.col(c) for c in columns]
    for name, digits in rules.items():
        picked.append((single(name) if digits < 0 else F.round(name, digits)).alias(name))
    return df.select(*picked)
