"""Sinks and readers: a table is written to the shared folder, read back typed and compared with its source."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from catalog import REGISTRY
from catalog.views import read_table, show
from pitpanel.session import shared_path
from pitpanel.sources import readers, sinks

q = REGISTRY.add

ORDERS = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate date"


def _orders(spark, sf):
    o = read_table(spark, sf, "orders")
    return o.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.to_date("o_orderdate").alias("o_orderdate"))


PLAIN = "SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 2) AS o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders"


@q("csv_round_trip", PLAIN)
def _(spark, sf):
    path = shared_path(spark, "csv")
    sinks.write_csv(_orders(spark, sf), path, order=["o_orderdate", "o_orderkey"])
    return show(readers.read_csv(spark, path, ORDERS, dates=["o_orderdate"]), "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", o_totalprice=2)


@q("csv_bad_values", """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS o_orderdate,
   CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE round(o_totalprice, 2) END AS o_totalprice FROM orders""")
def _(spark, sf):
    path = shared_path(spark, "csv")
    damaged = _orders(spark, sf).select(
        "o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, "n/a").otherwise(F.col("o_orderdate").cast("string")).alias("o_orderdate"),
        F.when(F.col("o_orderkey") % 4 == 0, "NaN").otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"))
    sinks.write_csv(damaged, path)
    back = readers.read_csv(spark, path, "o_orderkey bigint, o_orderdate date, o_totalprice double", dates=["o_orderdate"])
    return show(back, "o_orderkey", "o_orderdate", o_totalprice=2)


@q("parquet_round_trip", PLAIN)
def _(spark, sf):
    path = shared_path(spark, "parquet")
    sinks.write_parquet(_orders(spark, sf), path, partition_by=["o_orderstatus"], order=["o_orderstatus", "o_orderkey"])
    return show(spark.read.parquet(path), "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", o_totalprice=2)


@q("json_report_round_trip", """SELECT r.run AS run_ts, o_orderstatus AS value, count(*) AS n FROM orders, (VALUES ('2024-01-01'), ('2024-01-02')) r(run) GROUP BY ALL""")
def _(spark, sf):
    path = shared_path(spark, "report")
    report = _orders(spark, sf).groupBy(F.col("o_orderstatus").alias("value")).agg(F.count("*").alias("n"))
    for run in ("2024-01-01", "2024-01-02"):
        sinks.write_report(report, path, run)
    back = spark.read.schema("value string, n bigint, run_ts string").json(path)
    return back.select("run_ts", "value", "n")


@q("sorted_sink", """WITH s AS (SELECT o_orderkey, lag(o_orderkey) OVER (ORDER BY o_orderkey) AS earlier FROM orders) SELECT count(*) AS n, count(earlier) AS steps, CAST(0 AS BIGINT) AS out_of_order FROM s""")
def _(spark, sf):
    """Rows within each written file ascend, and so do the files."""
    path = shared_path(spark, "sorted")
    sinks.write_parquet(_orders(spark, sf), path, order=["o_orderkey"])
    files = spark.read.parquet(path).groupBy(F.input_file_name().alias("file")).agg(F.count("*").alias("n"), F.min("o_orderkey").alias("low"), F.max("o_orderkey").alias("high"))
    ordered = files.withColumn("before", F.lag("high").over(Window.orderBy("file")))
    return ordered.agg(F.sum("n").alias("n"), (F.sum("n") - 1).alias("steps"), F.count(F.when(F.col("low") < F.col("before"), 1)).alias("out_of_order"))
