"""Expectation suites, layered checks, remediation, checkpoints and alerts."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import REGISTRY
from catalog.audit import CURRENT, FEATURES, KS_SQL, REFERENCE, SEVERITY, _features, _jumps, _narrow, _ruled
from catalog.merging import CTX
from catalog.views import ENTITY, macro, market, prices, raw_prices, read_table, runs, show, spiked, statements
from pitpanel import Panel
from pitpanel.operators import checks, drift, expectations as ex, merge, outliers, profile
from pitpanel.plans import suites
from pitpanel.session import stable

q = REGISTRY.add


def suite_sql(suite: list[ex.Expectation], table: str, columns: dict[str, str], n_columns: int, name: str, types: dict[str, str] = {},
              other: str | None = None) -> str:
    """The SQL twin of a suite: one SELECT per expectation. ``columns`` maps suite names to SQL expressions."""
    parts = []
    for i, e in enumerate(suite):
        have = (e.column is None or e.column in columns) and all(c in columns for c in e.columns)
        c = columns.get(e.column)
        low = "" if e.low is None else f" AND v >= {e.low!r}"
        high = "" if e.high is None else f" AND v <= {e.high!r}"
        if e.kind == "column_to_exist":
            value, ok = f"{1.0 if have else 0.0}", "v = 1"
        elif e.kind == "values_to_be_of_type":
            value, ok = f"{1.0 if have and types.get(e.column) == e.type_name else 0.0}", "v = 1"
        elif e.kind == "column_count_to_be_between":
            value, ok = f"{n_columns}", f"true{low}{high}"
        elif not have:
            value, ok = "NULL", "false"
        elif e.kind == "values_to_not_be_null":
            value, ok = f"count({c}) * 1.0::DOUBLE / count(*)", f"v >= {e.mostly}"
        elif e.kind == "values_to_be_between":
            cond = " AND ".join(f"{c} {o} {b!r}" for o, b in ((">=", e.low), ("<=", e.high)) if b is not None)
            value, ok = f"coalesce(count(*) FILTER ({cond}) * 1.0::DOUBLE / nullif(count({c}), 0), 1)", f"v >= {e.mostly}"
        elif e.kind == "values_to_be_in_set":
            inside = ", ".join(repr(x) for x in e.values)
            value, ok = f"coalesce(count(*) FILTER ({c} IN ({inside})) * 1.0::DOUBLE / nullif(count({c}), 0), 1)", f"v >= {e.mostly}"
        elif e.kind == "values_to_be_unique":
            value, ok = f"(SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM {table} WHERE {c} IS NOT NULL GROUP BY {c}) WHERE n > 1)", "v = 0"
        elif e.kind == "compound_columns_to_be_unique":
            keys = ", ".join(columns[k] for k in e.columns)
            value, ok = f"(SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM {table} GROUP BY {keys}) WHERE n > 1)", "v = 0"
        elif e.kind == "unique_value_count_to_be_between":
            value, ok = f"count(DISTINCT {c})", f"true{low}{high}"
        elif e.kind == "mean_to_be_between":
            value, ok = f"avg({c})", f"true{low}{high}"
        elif e.kind == "stdev_to_be_between":
            value, ok = f"stddev_samp({c})", f"true{low}{high}"
        elif e.kind == "max_to_be_between":
            bounds = f"DATE '1970-01-01' + CAST(v AS INTEGER) BETWEEN DATE '{e.low}' AND DATE '{e.high}'"
            value, ok = f"max({c}) - DATE '1970-01-01'", bounds
        elif e.kind == "row_count_to_be_between":
            value, ok = "count(*)", f"true{low}{high}"
        else:
            value, ok = "count(*)", f"v = (SELECT count(*) FROM {other})"
        sev = ("CRITICAL" if e.kind in ("column_to_exist", "values_to_be_of_type") or (e.kind == "values_to_not_be_null" and e.column in ex.KEY_COLUMNS) else "ERROR")
        parts.append(f"SELECT '{name}' AS suite, {i} AS position, '{e.kind}' AS expectation, '{e.target}' AS \"column\", '{sev}' AS severity, "
                     f"round(v, 6) AS observed, coalesce({ok}, false) AS success FROM (SELECT CAST({value} AS DOUBLE) AS v FROM {table})")
        if value.replace(".", "").isdigit() or value == "NULL":
            parts[-1] = parts[-1].replace(f" FROM {table})", f" FROM (SELECT count(*) FROM {table}))")
    # a scalar subquery in the select list of an ungrouped table would repeat per row
    parts = [p.replace(f" AS v FROM {table})", " AS v)") if "AS v FROM" in p and "AS DOUBLE) AS v" in p and "CAST((SELECT" in p else p for p in parts]
    return "\nUNION ALL ".join(parts)


COMPANY = {"Date": "dt", "Company": "entity", "Sector": "grp", "Stock_Price": "price", "Volume": "volume", "Close": "high", "Open": "low", "Company_Name": "entity_name"}
STATEMENT = {"Date": "dt", "Company": "entity", "Revenue": "revenue", "Net_Income": "net_income", "Total_Equity": "equity", "Total_Assets": "assets", "Long_Debt": "long_debt", "Total_Debt": "short_debt", "Cash": "cash", "Total_Liabilities": "liabilities"}
MACRO_N = {"Date": "dt", "GDP": "gdp", "CPI": "cpi", "Unemployment_Rate": "unemp", "Federal_Funds_Rate": "ffr", "Yield_Curve_Spread": "spread", "Oil_Price": "oil", "Consumer_Confidence": "conf", "TED_Spread": "ted"}
MARKET_N = {"Date": "dt", "VIX": "vix", "SP500": "idx"}
MARKET_C = {"Date": "dt", "VIX": "vix", "SP500_Close": "idx"}


def named(df, names):
    return df.select(*[F.col(v).alias(k) for k, v in names.items()])


def observed(df):
    return df.withColumn("observed", F.round("observed", 6))


PRICE_SUITE = [
    *ex.exist("Date", "Company", "Open_Interest"), *ex.between("Stock_Price", 900, 2500, 0.99), *ex.between("Volume", 1, None),
    *ex.not_null("Stock_Price", mostly=0.9), *ex.not_null("Company"), *ex.unique_together("Date", "Company"), *ex.unique("Date"),
    *ex.distinct_between("Company", 2, 50), *ex.in_set("Sector", ("ASIA", "EUROPE", "AFRICA"), 0.5), *ex.of_type("Stock_Price", "double"),
    *ex.of_type("Volume", "double"), *ex.rows_between(1000, 10_000_000), *ex.columns_between(5, 8), *ex.mean_between("Volume", 10, 40),
    *ex.stdev_between("Stock_Price", 0.01, None), *ex.max_between("Date", "2001-01-01", "2002-12-31"), *ex.rows_equal_other(),
]
TYPES = {"Stock_Price": "double", "Volume": "bigint"}
PRICE_SQL = suite_sql(PRICE_SUITE, "prices", COMPANY, len(COMPANY), "prices", TYPES, "raw_prices")


def _price_results(spark, sf):
    return ex.evaluate(named(prices(spark, sf), COMPANY), PRICE_SUITE, "prices", other=raw_prices(spark, sf))


@q("expectation_suite", PRICE_SQL, "prices", "raw_prices")
def _(spark, sf):
    return observed(_price_results(spark, sf))


SUMMARY_COLS = """count(*) AS evaluated, count(*) FILTER (success) AS successful, count(*) FILTER (NOT success) AS failed,
   count(*) FILTER (success) * 100.0::DOUBLE / count(*) AS success_pct, count(*) FILTER (NOT success AND severity = 'CRITICAL') AS critical_failures,
   count(*) FILTER (NOT success AND severity = 'ERROR') AS error_failures, count(*) FILTER (NOT success AND severity = 'WARNING') AS warning_failures"""


@q("expectation_summary", f"SELECT suite, {SUMMARY_COLS} FROM ({PRICE_SQL}) GROUP BY suite", "prices", "raw_prices")
def _(spark, sf):
    return ex.summarize(_price_results(spark, sf))


@q("expectation_severity", f"SELECT severity, count(*) AS n, count(*) FILTER (NOT success) AS failed FROM ({PRICE_SQL}) GROUP BY severity", "prices", "raw_prices")
def _(spark, sf):
    r = _price_results(spark, sf)
    return r.groupBy("severity").agg(F.count("*").alias("n"), F.count(F.when(~F.col("success"), 1)).alias("failed"))


@q("severity_gate", f"SELECT suite, count(*) FILTER (NOT success AND severity = 'CRITICAL') AS blocking_failures, count(*) FILTER (NOT success AND severity = 'CRITICAL') = 0 AS passed FROM ({PRICE_SQL}) GROUP BY suite", "prices", "raw_prices")
def _(spark, sf):
    return ex.gate(_price_results(spark, sf), "CRITICAL")


MACRO_SUITES = {"first_macro": suites.FIRST_MACRO, "raw_macro": suites.RAW_MACRO, "clean_macro_short": suites.CLEAN_MACRO_SHORT, "clean_macro": suites.CLEAN_MACRO}
MACRO_TYPES = {c: "double" for c in MACRO_N}


@q("standard_suites_macro", "\nUNION ALL ".join(suite_sql(s, "macro", MACRO_N, len(MACRO_N), n, MACRO_TYPES, "macro") for n, s in MACRO_SUITES.items())
   + "\nUNION ALL " + "\nUNION ALL ".join(suite_sql(s, "market", names, 3, n) for n, s, names in (
       ("first_market", suites.FIRST_MARKET, MARKET_N), ("raw_market", suites.RAW_MARKET, MARKET_N), ("clean_market", suites.CLEAN_MARKET, MARKET_C))), "macro", "market")
def _(spark, sf):
    m = named(macro(spark, sf), MACRO_N)
    parts = [ex.evaluate_all(m, MACRO_SUITES, other=m)]
    raw, clean = named(market(spark, sf), MARKET_N), named(market(spark, sf), MARKET_C)
    parts += [ex.evaluate_all(raw, {"first_market": suites.FIRST_MARKET, "raw_market": suites.RAW_MARKET}),
              ex.evaluate(clean, suites.CLEAN_MARKET, "clean_market")]
    return observed(merge.union_all(parts))


COMPANY_SUITES = {"first_company": suites.FIRST_COMPANY, "raw_prices": suites.RAW_PRICES, "clean_prices": suites.CLEAN_PRICES}


@q("standard_suites_prices", "\nUNION ALL ".join(suite_sql(s, "prices", COMPANY, len(COMPANY), n, TYPES) for n, s in COMPANY_SUITES.items()), "prices")
def _(spark, sf):
    p = named(prices(spark, sf), COMPANY)
    return observed(ex.evaluate_all(p, COMPANY_SUITES))


STATEMENT_SUITES = {"raw_balance": suites.RAW_BALANCE, "raw_income": suites.RAW_INCOME, "clean_balance": suites.CLEAN_BALANCE, "clean_income": suites.CLEAN_INCOME}


@q("standard_suites_statements", "\nUNION ALL ".join(suite_sql(s, "statements", STATEMENT, len(STATEMENT), n) for n, s in STATEMENT_SUITES.items()), "statements")
def _(spark, sf):
    st = named(statements(spark, sf), STATEMENT)
    return observed(ex.evaluate_all(st, STATEMENT_SUITES))


MERGED_N = {"Date": "dt", "Company": "name", "Sector": "grp", "Stock_Price": "price", "GDP": "gdp", "CPI": "cpi", "Unemployment_Rate": "unemp", "VIX": "vix", "SP500_Close": "idx", "Federal_Funds_Rate": "ffr"}
MERGED_SQL = """j AS (SELECT p.dt, entity_name AS name, grp, price, gdp, cpi, unemp, vix, idx, ffr FROM prices p LEFT JOIN macro m ON p.dt = m.dt LEFT JOIN market k ON p.dt = k.dt)"""
COMPANIES = ("Supplier#000000001", "Supplier#000000002")
MERGED_SUITES = {"merged_panel": suites.merged_panel(COMPANIES), "clean_merged_panel": suites.CLEAN_MERGED_PANEL}
MERGED_MACRO_SUITES = {"merged_macro": suites.merged_macro("2001-01-01", "2003-01-01"), "clean_merged_macro": suites.CLEAN_MERGED_MACRO}
MM_N = {k: v for k, v in MERGED_N.items() if k not in ("Company", "Sector", "Stock_Price")}


def _merged(spark, sf):
    context = merge.add_context(prices(spark, sf).select("dt", F.col("entity_name").alias("name"), "grp", "price"), macro(spark, sf), "dt")
    return named(merge.add_context(context, market(spark, sf), "dt"), MERGED_N)


@q("standard_suites_merged", f"WITH {MERGED_SQL}, {CTX.replace('j AS', 'mm AS')} " + "\nUNION ALL ".join(
    [suite_sql(s, "j", MERGED_N, len(MERGED_N), n) for n, s in MERGED_SUITES.items()]
    + [suite_sql(s, "mm", MM_N, len(MM_N), n) for n, s in MERGED_MACRO_SUITES.items()]), "prices", "macro", "market")
def _(spark, sf):
    panel = _merged(spark, sf)
    mm = named(merge.add_context(macro(spark, sf), market(spark, sf), "dt"), MM_N)
    return observed(ex.evaluate_all(panel, MERGED_SUITES).unionByName(ex.evaluate_all(mm, MERGED_MACRO_SUITES)))


# --- layered checks ----------------------------------------------------------------------------

BROKEN_N = {"Date": "dt", "Company": "entity", "Stock_Price": "price", "Close": "high", "Volume": "volume"}
RULES = checks.DatasetRules(("Date", "Company", "Sector"), ("Date", "Company", "Stock_Price"), {"Stock_Price": (900.0, 2000.0), "Volume": (1.0, 100.0)})
PANEL = Panel(("Company",), "Date")


def _broken(spark, sf):
    """Prices with infinities, duplicate rows, an all-null column and a text date."""
    s = named(spiked(spark, sf), BROKEN_N)
    s = s.unionByName(s.filter(F.day("Date") == 1))
    return s.withColumn("Empty", F.lit(None).cast("double"))


BROKEN = """x AS (SELECT dt, entity, price, high, volume, CAST(NULL AS DOUBLE) AS empty FROM spiked UNION ALL
   SELECT dt, entity, price, high, volume, NULL FROM spiked WHERE day(dt) = 1)"""


def issue(severity: str, check: str, column: str | None, affected: str, value: str, fixable: bool, when: str, table: str = "x") -> str:
    col = "CAST(NULL AS VARCHAR)" if column is None else f"'{column}'"
    return (f"SELECT 'panel' AS dataset, '{severity}' AS severity, '{check}' AS check_name, {col} AS \"column\", CAST(a AS BIGINT) AS affected_rows, "
            f"round(CAST(v AS DOUBLE), 6) AS value, {str(fixable).lower()} AS auto_fixable FROM (SELECT {affected} AS a, {value} AS v FROM {table}) WHERE {when}")


INF = "count(*) FILTER (abs({0}) = 'Infinity'::DOUBLE)"
CRITICAL_SQL = "\nUNION ALL ".join([
    issue("CRITICAL", "required columns exist", "Sector", "count(*)", "NULL", False, "a > 0"),
    issue("CRITICAL", "no null columns", "Empty", "count(*)", "NULL", True, "a > 0"),
    *[issue("CRITICAL", "no inf values", c, INF.format(e), INF.format(e), True, "a > 0") for c, e in (("Stock_Price", "price"), ("Close", "high"))],
])
DUP = "(SELECT sum(n) FROM (SELECT count(*) AS n FROM x GROUP BY entity, dt) WHERE n > 1)"
ERROR_SQL = "\nUNION ALL ".join([
    issue("ERROR", "no duplicate rows", None, DUP, DUP, True, "a > 0").replace(" AS v FROM x)", " AS v)"),
    issue("ERROR", "key column completeness", "Stock_Price", "count(*) - count(price)", "(count(*) - count(price)) * 100.0 / count(*)", True, "v > 5"),
    *[issue("ERROR", "value range", c, n, n, True, "a > 0") for c, n in (
        ("Stock_Price", "count(*) FILTER (price < 900 OR price > 2000)"), ("Volume", "count(*) FILTER (volume < 1 OR volume > 100)"))],
])


def rounded(df):
    return df.withColumn("value", F.round("value", 6))


@q("robust_critical", f"WITH {BROKEN} {CRITICAL_SQL}", "spiked")
def _(spark, sf):
    return rounded(checks.critical(_broken(spark, sf), "panel", RULES))


@q("robust_error", f"WITH {BROKEN} {ERROR_SQL}", "spiked")
def _(spark, sf):
    return rounded(checks.errors(_broken(spark, sf), "panel", RULES, PANEL))


LI = {"l_quantity": "l_quantity", "l_extendedprice": "l_extendedprice", "tail": "CASE WHEN l_orderkey % 50 = 0 THEN l_quantity * 1000 WHEN l_orderkey % 3 = 0 THEN NULL ELSE l_quantity END"}
LI_ROWS = "z AS (SELECT " + ", ".join(f"{e} AS {n}" for n, e in LI.items()) + " FROM lineitem)"


def _tailed(spark, sf):
    tail = F.when(F.col("l_orderkey") % 50 == 0, F.col("l_quantity") * 1000).when(F.col("l_orderkey") % 3 != 0, F.col("l_quantity"))
    return read_table(spark, sf, "lineitem").select("l_quantity", "l_extendedprice", tail.alias("tail"))


WARNING_SQL = "\nUNION ALL ".join(
    [issue("WARNING", "missing values", c, f"count(*) - count({c})", f"(count(*) - count({c})) * 100.0 / count(*)", False, "v > 20", "z") for c in LI]
    + [issue("WARNING", "outliers", c, f"count(*) FILTER ({c} < a - 3 * (b - a) OR {c} > b + 3 * (b - a))", f"count(*) FILTER ({c} < a - 3 * (b - a) OR {c} > b + 3 * (b - a)) * 100.0 / count(*)", False, "v > 1",
             f"z, (SELECT quantile_cont({c}, 0.25) AS a, quantile_cont({c}, 0.75) AS b FROM z) edge").replace("{c} < a", f"{c} < edge.a") for c in LI])
WARNING_SQL = WARNING_SQL.replace("< a - 3 * (b - a)", "< edge.a - 3 * (edge.b - edge.a)").replace("> b + 3 * (b - a)", "> edge.b + 3 * (edge.b - edge.a)")


@q("robust_warning", f"WITH {LI_ROWS} {WARNING_SQL}")
def _(spark, sf):
    return rounded(checks.warnings(_tailed(spark, sf), "panel", checks.DatasetRules((), (), {})))


@q("robust_info", f"""WITH {BROKEN} {issue("INFO", "dataset size", None, "count(*)", "6", False, "true")} UNION ALL {issue("INFO", "date range", "Date", "count(*)", "max(dt) - min(dt)", False, "true")}""", "spiked")
def _(spark, sf):
    return rounded(checks.info(_broken(spark, sf), "panel", "Date"))


@q("temporal_warnings", """SELECT 'panel' AS dataset, 'WARNING' AS severity, 'date gap' AS check_name, CAST(entity AS VARCHAR) AS "column", CAST(NULL AS BIGINT) AS affected_rows,
   CAST(max(gap) AS DOUBLE) AS value, false AS auto_fixable FROM (SELECT entity, dt - lag(dt) OVER (PARTITION BY entity ORDER BY dt) AS gap FROM prices) GROUP BY entity HAVING max(gap) > 7""", "prices")
def _(spark, sf):
    p = prices(spark, sf)
    return checks.date_gaps(p, "panel", ENTITY, 7)


@q("business_check", """SELECT 'panel' AS dataset, 'WARNING' AS severity, 'business rule: leverage' AS check_name, 'ratio' AS "column", count(*) AS affected_rows, CAST(count(*) AS DOUBLE) AS value, false AS auto_fixable
   FROM statements WHERE long_debt / nullif(liabilities, 0) > 10 HAVING count(*) > 0""", "statements")
def _(spark, sf):
    st = statements(spark, sf).withColumn("ratio", F.try_divide("long_debt", "liabilities"))
    return checks.business(st, "panel", "ratio", 10.0)


@q("auto_remediate", """SELECT dt AS "Date", entity AS "Company", CASE WHEN abs(price) = 'Infinity'::DOUBLE THEN NULL ELSE price END AS "Stock_Price",
   CASE WHEN abs(high) = 'Infinity'::DOUBLE THEN NULL ELSE high END AS "Close", volume AS "Volume" FROM spiked""", "spiked")
def _(spark, sf):
    df = _broken(spark, sf)
    text = df.withColumn("Date", F.col("Date").cast("string"))
    issues = checks.critical(text, "panel", RULES).unionByName(checks.errors(text, "panel", RULES, PANEL))
    return checks.remediate(text, issues, PANEL)[0]


ISSUES_SQL = f"{CRITICAL_SQL}\nUNION ALL {ERROR_SQL}"


def _issues(spark, sf):
    df = _broken(spark, sf)
    return checks.critical(df, "panel", RULES).unionByName(checks.errors(df, "panel", RULES, PANEL))


COUNTS = "SELECT dataset, " + ", ".join(f"count(*) FILTER (severity = '{s}') AS {s.lower()}" for s in ex.SEVERITIES) + ", count(*) FILTER (severity = 'CRITICAL') = 0 AS passed FROM i GROUP BY dataset"


@q("remediation_log", f"WITH {BROKEN}, i AS ({ISSUES_SQL}) SELECT check_name, \"column\", severity, check_name IN ('no null columns', 'no inf values', 'no duplicate rows') AS fix_applied FROM i", "spiked")
def _(spark, sf):
    log = checks.remediate(_broken(spark, sf), _issues(spark, sf), PANEL)[1]
    return log.select("check_name", "column", "severity", "fix_applied")


@q("issue_counts", f"WITH {BROKEN}, i AS ({ISSUES_SQL}) {COUNTS}", "spiked")
def _(spark, sf):
    return checks.issue_counts(_issues(spark, sf))


POST_COLS = ["entity", "grp", "dt", "volume", "price", "high", "low", "fixed", "gdp_macro"]
POST = "y AS (SELECT s.*, 1.0::DOUBLE AS fixed, m.gdp AS gdp_macro FROM spiked s LEFT JOIN macro m ON s.dt = m.dt)"
MISSING = " + ".join(f"count(*) - count({c})" for c in POST_COLS)
POST_SQL = "\nUNION ALL ".join([
    issue("CRITICAL", "no inf values", None, f"{INF.format('price')} + {INF.format('high')}", f"{INF.format('price')} + {INF.format('high')}", False, "a > 0", "y"),
    issue("CRITICAL", "no duplicate columns", None, "NULL", "1 + 0 * count(*)", False, "v > 0", "y"),
    issue("ERROR", "missing values", None, MISSING, f"({MISSING}) * 100.0 / (count(*) * 9)", False, "v > 2", "y"),
    issue("WARNING", "missing values", None, MISSING, f"({MISSING}) * 100.0 / (count(*) * 9)", False, "v > 1 AND v <= 2", "y"),
    issue("WARNING", "no constant columns", None, "NULL", "1 + 0 * count(*)", False, "v > 0", "y"),
])


def _post(spark, sf):
    s = spiked(spark, sf).withColumn("fixed", F.lit(1.0))
    return merge.add_context(s, macro(spark, sf).select("dt", F.col("gdp").alias("gdp_macro")), "dt")


@q("post_clean_checks", f"WITH {POST} {POST_SQL}", "spiked", "macro")
def _(spark, sf):
    return rounded(checks.post_clean(_post(spark, sf), "panel", ["entity", "dt"]))


VERDICT = f"""{BROKEN}, {POST}, i AS ({ISSUES_SQL}), pc AS ({POST_SQL}), e AS ({PRICE_SQL})"""


@q("checkpoint_verdict", f"""WITH {VERDICT}, r AS (SELECT (SELECT count(*) FROM i WHERE severity = 'CRITICAL') = 0 AS c, (SELECT count(*) FROM e WHERE NOT success AND severity IN ('CRITICAL', 'ERROR')) = 0 AS x,
   (SELECT count(*) FROM pc WHERE severity = 'CRITICAL') = 0 AS p) SELECT 'panel' AS dataset, c AS checks_passed, x AS expectations_passed, p AS post_clean_passed, c AND x AND p AS passed FROM r""", "spiked", "macro", "raw_prices")
def _(spark, sf):
    gates = ex.gate(stable(_price_results(spark, sf)), "ERROR").withColumn("suite", F.lit("panel"))
    post = checks.issue_counts(checks.post_clean(_post(spark, sf), "panel", ["entity", "dt"]))
    return checks.checkpoint_verdict(gates, checks.issue_counts(stable(_issues(spark, sf))), post)


@q("checkpoint_summary", f"""WITH {BROKEN}, i AS ({ISSUES_SQL}), e AS ({PRICE_SQL}), s AS (SELECT {SUMMARY_COLS} FROM e)
   SELECT 'panel' AS dataset, (SELECT count(*) FROM i WHERE severity = 'CRITICAL') = 0 AND critical_failures = 0 AS passed, evaluated, failed, success_pct,
   (SELECT count(*) FROM i WHERE severity = 'CRITICAL') AS critical, (SELECT count(*) FROM i WHERE severity = 'ERROR') AS error, (SELECT count(*) FROM i WHERE severity = 'WARNING') AS warning FROM s""", "spiked", "raw_prices")
def _(spark, sf):
    # reports have a few rows for each check; written once, they serve verdict and summary
    results = stable(_price_results(spark, sf).withColumn("suite", F.lit("panel")))
    counts = checks.issue_counts(stable(_issues(spark, sf)))
    verdict = checks.checkpoint_verdict(ex.gate(results, "CRITICAL"), counts)
    return checks.checkpoint_summary(ex.summarize(results), verdict, counts)


@q("metrics_history", """SELECT step, run_ts, event_id, duration_s FROM runs WHERE event_id % 5 <> 0
   UNION ALL SELECT step, run_ts, event_id, CAST(NULL AS DOUBLE) FROM runs WHERE event_id % 5 = 0""", "runs")
def _(spark, sf):
    every = runs(spark, sf).select("step", "run_ts", "event_id", "duration_s")
    return checks.append_history(every.where("event_id % 5 <> 0"), every.where("event_id % 5 = 0").drop("duration_s"))


@q("recent_runs", """SELECT step, run_ts, event_id, duration_s FROM runs QUALIFY row_number() OVER (PARTITION BY step ORDER BY run_ts DESC, event_id DESC) <= 100""", "runs")
def _(spark, sf):
    return checks.recent_runs(runs(spark, sf), ["step"], ["run_ts", "event_id"], 100).select("step", "run_ts", "event_id", "duration_s")


@q("alert_conditions", """
WITH s AS (SELECT step, count(*) FILTER (success) * 100.0::DOUBLE / count(*) AS rate, max(duration_s) AS longest FROM runs GROUP BY step),
crowd AS (SELECT count(*) AS n FROM prices WHERE volume > 40)
SELECT 'low success rate' AS alert, step AS subject, rate AS value FROM s WHERE rate < 90 UNION ALL SELECT 'slow step', step, longest FROM s WHERE longest > 60
UNION ALL SELECT 'critical anomaly', 'audit', CAST(n AS DOUBLE) FROM crowd WHERE n > 0 UNION ALL SELECT 'many critical anomalies', 'audit', CAST(n AS DOUBLE) FROM crowd WHERE n > 10
UNION ALL SELECT 'many drifted features', 'drift', CAST(n AS DOUBLE) FROM (SELECT count(*) AS n FROM ks JOIN m ON ks.feature = m.feature WHERE SEVERITY = 'HIGH') WHERE n > 0""".replace("SEVERITY", SEVERITY).replace("WITH s AS", f"WITH {KS_SQL}, s AS"), "runs", "prices")
def _(spark, sf):
    summary = profile.run_metrics_summary(runs(spark, sf), order=("run_ts", "event_id"))
    crowded = outliers.rule_report(prices(spark, sf), [outliers.Rule("volume", None, 40.0, "CRITICAL", "volume_flag", "volume at most 40")])
    total = crowded.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("n")).scalar()
    report = drift.drift_report(_features(spark, sf), "dt", list(FEATURES), REFERENCE, CURRENT)
    high = report.agg(F.count(F.when(F.col("severity") == "HIGH", 1)).alias("n")).scalar()
    return checks.alert_conditions(summary, total, high, max_seconds=60.0, max_high_drift=0)
