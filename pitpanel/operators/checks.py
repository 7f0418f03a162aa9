"""Layered checks. Every check yields issue rows; each layer is one pass over the table.

Issue columns: dataset, severity, check_name, column, affected_rows, value, auto_fixable.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitpanel.functions.columns import existing, fractional, is_inf, missing, numeric_columns, ratio
from pitpanel.operators import dedupe, hygiene, outliers, windows
from pitpanel.operators.expectations import SEVERITIES
from pitpanel.operators.merge import MERGE_SUFFIXES, union_all
from pitpanel.panel import Panel

ISSUE = "dataset string, severity string, check_name string, column string, affected_rows bigint, value double, auto_fixable boolean"


@dataclass(frozen=True)
class DatasetRules:
    """What a dataset must contain and which values it may hold."""

    required: tuple[str, ...] = ("Date",)
    keys: tuple[str, ...] = ("Date",)
    ranges: Mapping[str, tuple[float, float]] = field(default_factory=dict)


# fixed values: ranges, and required and key columns by a part of the dataset name (first match wins)
RANGES = {
    "GDP": (5000.0, 35000.0), "CPI": (150.0, 400.0), "Unemployment_Rate": (0.0, 30.0), "Federal_Funds_Rate": (-5.0, 25.0),
    "VIX": (5.0, 100.0), "SP500": (500.0, 10000.0), "Stock_Price": (0.01, 1000.0), "Close": (0.01, 1000.0),
}
REQUIRED = (("macro", ("Date", "GDP", "CPI")), ("market", ("Date", "VIX")), ("company", ("Date", "Company")), ("merged", ("Date", "Company")))
KEYS = (
    ("macro", ("Date", "GDP", "CPI", "Unemployment_Rate")), ("market", ("Date", "VIX", "SP500")),
    ("price", ("Date", "Company", "Close", "Stock_Price")), ("balance", ("Date", "Company", "Total_Assets")),
    ("income", ("Date", "Company", "Revenue")),
)


def rules_for(dataset: str, ranges: Mapping[str, tuple[float, float]] = RANGES) -> DatasetRules:
    def pick(table) -> tuple[str, ...]:
        return next((cols for part, cols in table if part in dataset.lower()), ("Date",))

    return DatasetRules(pick(REQUIRED), pick(KEYS), ranges)


def _issue(severity: str, check: str, column: str | None, affected: Column, value: Column, fixable: bool, when: Column) -> Column:
    row = F.struct(
        F.lit(severity).alias("severity"), F.lit(check).alias("check_name"), F.lit(column).cast("string").alias("column"),
        affected.cast("long").alias("affected_rows"), value.cast("double").alias("value"), F.lit(fixable).alias("auto_fixable"))
    return F.when(F.coalesce(when, F.lit(False)), row)


def _issues(agg: DataFrame, dataset: str, cells: Sequence[Column]) -> DataFrame:
    return agg.select(F.explode(F.array_compact(F.array(*cells))).alias("_i")).select(F.lit(dataset).alias("dataset"), "_i.*")


def _no_issues(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([], ISSUE)


def critical(df: DataFrame, dataset: str, rules: DatasetRules, date: str = "Date") -> DataFrame:
    """Empty table, missing required columns, date type, all-null columns, infinite values."""
    floats = [c for c in numeric_columns(df) if fractional(df, c)]
    agg = df.agg(
        F.count("*").alias("_n"),
        *[F.count(F.when(~missing(F.col(c), fractional(df, c)), 1)).alias(f"k_{c}") for c in df.columns],
        *[F.sum(is_inf(F.col(c)).cast("long")).alias(f"i_{c}") for c in floats],
    )
    n = F.col("_n")
    cells = [_issue("CRITICAL", "table not empty", None, n, n, False, n == 0)]
    cells += [_issue("CRITICAL", "required columns exist", c, n, F.lit(None), False, n > 0) for c in rules.required if c not in df.columns]
    if date in df.columns and not isinstance(df.schema[date].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        cells.append(_issue("CRITICAL", "date column type", date, n, F.lit(None), True, n > 0))
    cells += [_issue("CRITICAL", "no null columns", c, n, F.lit(None), True, (n > 0) & (F.col(f"k_{c}") == 0)) for c in df.columns]
    cells += [_issue("CRITICAL", "no inf values", c, F.col(f"i_{c}"), F.col(f"i_{c}"), True, F.col(f"i_{c}") > 0) for c in floats]
    return _issues(agg, dataset, cells)


def errors(df: DataFrame, dataset: str, rules: DatasetRules, panel: Panel, null_limit_pct: float = 5.0) -> DataFrame:
    """Duplicate keys (all members), nulls in key columns, values out of range."""
    keys, ranged = existing(df, rules.keys), existing(df, rules.ranges)
    agg = df.agg(
        F.count("*").alias("_n"),
        *[F.sum(missing(F.col(c), fractional(df, c)).cast("long")).alias(f"m_{c}") for c in keys],
        *[F.count(F.when((F.col(c) < rules.ranges[c][0]) | (F.col(c) > rules.ranges[c][1]), 1)).alias(f"r_{c}") for c in ranged],
    )
    cells = []
    if set(panel.keys) <= set(df.columns):
        agg = agg.withColumn("_d", dedupe.duplicate_count(df, panel.keys).select("member_rows").scalar())
        name = "no duplicate rows" if panel.entity else "no duplicate dates"
        cells.append(_issue("ERROR", name, None, F.col("_d"), F.col("_d"), True, F.col("_d") > 0))
    for c in keys:
        share = ratio(F.col(f"m_{c}"), F.col("_n"), 100.0)
        cells.append(_issue("ERROR", "key column completeness", c, F.col(f"m_{c}"), share, True, share > null_limit_pct))
    cells += [_issue("ERROR", "value range", c, F.col(f"r_{c}"), F.col(f"r_{c}"), True, F.col(f"r_{c}") > 0) for c in ranged]
    return _issues(agg, dataset, cells) if cells else _no_issues(df)


def warnings(df: DataFrame, dataset: str, rules: DatasetRules, null_limit_pct: float = 20.0, outlier_limit_pct: float = 1.0,
             min_valid: int = 10) -> DataFrame:
    """Nulls in other columns, and whole-table outliers in more than one percent of the rows.

    The quartiles come from the distributed quantiles: the table is one group here.
    """
    rest = [c for c in df.columns if c not in rules.keys]
    numeric = numeric_columns(df)
    placed = outliers.with_iqr_bounds(df, Panel((), ""), numeric, min_valid=min_valid, large=True)
    agg = placed.agg(
        F.count("*").alias("_n"),
        *[F.sum(missing(F.col(c), fractional(df, c)).cast("long")).alias(f"m_{c}") for c in rest],
        *[F.count(F.when(outliers.outside(c), 1)).alias(f"o_{c}") for c in numeric],
    )
    cells = []
    for c in rest:
        share = ratio(F.col(f"m_{c}"), F.col("_n"), 100.0)
        cells.append(_issue("WARNING", "missing values", c, F.col(f"m_{c}"), share, False, share > null_limit_pct))
    for c in numeric:
        share = ratio(F.col(f"o_{c}"), F.col("_n"), 100.0)
        cells.append(_issue("WARNING", "outliers", c, F.col(f"o_{c}"), share, False, share > outlier_limit_pct))
    return _issues(agg, dataset, cells) if cells else _no_issues(df)


def info(df: DataFrame, dataset: str, date: str) -> DataFrame:
    """Table size and date range."""
    agg = df.agg(F.count("*").alias("_n"), F.datediff(F.max(date), F.min(date)).alias("_d"))
    return _issues(agg, dataset, [
        _issue("INFO", "dataset size", None, F.col("_n"), F.lit(float(len(df.columns))), False, F.lit(True)),
        _issue("INFO", "date range", date, F.col("_n"), F.col("_d"), False, F.col("_d").isNotNull()),
    ])


def date_gaps(df: DataFrame, dataset: str, panel: Panel, limit_days: int = 30) -> DataFrame:
    """One warning per entity whose largest date gap exceeds the limit; ``column`` holds the entity."""
    gaps = windows.max_date_gap(df, panel, limit_days).filter(F.col("gap_warning") == 1)
    name = F.concat_ws("|", *panel.entity) if panel.entity else F.lit(panel.date)
    return gaps.select(
        F.lit(dataset).alias("dataset"), F.lit("WARNING").alias("severity"), F.lit("date gap").alias("check_name"),
        name.alias("column"), F.lit(None).cast("long").alias("affected_rows"),
        F.col("max_gap_days").cast("double").alias("value"), F.lit(False).alias("auto_fixable"))


def business(df: DataFrame, dataset: str, leverage: str = "Debt_to_Equity", limit: float = 100.0) -> DataFrame:
    if leverage not in df.columns:
        return _no_issues(df)
    agg = df.agg(F.count(F.when(F.col(leverage) > limit, 1)).alias("_k"))
    return _issues(agg, dataset, [_issue("WARNING", "business rule: leverage", leverage, F.col("_k"), F.col("_k"), False, F.col("_k") > 0)])


def validate(df: DataFrame, dataset: str, panel: Panel, rules: DatasetRules | None = None, leverage: str = "Debt_to_Equity") -> DataFrame:
    """All layers."""
    r = rules or rules_for(dataset)
    return union_all([
        critical(df, dataset, r, panel.date), errors(df, dataset, r, panel), warnings(df, dataset, r),
        info(df, dataset, panel.date), date_gaps(df, dataset, panel), business(df, dataset, leverage),
    ])


FIXES = ("date column type", "no null columns", "no inf values", "no duplicate rows")


def remediate(df: DataFrame, issues: DataFrame, panel: Panel) -> tuple[DataFrame, DataFrame]:
    """Apply the safe fixes named by the issues; returns the repaired table and the issues with ``fix_applied``.

    Only fixable issues are read to the driver: at most a few per column.
    """
    todo = {(r["check_name"], r["column"]) for r in
            issues.filter(F.col("auto_fixable") & F.col("check_name").isin(*FIXES)).select("check_name", "column").distinct().collect()}
    out, done = df, set()
    for issue in sorted(todo, key=lambda x: (FIXES.index(x[0]), x[1] or "")):
        check, column = issue
        if check == "date column type" and column == panel.date:
            out = out.withColumn(column, F.to_date(F.try_to_timestamp(column)))
        elif check == "no null columns" and column in out.columns and column not in panel.keys:
            out = out.drop(column)
        elif check == "no inf values" and column in out.columns:
            out = hygiene.inf_to_null(out, [column])
        elif check == "no duplicate rows":
            out = dedupe.keep_first(out, panel.keys, panel.tie or [c for c in out.columns if c not in panel.keys])
        else:
            continue
        done.add(issue)
    ran = [(F.col("check_name") == check) & F.col("column").eqNullSafe(F.lit(column)) for check, column in sorted(done, key=str)]
    return out, issues.withColumn("fix_applied", F.coalesce(F.col("auto_fixable") & reduce(or_, ran, F.lit(False)), F.lit(False)))


def post_clean(df: DataFrame, dataset: str, keys: Sequence[str], error_pct: float = 2.0, warning_pct: float = 1.0,
               suffixes: Sequence[str] = MERGE_SUFFIXES, entity: str | None = None, entity_pct: float = 5.0) -> DataFrame:
    """Checks of a cleaned merged table: infinities, merge suffixes, missing cells, constant columns.

    With ``entity``, each entity of which more than ``entity_pct`` percent of the cells are missing is a warning of its own, whose
    column is the entity. A null entity is an entity.
    """
    floats = [c for c in numeric_columns(df) if fractional(df, c)]
    others = [c for c in df.columns if c not in keys]
    cells = sum((missing(F.col(c), fractional(df, c)).cast("long") for c in df.columns), F.lit(0).cast("long"))
    agg = df.agg(
        F.count("*").alias("_n"), F.sum(cells).alias("_m"),
        F.coalesce(F.sum(sum((is_inf(F.col(c)).cast("long") for c in floats), F.lit(0).cast("long"))), F.lit(0)).alias("_inf"),
        *[F.coalesce(F.min(c) == F.max(c), F.lit(True)).cast("int").alias(f"c_{c}") for c in others],
    )
    suffixed = float(len([c for c in df.columns if c.endswith(tuple(suffixes))]))
    pct = ratio(F.col("_m"), F.col("_n") * len(df.columns), 100.0)
    flat = sum((F.col(f"c_{c}") for c in others), F.lit(0))
    none = F.lit(None)
    whole = _issues(agg, dataset, [
        _issue("CRITICAL", "no inf values", None, F.col("_inf"), F.col("_inf"), False, F.col("_inf") > 0),
        _issue("CRITICAL", "no duplicate columns", None, none, F.lit(suffixed), False, F.lit(suffixed > 0)),
        _issue("ERROR", "missing values", None, F.col("_m"), pct, False, pct > error_pct),
        _issue("WARNING", "missing values", None, F.col("_m"), pct, False, (pct > warning_pct) & (pct <= error_pct)),
        _issue("WARNING", "no constant columns", None, none, flat, False, flat > 0),
    ])
    if entity is None:
        return whole
    rows = df.groupBy(entity).agg(F.count("*").alias("_n"), F.sum(cells).alias("_m"))
    share = ratio(F.col("_m"), F.col("_n") * len(df.columns), 100.0)
    found = rows.filter(share > entity_pct).select(
        F.lit(dataset).alias("dataset"), F.lit("WARNING").alias("severity"), F.lit("missing values by entity").alias("check_name"),
        F.col(entity).cast("string").alias("column"), F.col("_m").alias("affected_rows"), share.alias("value"), F.lit(False).alias("auto_fixable"))
    return whole.unionByName(found)


def issue_counts(issues: DataFrame, datasets: Sequence[str] | None = None) -> DataFrame:
    """Issues per dataset and severity; passed means no critical issue.

    A dataset without any issue has no row unless it is named in ``datasets``.
    """
    counts = issues.groupBy("dataset").agg(*[
        F.count(F.when(F.col("severity") == s, 1)).alias(s.lower()) for s in SEVERITIES])
    if datasets is not None:
        all_names = issues.sparkSession.createDataFrame([(d,) for d in datasets], "dataset string")
        counts = all_names.join(counts, "dataset", "left").fillna(0)
    return counts.withColumn("passed", F.col("critical") == 0)


def _stack(parts: Mapping[str, DataFrame], columns: Sequence[str]) -> DataFrame:
    """One row per dataset from several one-row-per-dataset reports, by grouping instead of joining."""
    stacked = union_all([d.select("dataset", *existing(d, columns)) for d in parts.values()])
    return stacked.groupBy("dataset").agg(*[F.max(c).alias(c) for c in columns if c in stacked.columns])


def checkpoint_verdict(gates: DataFrame, counts: DataFrame, post_counts: DataFrame | None = None) -> DataFrame:
    """Per dataset: expectations pass, no critical issue, and no critical post-clean issue.

    ``gates`` carries ``suite`` = dataset name and ``passed``. A part nobody reported counts as passed.
    """
    parts = {
        "checks_passed": counts.select("dataset", F.col("passed").alias("checks_passed")),
        "expectations_passed": gates.select(F.col("suite").alias("dataset"), F.col("passed").alias("expectations_passed")),
    }
    if post_counts is not None:
        parts["post_clean_passed"] = post_counts.select("dataset", F.col("passed").alias("post_clean_passed"))
    names = ["checks_passed", "expectations_passed", "post_clean_passed"]
    out = _stack(parts, names)
    out = out.withColumns({c: F.coalesce(c, F.lit(True)) if c in parts else F.lit(True) for c in names})
    return out.withColumn("passed", F.col(names[0]) & F.col(names[1]) & F.col(names[2]))


def checkpoint_summary(suite_summary: DataFrame, verdicts: DataFrame, counts: DataFrame) -> DataFrame:
    """One line per dataset: verdict, success percent and issue counts."""
    parts = {
        "verdict": verdicts.select("dataset", "passed"),
        "suite": suite_summary.select(F.col("suite").alias("dataset"), "evaluated", "failed", "success_pct"),
        "issues": counts.select("dataset", "critical", "error", "warning"),
    }
    return _stack(parts, ["passed", "evaluated", "failed", "success_pct", "critical", "error", "warning"])


def append_history(history: DataFrame, snapshot: DataFrame) -> DataFrame:
    """All entries so far and those of a new run; nothing is dropped. A column that one side lacks is null there."""
    return history.unionByName(snapshot, allowMissingColumns=True)


def recent_runs(history: DataFrame, by: Sequence[str], order: Sequence[str], runs: int) -> DataFrame:
    """A view of the latest ``runs`` entries per dataset. Spark applies the limit before the shuffle as well."""
    w = Window.partitionBy(*by).orderBy(*[F.col(c).desc() for c in order])
    return history.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= runs).drop("_rank")


# fixed values: alert limits
MIN_SUCCESS_PCT = 90.0
MAX_STEP_SECONDS = 3600.0
MAX_CRITICAL = 10
MAX_HIGH_DRIFT = 20


def alert_conditions(run_summary: DataFrame, critical_count: Column, high_drift: Column, step: str = "step",
                     min_success_pct: float = MIN_SUCCESS_PCT, max_seconds: float = MAX_STEP_SECONDS,
                     max_high_drift: int = MAX_HIGH_DRIFT) -> DataFrame:
    """Alerts raised by the run metrics and the audit totals: kind, subject, value."""
    def rows(df: DataFrame, kind: str, subject: Column, value: Column, when: Column) -> DataFrame:
        return df.filter(when).select(F.lit(kind).alias("alert"), subject.alias("subject"), value.cast("double").alias("value"))

    totals = run_summary.agg(F.count("*").alias("_n")).select(critical_count.alias("_c"), high_drift.alias("_h"))
    return union_all([
        rows(run_summary, "low success rate", F.col(step), F.col("success_rate"), F.col("success_rate") < min_success_pct),
        rows(run_summary, "slow step", F.col(step), F.col("max_duration"), F.col("max_duration") > max_seconds),
        rows(totals, "critical anomaly", F.lit("audit"), F.col("_c"), F.col("_c") > 0),
        rows(totals, "many critical anomalies", F.lit("audit"), F.col("_c"), F.col("_c") > MAX_CRITICAL),
        rows(totals, "many drifted features", F.lit("drift"), F.col("_h"), F.col("_h") > max_high_drift),
    ])
