"""Outlier, rule and jump flags with their reports. Flags are columns; rows are never removed."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitpanel.functions.columns import existing, flag, ratio
from pitpanel.operators import windows
from pitpanel.operators.profile import long_report
from pitpanel.operators.joins import join_checked, join_same
from pitpanel.operators.quantiles import grouped_quantiles, quantile_name, quantile_table
from pitpanel.panel import Panel

IQR_FACTOR = 3.0
JUMP_LIMIT_PCT = 50.0
MIN_ROWS = 10
CRISIS_YEARS = (2008, 2009, 2020)  # fixed values


def with_iqr_bounds(df: DataFrame, panel: Panel, columns: Sequence[str], factor: float = IQR_FACTOR,
                    min_valid: int = 0, large: bool | None = None) -> DataFrame:
    """Add ``_lo_x`` and ``_hi_x`` per column: quartiles widened by ``factor`` times their distance.

    Per entity as window aggregates, over a whole table as a scalar subquery. ``large`` brackets quantiles in groups
    of any size; by default a whole table is such a group, an entity with one row a day is not. Fewer than ``min_valid``
    values give NULL bounds.
    """
    large = not panel.entity if large is None else large
    if panel.entity and not large:
        w = panel.whole()
        out = df.withColumns({
            f"_q_{c}": F.when(
                F.count(c).over(w) >= min_valid,
                F.percentile(F.col(c).cast("double"), F.array(F.lit(0.25), F.lit(0.75))).over(w),
            )
            for c in columns
        })
        low, high = (lambda c: F.col(f"_q_{c}")[0]), (lambda c: F.col(f"_q_{c}")[1])
        spent = [f"_q_{c}" for c in columns]
    else:
        if panel.entity:
            q = quantile_table(df, panel.entity, columns, [0.25, 0.75])
            out = join_checked(df, q.select(*panel.entity, F.struct(*q.columns).alias("_q")), panel.entity)
        else:
            q = (quantile_table(df, [], columns, [0.25, 0.75]) if large
                 else grouped_quantiles(df, [], columns, [0.25, 0.75], counts=True))
            out = df.withColumn("_q", q.select(F.struct(*q.columns)).scalar())

        def edge(c: str, p: float) -> Column:
            return F.when(F.col(f"_q.{c}_n") >= min_valid, F.col(f"_q.{quantile_name(c, p)}"))

        low, high = (lambda c: edge(c, 0.25)), (lambda c: edge(c, 0.75))
        spent = ["_q"]
    bounds = {}
    for c in columns:
        spread = (high(c) - low(c)) * factor
        bounds[f"_lo_{c}"], bounds[f"_hi_{c}"] = low(c) - spread, high(c) + spread
    return out.withColumns(bounds).drop(*spent)


def outside(c: str) -> Column:
    return F.coalesce((F.col(c) < F.col(f"_lo_{c}")) | (F.col(c) > F.col(f"_hi_{c}")), F.lit(False))


def iqr_flags(df: DataFrame, panel: Panel, columns: Sequence[str], factor: float = IQR_FACTOR, min_valid: int = 0,
              suffix: str = "_outlier_flag", large: bool | None = None) -> DataFrame:
    """``{column}_outlier_flag`` per column; the flag column always exists."""
    out = with_iqr_bounds(df, panel, columns, factor, min_valid, large)
    out = out.withColumns({c + suffix: outside(c).cast("int") for c in columns})
    return out.drop(*[f"_{e}_{c}" for c in columns for e in ("lo", "hi")])


def outlier_report(df: DataFrame, panel: Panel, columns: Sequence[str], factor: float = IQR_FACTOR,
                   min_valid: int = 0, share_of: str = "rows", large: bool | None = None) -> DataFrame:
    """Per group and column with outliers: count, percent, smallest and largest outlier, years.

    ``share_of``: percent of all ``rows`` of the group or of its ``valid`` values.
    """
    placed = with_iqr_bounds(df, panel, columns, factor, min_valid, large)
    cells = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"), outside(c).alias("hit")) for c in columns
    ])
    hits = placed.select(*panel.entity, panel.date, F.explode(F.filter(cells, lambda x: x["hit"])).alias("_x"))
    found = hits.groupBy(*panel.entity, F.col("_x.column").alias("column")).agg(
        F.count("*").alias("n_outliers"), F.round(F.min("_x.value"), 2).alias("min_outlier"),
        F.round(F.max("_x.value"), 2).alias("max_outlier"),
        F.array_sort(F.collect_set(F.year(panel.date))).alias("outlier_years"),  # bounded by the calendar
    )
    sizes = df.groupBy(*panel.entity).agg(*[
        (F.count("*") if share_of == "rows" else F.count(c)).alias(f"_n_{c}") for c in columns
    ])
    size_cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_n_{c}").alias("_n")) for c in columns])
    sizes = sizes.select(*panel.entity, F.explode(size_cells).alias("_s")).select(*panel.entity, "_s.*")
    out = join_same(found, sizes, [*panel.entity, "column"])
    return out.withColumn("pct", F.round(ratio(F.col("n_outliers"), F.col("_n"), 100.0), 2)).drop("_n")


@dataclass(frozen=True)
class Rule:
    """A value outside [low, high] breaks the rule; ``absolute`` tests the magnitude."""

    column: str
    low: float | None
    high: float | None
    severity: str
    flag: str
    text: str
    absolute: bool = False

    def broken(self) -> Column:
        c = F.abs(F.col(self.column)) if self.absolute else F.col(self.column)
        hit = F.lit(False)
        if self.low is not None:
            hit = hit | (c < self.low)
        if self.high is not None:
            hit = hit | (c > self.high)
        return F.coalesce(hit, F.lit(False))


def non_negative(column: str) -> Rule:
    return Rule(column, 0.0, None, "CRITICAL", f"{column}_negative_flag", f"{column} cannot be negative")


# fixed values: the standard business rules
BUSINESS_RULES = (
    *(non_negative(c) for c in ("vix", "volume", "cpi", "total_assets", "stock_price", "close")),
    Rule("profit_margin", -100.0, 100.0, "HIGH", "profit_margin_extreme_flag", "profit margin within 100 percent"),
    Rule("roe", -200.0, 200.0, "HIGH", "roe_extreme_flag", "return on equity within 200 percent"),
    Rule("debt_to_equity", 0.0, 100.0, "HIGH", "debt_to_equity_extreme_flag", "debt to equity between 0 and 100"),
    Rule("gdp_growth_90d", None, 20.0, "CRITICAL", "gdp_growth_extreme_flag", "quarterly growth within 20 percent", absolute=True),
)


def applicable(df: DataFrame, rules: Sequence[Rule]) -> list[Rule]:
    have = set(existing(df, [r.column for r in rules]))
    return [r for r in rules if r.column in have]


def rule_flags(df: DataFrame, rules: Sequence[Rule] = BUSINESS_RULES) -> DataFrame:
    return df.withColumns({r.flag: r.broken().cast("int") for r in applicable(df, rules)})


def rule_report(df: DataFrame, rules: Sequence[Rule] = BUSINESS_RULES) -> DataFrame:
    """One row per rule that was broken, from a single pass."""
    used = applicable(df, rules)
    agg = df.agg(*[F.count(F.when(r.broken(), 1)).alias(r.flag) for r in used])
    return long_report(agg, [[
        F.lit(r.text).alias("rule"), F.lit(r.column).alias("column"), F.col(r.flag).alias("count"),
        F.lit(r.severity).alias("severity"), F.lit(r.low).cast("double").alias("low"), F.lit(r.high).cast("double").alias("high")]
        for r in used]).filter(F.col("count") > 0)


def jump_flags(df: DataFrame, panel: Panel, columns: Sequence[str], limit_pct: float = JUMP_LIMIT_PCT,
               min_rows: int = MIN_ROWS, suffix: str = "_jump_flag", blocked: bool = False) -> DataFrame:
    """1 where a column moves by more than ``limit_pct`` percent; entities with few rows stay 0."""
    cols = existing(df, columns)
    moves = {f"_j_{c}": (c, 1) for c in cols}
    out = windows.pct_change(df, panel, moves, blocked=blocked)
    if blocked and panel.entity:  # counts are combined before the shuffle
        out = join_checked(out, df.groupBy(*panel.entity).agg(F.count("*").alias("_rows")), panel.entity)
    else:
        out = out.withColumn("_rows", F.count(F.lit(1)).over(panel.whole()) if not blocked else df.agg(F.count("*")).scalar())
    return out.withColumns({
        c + suffix: flag((F.col("_rows") >= min_rows) & (F.abs(F.col(f"_j_{c}")) > limit_pct)) for c in cols
    }).drop(*moves, "_rows")


def jump_severity(flagged: DataFrame, panel: Panel, columns: Sequence[str], suffix: str = "_jump_flag",
                  crisis_years: Sequence[int] = CRISIS_YEARS) -> DataFrame:
    """Jumps per entity and column with their years; LOW if any jump year was a crisis, else HIGH."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c + suffix).alias("hit")) for c in columns])
    hits = flagged.select(*panel.entity, panel.date, F.explode(F.filter(cells, lambda x: x["hit"] == 1)).alias("_x"))
    out = hits.groupBy(*panel.entity, F.col("_x.column").alias("column")).agg(
        F.count("*").alias("count"), F.array_sort(F.collect_set(F.year(panel.date))).alias("years"))
    crisis = F.arrays_overlap("years", F.array(*[F.lit(y) for y in crisis_years]))
    return out.withColumn("is_crisis", crisis).withColumn("severity", F.when(crisis, "LOW").otherwise("HIGH"))


def anomaly_summary(outliers: DataFrame, rules: DataFrame, jumps: DataFrame) -> DataFrame:
    """Totals over the three reports. Jumps enter only the critical count, and only outside a crisis."""
    parts = outliers.select(
        F.lit("outlier").alias("kind"), F.col("n_outliers").alias("n"), F.lit(0).cast("long").alias("critical"), "column"
    ).unionByName(rules.select(
        F.lit("rule").alias("kind"), F.col("count").alias("n"),
        F.when(F.col("severity") == "CRITICAL", F.col("count")).otherwise(0).alias("critical"), "column",
    )).unionByName(jumps.select(
        F.lit("jump").alias("kind"), F.col("count").alias("n"),
        F.when(~F.col("is_crisis"), F.col("count")).otherwise(0).alias("critical"), "column",
    ))
    return parts.agg(
        F.coalesce(F.sum(F.when(F.col("kind") != "jump", F.col("n"))), F.lit(0)).alias("total_count"),
        F.coalesce(F.sum("critical"), F.lit(0)).alias("critical_count"),
        F.count_distinct(F.when(F.col("kind") == "outlier", F.col("column"))).alias("outlier_columns"),
        F.count(F.when(F.col("kind") == "rule", 1)).alias("broken_rules"),
        F.coalesce(F.sum(F.when(F.col("kind") == "jump", F.col("n"))), F.lit(0)).alias("jumps"),
    )
