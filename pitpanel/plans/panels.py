"""End-to-end plans: macro panel, entity panel and the audit of a finished panel."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitpanel.functions.columns import existing, ratio
from pitpanel.operators import drift, features, fill, merge, outliers, windows
from pitpanel.panel import Panel
from pitpanel.plans import clean
from pitpanel.plans.repair import repair_merged
from pitpanel.session import stable

# fixed values: row parameters of the feature catalogue
LAGS = (1, 5, 22)
STATEMENT_LAGS = (90, 252)


@dataclass(frozen=True)
class MacroNames:
    gdp: str = "gdp"
    cpi: str = "cpi"
    unemployment: str = "unemp"
    policy_rate: str = "ffr"
    spread: str = "spread"
    oil: str = "oil"
    confidence: str = "conf"
    credit_spread: str = "ted"


@dataclass(frozen=True)
class MarketNames:
    volatility: str = "vix"
    level: str = "idx"


@dataclass(frozen=True)
class EntityNames:
    price: str = "price"
    volume: str = "volume"
    statement: features.Statement = features.Statement()


def _specs(df: DataFrame, columns: Sequence[str], pattern: str, rows: Sequence[int]) -> dict[str, tuple[str, int]]:
    return {pattern.format(c=c, n=n): (c, n) for c in existing(df, columns) for n in rows}


def macro_features(df: DataFrame, panel: Panel, m: MacroNames = MacroNames()) -> DataFrame:
    """Lags, growth, inflation, moving averages, volatility and the two stress flags."""
    series = existing(df, [m.gdp, m.cpi, m.unemployment, m.policy_rate, m.spread, m.oil, m.confidence])
    smooth = existing(df, [m.unemployment, m.policy_rate, m.oil])
    out = windows.lag_features(df, panel, series, LAGS)
    growth = _specs(df, [m.gdp], "{c}_growth_{n}d", (90, 252))
    if m.cpi in df.columns:
        growth["inflation"] = (m.cpi, 12)
    out = windows.pct_change(out, panel, growth)
    averages = _specs(df, smooth, "{c}_ma{n}", (30, 90))
    if m.cpi in df.columns:
        averages["inflation_ma3m"] = ("inflation", 90)
    out = windows.moving_average(out, panel, averages)
    out = windows.rolling_std(out, panel, _specs(df, smooth, "{c}_volatility_{n}d", (30,)))
    if m.spread in df.columns:
        out = features.below_flag(out, m.spread, 0.0, "yield_curve_inverted")
    if m.credit_spread in df.columns:
        out = features.above_quantile_flag(out, m.credit_spread, 0.75, f"{m.credit_spread}_high", large=False)
    return out


def market_features(df: DataFrame, panel: Panel, k: MarketNames = MarketNames()) -> DataFrame:
    """Volatility level features, and returns, averages, volatility, momentum and RSI of the index."""
    out = df
    v, x = k.volatility, k.level
    if v in df.columns:
        out = windows.lag_features(out, panel, [v], LAGS)
        out = windows.moving_average(out, panel, _specs(df, [v], "{c}_ma{n}", (5, 22, 90)))
        out = windows.rolling_std(out, panel, _specs(df, [v], "{c}_std{n}", (22,)))
        out = out.withColumn(f"{v}_regime", features.volatility_regime(F.col(v)))
    if x in df.columns:
        out = windows.pct_change(out, panel, _specs(df, [x], "{c}_return_{n}d", (1, 5, 22, 90)))
        averages = {n: f"{x}_ma{n}" for n in (50, 200)}
        out = windows.moving_average(out, panel, {name: (x, n) for n, name in averages.items()})
        out = windows.annualized_volatility(out, panel, {f"{x}_volatility_{n}d": (f"{x}_return_1d", n) for n in (22, 90)})
        out = windows.rsi(out, panel, x, f"{x}_rsi_14d")
        out = out.withColumns({
            **{f"{x}_vs_ma{n}": ratio(F.col(x), F.col(name)) for n, name in averages.items()},
            **{f"{x}_momentum_{n}d": F.col(f"{x}_return_{n}d") for n in (22, 90)},
        })
    return out


def entity_features(df: DataFrame, panel: Panel, e: EntityNames = EntityNames()) -> DataFrame:
    """Price, volume and statement features of the merged daily panel.

    The steps over an entity come first, one after another: they hold it as arrays and take one pass together. A panel
    without entity columns takes windows.
    """
    p, v, s = e.price, e.volume, e.statement
    out, arrays = df, bool(panel.entity)
    if p in df.columns:
        out = windows.macd(out, panel, p, f"{p}_macd", f"{p}_macd_signal", arrays=arrays)
        returns = {f"{p}_return_{n}d": (p, n) for n in (1, 5, 22, 90)}
        out = windows.pct_change(out, panel, {**returns, f"{p}_return_ytd": (p, 252)}, arrays=arrays)
        out = windows.moving_average(out, panel, {f"{p}_ma{n}": (p, n) for n in (20, 50, 200)}, arrays=arrays)
        out = windows.annualized_volatility(out, panel, {f"{p}_volatility_{n}d": (f"{p}_return_1d", n) for n in (22, 90)}, arrays=arrays)
        out = windows.rsi(out, panel, p, f"{p}_rsi_14d", arrays=arrays)
    of_price = out.columns
    if v in df.columns:
        out = windows.moving_average(out, panel, {f"{v}_ma20": (v, 20)}, arrays=arrays)
    growing = existing(df, [s.revenue, s.net_income, s.assets])
    out = windows.pct_change(out, panel, {
        f"{c}_growth_{label}": (c, n) for c in growing for label, n in (("qoq", 90), ("yoy", 252))}, arrays=arrays)
    out = windows.lag_features(out, panel, existing(df, [*growing, s.total_debt]), STATEMENT_LAGS, arrays=arrays)
    if s.revenue in df.columns:
        out = windows.trend_flag(out, panel, s.revenue, f"{s.revenue}_trend_90d", arrays=arrays)
    of_entity = out.columns
    if p in df.columns:
        out = out.withColumns({f"{p}_vs_ma{n}": ratio(F.col(p), F.col(f"{p}_ma{n}")) for n in (50, 200)})
    if v in df.columns:
        out = out.withColumn(f"{v}_vs_ma20", ratio(F.col(v), F.col(f"{v}_ma20")))
    out = features.financial_ratios(out, s)
    by_row = [c for c in out.columns if c not in of_entity]
    smooth = [f"{v}_ma20"] if v in df.columns else []
    first = [*of_price, *[c for c in by_row if c.startswith(f"{p}_vs_")], *smooth]
    return out.select(*first, *[c for c in by_row if c not in first], *[c for c in of_entity if c not in first])


def macro_panel(macro: DataFrame, market: DataFrame, panel: Panel, m: MacroNames = MacroNames(),
                k: MarketNames = MarketNames(), allow_lookahead: bool = True, cut_lineage: bool = True) -> DataFrame:
    """Cleaned macro and market tables with features, one row per date of either table.

    All inputs hold one row per day, so windows over the whole table are bounded by the calendar.
    Gaps are filled only if some column is more than five percent null. The merged table is small
    and read twice (null shares, fill), so ``cut_lineage`` writes it down first.
    """
    a = macro_features(clean.clean_series(macro, panel, lead_median=allow_lookahead), panel, m)
    b = market_features(clean.clean_series(market, panel, lead_median=allow_lookahead), panel, k)
    out = merge.merge_series(a, b, panel.date)
    if cut_lineage and allow_lookahead:
        out = stable(out)
    numbers = [c for c in out.columns if c != panel.date]
    return fill.conditional_fill(out, panel, numbers, "any", 5.0) if allow_lookahead else fill.forward_fill(out, panel, numbers)


def entity_panel(prices: DataFrame, statements: DataFrame, context: DataFrame, panel: Panel, e: EntityNames = EntityNames(),
                 lag_days: int = clean.REPORTING_LAG_DAYS, debt: tuple[str, str] | None = None,
                 price_panel: Panel | None = None, lead_median: bool = True, attributes: Mapping[str, str] | None = None) -> DataFrame:
    """Prices and daily statements of every entity with features and the macro context of the day.

    Statements count only after their reporting lag, and are expanded to days before the join.
    ``price_panel`` carries the tie-break of raw price rows that may repeat a day. ``attributes`` are texts of an
    entity in ``prices``, such as its sector or name, each with the text for an entity that has none: days without a price get them too.
    """
    raw = price_panel or panel
    p = clean.clean_prices(prices, raw, [e.price], [c for c in prices.columns], e.price, lead_median)
    p = p.drop(*raw.tie)
    s = clean.clean_statements(statements, panel, lag_days, debt, lead_median)
    daily = fill.quarterly_to_daily(s, panel)
    merged = merge.merge_stacked(p, daily, panel.keys)
    for name, unknown in (attributes or {}).items():
        merged = merged.withColumn(name, F.coalesce(F.first(name, ignorenulls=True).over(panel.ordered().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)), F.lit(unknown)))
    return merge.add_context(entity_features(merged, panel, e), context, panel.date)


def audit_flags(df: DataFrame, panel: Panel, outlier_columns: Sequence[str], jump_columns: Sequence[str],
                rules: Sequence[outliers.Rule] = outliers.BUSINESS_RULES) -> DataFrame:
    """Outlier, rule and jump flags as columns; the row count stays the same."""
    out = outliers.iqr_flags(df, panel, existing(df, outlier_columns), min_valid=outliers.MIN_ROWS)
    out = outliers.rule_flags(out, rules)
    return outliers.jump_flags(out, panel, jump_columns)


def context_flags(df: DataFrame, panel: Panel, volatility: str | None = None, drift_columns: Sequence[str] = (),
                  reference: tuple[int, int] | None = None, current: tuple[int, int] | None = None) -> DataFrame:
    """``market_regime`` by the volatility of the day, and ``feature_drift_flag``: a value of a column that drifted between the periods."""
    out = df
    if volatility is not None:
        out = out.withColumn("market_regime", features.volatility_regime(F.col(volatility)))
    if reference is not None and current is not None:
        report = drift.drift_report(df, panel.date, existing(df, drift_columns), reference, current)
        out = drift.drift_flag(out, report)
    return out


def finished_panel(prices: DataFrame, statements: DataFrame, context: DataFrame, panel: Panel, e: EntityNames = EntityNames(),
                   keep_text: Sequence[str] = (), cut_lineage: bool = True, flags: Mapping | None = None, **options) -> DataFrame:
    """Entity panel, repaired and flagged; ``flags`` are the options of ``context_flags``.

    The wide panel is expensive and the steps behind the fills read it several times, so ``cut_lineage``
    writes it down after the fills; up to there each row is read once.
    """
    wide = entity_panel(prices, statements, context, panel, e, **options)
    repaired = repair_merged(wide, panel, keep_text, cut_lineage=cut_lineage)
    p = e.price
    repaired = context_flags(repaired, panel, **flags) if flags else repaired
    return audit_flags(repaired, panel, [f"{p}_return_1d", f"{p}_return_22d", f"{p}_volatility_22d", "profit_margin", "roe", "roa"],
                       [p, e.statement.revenue])

