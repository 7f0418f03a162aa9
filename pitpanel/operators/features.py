"""Scalar, ratio and interaction features."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitpanel.functions.columns import clip, existing, flag, ratio, right_closed_bins, string_columns
from pitpanel.operators.fill import forward_fill
from pitpanel.operators.quantiles import grouped_quantiles, quantile_name, quantile_table
from pitpanel.panel import Panel

# fixed values: regime borders and labels
REGIME_EDGES = (0.0, 15.0, 25.0, 100.0)
REGIME_LABELS = ("Low", "Medium", "High")


def volatility_regime(c: Column, edges: Sequence[float] = REGIME_EDGES, labels: Sequence[str] = REGIME_LABELS) -> Column:
    return right_closed_bins(c, edges, labels)


def below_flag(df: DataFrame, column: str, limit: float, name: str) -> DataFrame:
    return df.withColumn(name, flag(F.col(column) < limit))


def above_quantile_flag(df: DataFrame, column: str, p: float, name: str, large: bool = True) -> DataFrame:
    """1 where the value exceeds the whole-table quantile, which comes back as a scalar subquery.

    ``large=False`` holds all values in one buffer: for date-keyed tables, which the calendar bounds.
    """
    q = quantile_table(df, [], [column], [p]) if large else grouped_quantiles(df, [], [column], [p])
    return df.withColumn(name, flag(F.col(column) > q.select(quantile_name(column, p)).scalar()))


@dataclass(frozen=True)
class Statement:
    """Column names of a statement table."""

    revenue: str = "revenue"
    net_income: str = "net_income"
    assets: str = "assets"
    equity: str = "equity"
    total_debt: str = "total_debt"
    cash: str = "cash"
    current_liabilities: str = "liabilities"
    price: str = "price"


def financial_ratios(df: DataFrame, s: Statement) -> DataFrame:
    """Margins, returns, leverage and liquidity; a ratio whose inputs are absent is skipped."""
    have = set(df.columns)
    wanted = {
        "profit_margin": (s.net_income, s.revenue, 100.0),
        "roa": (s.net_income, s.assets, 100.0),
        "roe": (s.net_income, s.equity, 100.0),
        "debt_to_assets": (s.total_debt, s.assets, 100.0),
        "cash_ratio": (s.cash, s.current_liabilities, 1.0),
    }
    out = {
        name: ratio(F.col(a), F.col(b), k) for name, (a, b, k) in wanted.items() if {a, b} <= have
    }
    if {s.price, s.equity} <= have:
        out["price_to_book"] = ratio(F.col(s.price), F.col(s.equity) / 1e9)
    return df.withColumns(out)


def _add_available(df: DataFrame, wanted: Mapping[str, tuple[Sequence[str], Column]]) -> DataFrame:
    """Add the columns whose inputs exist."""
    have = set(df.columns)
    return df.withColumns({name: c for name, (needs, c) in wanted.items() if set(needs) <= have})


def _inverse(c: Column) -> Column:
    return F.try_divide(F.lit(1.0), c)


@dataclass(frozen=True)
class MacroContext:
    """Column names of a macro panel."""

    policy_rate: str = "ffr"
    inflation: str = "inflation"
    spread: str = "spread"
    gdp_growth: str = "gdp_growth"
    unemployment: str = "unemp"
    volatility: str = "vix"
    market_return: str = "market_return_22d"
    credit_spread: str = "ted"


def macro_interactions(df: DataFrame, m: MacroContext = MacroContext()) -> DataFrame:
    c = F.col
    out = _add_available(df, {
        "real_interest_rate": ([m.policy_rate, m.inflation], c(m.policy_rate) - c(m.inflation)),
        "monetary_tightness": ([m.policy_rate, m.spread], c(m.policy_rate) * _inverse(c(m.spread) + 0.01)),
        "stagflation_risk": ([m.inflation, m.gdp_growth], c(m.inflation) * _inverse(c(m.gdp_growth) + 0.01)),
        "unemployment_gdp": ([m.unemployment, m.gdp_growth], c(m.unemployment) * F.abs(c(m.gdp_growth))),
        "vix_return": ([m.volatility, m.market_return], c(m.volatility) * F.abs(c(m.market_return))),
        "financial_stress": ([m.volatility, m.credit_spread], c(m.volatility) * c(m.credit_spread)),
    })
    if m.volatility in df.columns:
        out = above_quantile_flag(out, m.volatility, 0.75, "high_volatility_regime", large=False)
    if m.spread in df.columns:
        out = below_flag(out, m.spread, 0.0, "recession_signal")
    if m.credit_spread in df.columns:
        out = above_quantile_flag(out, m.credit_spread, 0.75, "credit_stress_regime", large=False)
    return out


@dataclass(frozen=True)
class EntityContext:
    """Column names of an entity panel that already carries its macro context."""

    macro: MacroContext = MacroContext()
    gdp: str = "gdp"
    revenue: str = "revenue"
    revenue_qoq: str = "revenue_qoq"
    revenue_yoy: str = "revenue_yoy"
    total_debt: str = "total_debt"
    debt_to_equity: str = "debt_to_equity"
    debt_to_assets: str = "debt_to_assets"
    profit_margin: str = "profit_margin"
    roe: str = "roe"
    current_ratio: str = "current_ratio"
    cash_ratio: str = "cash_ratio"
    volatility: str = "volatility_90d"
    entity_return: str = "return_22d"
    long_return: str = "return_90d"
    market_long_return: str = "market_return_90d"
    stress: str = "stress_index"


def entity_interactions(df: DataFrame, e: EntityContext = EntityContext()) -> DataFrame:
    c, m = F.col, e.macro
    beta = ratio(c(e.entity_return), c(m.market_return) + 1e-6) if {e.entity_return, m.market_return} <= set(df.columns) else F.lit(None)
    return _add_available(df, {
        "revenue_to_gdp": ([e.revenue, e.gdp], ratio(c(e.revenue), c(e.gdp) * 1e9)),
        "unemployment_revenue": ([m.unemployment, e.revenue_yoy], c(m.unemployment) * F.abs(c(e.revenue_yoy))),
        "gdp_revenue_sync": ([m.gdp_growth, e.revenue_qoq], c(m.gdp_growth) * c(e.revenue_qoq)),
        "interest_burden": ([m.policy_rate, e.total_debt], c(m.policy_rate) * c(e.total_debt) / 1e9),
        "leverage_sensitivity": ([m.policy_rate, e.debt_to_equity], c(m.policy_rate) * c(e.debt_to_equity)),
        "refinancing_risk": ([m.spread, e.debt_to_assets], _inverse(c(m.spread) + 0.01) * c(e.debt_to_assets)),
        "vix_volatility": ([m.volatility, e.volatility], c(m.volatility) * c(e.volatility)),
        "market_beta": ([e.entity_return, m.market_return], clip(beta, -5.0, 5.0)),
        "relative_performance": ([e.long_return, e.market_long_return], c(e.long_return) - c(e.market_long_return)),
        "inflation_margin_pressure": ([m.inflation, e.profit_margin], c(m.inflation) * _inverse(c(e.profit_margin) + 0.01)),
        "profit_under_stress": ([e.roe, m.volatility], c(e.roe) * _inverse(c(m.volatility) + 1)),
        "liquidity_buffer": ([e.current_ratio, m.credit_spread], c(e.current_ratio) * _inverse(c(m.credit_spread) + 0.01)),
        "cash_cushion": ([e.cash_ratio, e.stress], c(e.cash_ratio) * _inverse(c(e.stress) + 1)),
        "crisis_leverage": ([e.debt_to_equity, "high_volatility_regime"], c(e.debt_to_equity) * c("high_volatility_regime")),
        "recession_margin": ([e.profit_margin, "recession_signal"], _inverse(c(e.profit_margin) + 0.01) * c("recession_signal")),
    })


def stress_index(df: DataFrame, panel: Panel, columns: Sequence[str], lead: str, name: str = "stress_index") -> DataFrame:
    """First principal component of the standardised columns, signed so that ``lead`` loads positively.

    Needs at least three of the columns; with fewer the frame comes back unchanged.
    """
    cols = existing(df, columns)
    if len(cols) < 3:
        return df
    filled = {c: f"_f_{c}" for c in cols}
    ready = forward_fill(df.withColumns({f: F.col(c) for c, f in filled.items()}), panel, list(filled.values()))
    ready = ready.fillna(0.0, list(filled.values()))
    vectors = VectorAssembler(inputCols=list(filled.values()), outputCol="_v").transform(ready)
    scaled = StandardScaler(withMean=True, withStd=True, inputCol="_v", outputCol="_z").fit(vectors).transform(vectors)
    model = PCA(k=1, inputCol="_z", outputCol="_p").fit(scaled)
    loading = model.pc.toArray()[:, 0]
    sign = -1.0 if loading[cols.index(lead)] < 0 else 1.0
    out = model.transform(scaled).withColumn(name, vector_to_array("_p")[0] * F.lit(sign))
    return out.drop("_v", "_z", "_p", *filled.values())


def health_score(df: DataFrame, panel: Panel, columns: Sequence[str], name: str = "health_score") -> DataFrame:
    """Mean of the components, each scaled to 0..1 between its 5th and 95th percentile.

    Gaps are filled inside an entity, never across entities.
    """
    cols = existing(df, columns)
    if len(cols) < 2:
        return df
    work = {f"_h_{c}": c for c in cols}
    filled = df.withColumns({
        w: F.coalesce(F.last(c, ignorenulls=True).over(panel.upto()), F.lit(0.0)) for w, c in work.items()
    })
    edges = quantile_table(filled, [], list(work), [0.05, 0.95])
    edge = edges.select(F.struct(*[c for c in edges.columns])).scalar()
    placed = filled.withColumn("_edge", edge)
    parts = []
    for w in work:
        low, high = F.col(f"_edge.{quantile_name(w, 0.05)}"), F.col(f"_edge.{quantile_name(w, 0.95)}")
        parts.append(clip((F.col(w) - low) / (high - low + 1e-6), 0.0, 1.0))
    total = sum(parts[1:], parts[0])
    return placed.withColumn(name, total / len(parts)).drop("_edge", *work)


def crisis_flags(df: DataFrame, date: str, years: Sequence[int]) -> DataFrame:
    return df.withColumns({f"crisis_{y}": flag(F.year(date) == y) for y in years})


def numeric_share(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Share of all rows whose text converts to a number: one aggregate pass."""
    if not columns:
        return {}
    row = df.agg(F.count("*").alias("_n"), *[F.count(F.col(c).try_cast("double")).alias(c) for c in columns]).first()
    return {c: row[c] / max(row["_n"], 1) for c in columns}


def coerce_types(df: DataFrame, dates: Sequence[str] = (), timestamps: Sequence[str] = (),
                 keep_text: Sequence[str] = (), share: float = 0.5) -> DataFrame:
    """Repair types: parse dates, and cast a text column to double when most of all its rows are numbers."""
    out = df.withColumns({
        **{c: F.to_date(F.try_to_timestamp(c)) for c in existing(df, dates)},
        **{c: F.try_to_timestamp(c) for c in existing(df, timestamps)},
    })
    texts = [c for c in string_columns(out) if c not in keep_text]
    shares = numeric_share(out, texts)
    return out.withColumns({c: F.col(c).try_cast("double") for c in texts if shares[c] > share})


def wide_to_long(df: DataFrame, ids: Sequence[str], separator: str = "_", entity: str = "entity",
                 metric: str = "metric", value: str = "value", drop_null: bool = True) -> DataFrame:
    """Columns named ``{entity}{separator}{metric}`` to one row per entity and metric."""
    names = [c for c in df.columns if c not in ids]
    long = df.unpivot(list(ids), names, "_name", value)
    at = F.instr("_name", separator)
    out = long.select(
        *ids, F.substring_index("_name", separator, 1).alias(entity),
        F.substr("_name", at + len(separator)).alias(metric), value,
    )
    return out.dropna(subset=[value]) if drop_null else out


def long_to_wide(df: DataFrame, ids: Sequence[str], entity: str, entities: Sequence[str],
                 metrics: Mapping[str, Column]) -> DataFrame:
    """One ``{entity}_{metric}`` column per pair. The entity list is given, so no extra pass finds it."""
    return df.groupBy(*ids).pivot(entity, list(entities)).agg(*[c.alias(m) for m, c in metrics.items()])
