"""Point-in-time operators: reporting lag, fills and quarterly-to-daily expansion."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitpanel.functions.columns import missing, fractional, numeric_columns
from pitpanel.operators import arrays as entity_arrays
from pitpanel.operators import blocks
from pitpanel.operators.joins import join_checked, join_same
from pitpanel.operators.quantiles import quantile_name, quantile_table
from pitpanel.panel import Panel
from pitpanel.session import stable


def reporting_lag(df: DataFrame, date: str, days: int | Mapping[str, int] = 45,
                  series: str | None = None) -> DataFrame:
    """Move every record to the day it became known.

    ``days`` may be a map from the value of ``series`` to its own lag; unmapped series stay put.
    """
    if isinstance(days, Mapping):
        if series is None:
            raise ValueError("a map of lags needs the series column")
        shift: Column = F.lit(0)
        for name, n in days.items():
            shift = F.when(F.col(series) == name, F.lit(n)).otherwise(shift)
        return df.withColumn(date, F.date_add(date, shift))
    return df.withColumn(date, F.date_add(date, days))


def forward_fill(df: DataFrame, panel: Panel, columns: Sequence[str], blocked: bool = False) -> DataFrame:
    """Carry the last known value of each column forward inside its entity."""
    if blocked:
        return blocks.fill_forward(df, panel.entity, panel.order, columns)
    w = panel.upto()
    return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in columns})


def forward_backward_fill(df: DataFrame, panel: Panel, columns: Sequence[str], blocked: bool = False, arrays: bool = False) -> DataFrame:
    """Forward fill, then fill leading gaps from the future. Looks ahead: not point-in-time.

    Only rows before the first observation stay null after the forward fill, and their next known
    value is that first observation: one value per entity, read once. (A frame that starts at the
    current row would be evaluated anew for every row.) ``arrays`` fills an entity at daily grain column by column.
    """
    if arrays and panel.entity and not blocked:
        return entity_arrays.by_entity(df, panel, {}, entity_arrays.filled(columns))
    if blocked:
        position = F.struct(*panel.order)
        filled = blocks.fill_forward(df, panel.entity, panel.order, columns)
        firsts = filled.groupBy(*panel.entity).agg(
            *[F.min_by(c, F.when(F.col(c).isNotNull(), position)).alias(f"_n_{c}") for c in columns])
        out = join_checked(filled, stable(firsts), panel.entity)
        return out.select(*[F.coalesce(c, f"_n_{c}").alias(c) if c in columns else F.col(c) for c in df.columns])
    up = panel.upto()
    whole = panel.ordered().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return df.withColumns({
        c: F.coalesce(F.last(c, ignorenulls=True).over(up), F.first(c, ignorenulls=True).over(whole))
        for c in columns
    })


def fill_no_lookahead(df: DataFrame, panel: Panel, columns: Sequence[str] | None = None,
                      lead_median: bool = True, blocked: bool = False, first_valid: int = 10) -> DataFrame:
    """Forward fill, then (optionally) the median of the first valid rows for leading gaps.

    The median looks ahead: it uses values that were not known at the filled dates. Switch it off
    for a strict point-in-time panel.
    """
    cols = list(columns) if columns is not None else numeric_columns(df, panel.keys)
    numeric = set(numeric_columns(df))
    led = [c for c in cols if c in numeric] if lead_median else []
    if not blocked:
        out = forward_fill(df, panel, cols)
        if not led:
            return out
        out = out.withColumns({f"_k_{c}": F.count(c).over(panel.upto()) for c in led})
        medians = {c: _first_median(c, first_valid).over(panel.whole()) for c in led}
        return out.withColumns({c: F.coalesce(F.col(c), m) for c, m in medians.items()}).drop(*[f"_k_{c}" for c in led])
    if not led:
        return blocks.fill_forward(df, panel.entity, panel.order, cols)
    return blocks.fill_forward_and_lead(df, panel.entity, panel.order, cols, led, first_valid)


def _first_median(column: str, first_valid: int) -> Column:
    early = F.when(F.col(f"_k_{column}") <= first_valid, F.col(column).cast("double"))
    return F.percentile(early, F.lit(0.5))


def median_fill(df: DataFrame, panel: Panel, columns: Sequence[str], large: bool = False) -> DataFrame:
    """Replace remaining nulls by the entity median; an all-null column stays null.

    ``large`` takes the distributed quantiles, for entities of any size.
    """
    if large:
        medians = quantile_table(df, panel.entity, columns, [0.5])
        medians = medians.select(*panel.entity, *[F.col(quantile_name(c, 0.5)).alias(f"_m_{c}") for c in columns])
        joined = join_checked(df, medians, panel.entity, "left") if panel.entity else df.withColumns(
            {f"_m_{c}": medians.select(f"_m_{c}").scalar() for c in columns})
        return joined.withColumns({c: F.coalesce(c, f"_m_{c}") for c in columns}).drop(*[f"_m_{c}" for c in columns])
    w = panel.whole()
    return df.withColumns({
        c: F.coalesce(F.col(c), F.percentile(F.col(c).cast("double"), F.lit(0.5)).over(w)) for c in columns
    })


def fill_after_merge(df: DataFrame, panel: Panel, columns: Sequence[str] | None = None,
                     allow_lookahead: bool = True, blocked: bool = False, arrays: bool = False) -> DataFrame:
    """Forward fill, then backward fill; the median only ever helps columns that still have gaps.

    After both fills a column is either complete or all null inside its entity, and the median of
    an all-null column is null, so the median step has nothing left to do and is not computed.
    ``allow_lookahead=False`` stops after the forward fill.
    """
    cols = list(columns) if columns is not None else [c for c in df.columns if c not in panel.keys]
    return forward_backward_fill(df, panel, cols, blocked, arrays) if allow_lookahead else forward_fill(df, panel, cols, blocked)


def null_shares(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Percent of nulls per column: one aggregate pass, one row to the driver."""
    row = df.agg(
        F.count("*").alias("_n"),
        *[F.sum(missing(F.col(c), fractional(df, c)).cast("long")).alias(c) for c in columns],
    ).first()
    n = row["_n"] or 1
    return {c: 100.0 * (row[c] or 0) / n for c in columns}


def conditional_fill(df: DataFrame, panel: Panel, columns: Sequence[str], rule: str = "any",
                     threshold: float = 5.0, blocked: bool = False) -> DataFrame:
    """Forward/backward fill all columns only if the table needs it.

    ``rule='any'``: some column is more than ``threshold`` percent null; ``rule='mean'``: the
    average null percentage is above it.
    """
    shares = null_shares(df, columns)
    level = max(shares.values()) if rule == "any" else sum(shares.values()) / len(shares)
    return forward_backward_fill(df, panel, columns, blocked) if level > threshold else df


def total_debt(df: DataFrame, panel: Panel, long_term: str, short_term: str, name: str = "total_debt",
               blocked: bool = False) -> DataFrame:
    """Forward-filled long-term debt plus short-term debt; a missing part counts as zero."""
    out = forward_fill(df, panel, [long_term], blocked)
    return out.withColumn(name, F.coalesce(long_term, F.lit(0.0)) + F.coalesce(short_term, F.lit(0.0)))


def quarterly_to_daily(df: DataFrame, panel: Panel, attributes: Mapping[str, str | None] = {}) -> DataFrame:
    """One row per entity and calendar day, each holding the latest known value of every column.

    Days run from the first to the last date of the whole table; days before an entity's first
    record are null. ``attributes`` are constant per entity: they take the entity's first value on
    all days, or the given default (a column name or, with ``=`` in front, a text) when all are null.
    The fill happens at the low frequency; the days come from ``sequence``, so nothing is sorted at
    daily size. Of several records of an entity on one date the last by the panel's tie columns counts;
    without tie columns such a repeat is an error, because nothing says which record is the later one.
    """
    (date,) = [panel.date]
    span = df.agg(F.min(date).alias("lo"), F.max(date).alias("hi"))
    edge = span.select(F.struct("lo", "hi")).scalar()
    w = panel.ordered()
    values = [c for c in df.columns if c not in panel.keys and c not in attributes]
    staged = df.withColumns({
        **{c: F.last(c, ignorenulls=True).over(panel.upto()) for c in values},
        "_next": F.lead(date).over(w),
        "_first": F.row_number().over(w) == 1,
        **{c: _attribute(c, default, panel) for c, default in attributes.items()},
    }).withColumn("_edge", edge)
    if not panel.tie:
        several = F.raise_error(F.lit("an entity has several records on one date; the panel needs a tie column")).cast("date")
        staged = staged.withColumn("_next", F.when(F.col("_next") == F.col(date), several).otherwise(F.col("_next")))
    start = F.when(F.col("_first"), F.least(F.col("_edge.lo"), F.col(date))).otherwise(F.col(date))
    stop = F.coalesce(F.date_sub("_next", 1), F.greatest(F.col("_edge.hi"), F.col(date)))
    days = staged.withColumn("_day", F.explode(F.when(start <= stop, F.sequence(start, stop))))
    known = F.col("_day") >= F.col(date)
    cols = []
    for c in df.columns:
        if c == date:
            cols.append(F.col("_day").alias(date))
        elif c in values:
            cols.append(F.when(known, F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return days.select(*cols)


def _attribute(column: str, default: str | None, panel: Panel) -> Column:
    w = panel.ordered().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first = F.first(column).over(w)
    if default is None:
        return first
    other = F.lit(default[1:]) if default.startswith("=") else F.col(default)
    none_known = F.count(column).over(w) == 0
    return F.when(none_known, other.cast("string")).otherwise(first)


def asof_join(left: DataFrame, right: DataFrame, panel: Panel, columns: Sequence[str], blocked: bool = False) -> DataFrame:
    """For each left row the latest right value of each column at or before its date.

    Both sides are stacked and forward-filled in date order (right rows first on equal dates), so
    the join costs one shuffle and needs no range condition.
    """
    base = [c for c in left.columns]
    a = left.select(*base, *[F.lit(None).cast(right.schema[c].dataType).alias(c) for c in columns],
                    F.lit(1).alias("_side"))
    b = right.select(*panel.keys, *columns, F.lit(0).alias("_side"))
    both = a.unionByName(b, allowMissingColumns=True)
    filled = forward_fill(both, Panel(panel.entity, panel.date, ("_side", *panel.tie)), columns, blocked)
    return filled.filter("_side = 1").drop("_side")


def exact_date_join_fill(left: DataFrame, right: DataFrame, panel: Panel, columns: Sequence[str], blocked: bool = False) -> DataFrame:
    """Older form: match equal dates only, then forward fill. A right record dated on a day the
    left side lacks is lost; prefer ``asof_join``. A null entity is an entity."""
    out = join_same(left, right.select(*panel.keys, *columns), panel.keys, "left")
    return forward_fill(out, panel, columns, blocked)
