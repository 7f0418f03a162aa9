"""Time-series features. All frames count rows and include the current one.

Every function adds columns to the frame it gets. They share one window specification per panel,
so Spark plans a chain of them over a single shuffle and sort. With ``arrays`` the entities of a panel at daily grain are
held as arrays instead, and a chain of such calls is one pass over the rows, whatever the length of its frames.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitpanel.functions.columns import flag, ratio
from pitpanel.operators import arrays as entity_arrays
from pitpanel.operators import blocks, recursive
from pitpanel.operators.joins import join_checked
from pitpanel.panel import Panel

TRADING_DAYS = 252

#: Frames of more rows than this are put together from sums of RADIX, RADIX squared, ... rows; deviations, which merge at a higher cost, from more rows on.
SHORT_FRAME, SHORT_DEVIATION = 24, 120
RADIX = 6
#: Tables with more columns sum up each frame: every level of sums passes all rows on, which costs by their width.
NARROW = 10


def lag_features(df: DataFrame, panel: Panel, columns: Sequence[str], lags: Sequence[int] = (1, 5, 22),
                 suffix: str = "_lag{n}", blocked: bool = False, arrays: bool = False) -> DataFrame:
    if arrays:
        specs = {c + suffix.format(n=n): (c, n) for c in columns for n in lags}
        return entity_arrays.by_entity(df, panel, {name: df.schema[c].dataType for name, (c, _) in specs.items()}, entity_arrays.lags(specs))

    def build(w: WindowSpec) -> dict[str, Column]:
        return {c + suffix.format(n=n): F.lag(c, n).over(w) for c in columns for n in lags}

    if blocked:
        return blocks.with_halo(df, panel.entity, panel.order, max(lags), build)
    return df.withColumns(build(panel.ordered()))


def moving_average(df: DataFrame, panel: Panel, specs: Mapping[str, tuple[str, int]], min_rows: int = 1,
                   blocked: bool = False, arrays: bool = False) -> DataFrame:
    """``{output: (column, rows)}``; fewer than ``min_rows`` values give NULL."""
    if arrays:
        return _double_arrays(df, panel, specs, entity_arrays.means(specs, _least(specs, min_rows)))
    return _rolling(df, panel, specs, F.avg, min_rows, blocked)


def rolling_std(df: DataFrame, panel: Panel, specs: Mapping[str, tuple[str, int]], min_rows: int = 1,
                blocked: bool = False, arrays: bool = False) -> DataFrame:
    if arrays:
        return _double_arrays(df, panel, specs, entity_arrays.deviations(specs, _least(specs, min_rows)))
    return _rolling(df, panel, specs, F.stddev_samp, min_rows, blocked)


def _double_arrays(df: DataFrame, panel: Panel, names: Iterable[str], step: entity_arrays.Step) -> DataFrame:
    return entity_arrays.by_entity(df, panel, dict.fromkeys(names, T.DoubleType()), step)


def _least(specs: Mapping[str, tuple[str, int]], min_rows: int) -> dict[str, int]:
    """Values that a frame needs; 0 means a full frame."""
    return {name: n if min_rows == 0 else min_rows for name, (_, n) in specs.items()}


def _rolling(df, panel, specs, agg, min_rows, blocked) -> DataFrame:
    def build(w: WindowSpec, some=specs) -> dict[str, Column]:
        out = {}
        for name, (c, n) in some.items():
            frame = w.rowsBetween(-(n - 1), 0)
            value = agg(c).over(frame)
            need = n if min_rows == 0 else min_rows
            out[name] = value if need <= 1 else F.when(F.count(c).over(frame) >= need, value)
        return out

    if blocked:
        return blocks.with_halo(df, panel.entity, panel.order, max(n for _, n in specs.values()) - 1, build)
    long = _long_frames(df, specs, SHORT_DEVIATION if agg is F.stddev_samp else SHORT_FRAME)
    out = df.withColumns(build(panel.ordered(), {name: x for name, x in specs.items() if name not in long}))
    if not long:
        return out
    out = _composed(out, panel.ordered(), long, agg is F.stddev_samp)
    for name, (_, n) in long.items():
        need = n if min_rows == 0 else min_rows
        if need > 1:
            out = out.withColumn(name, F.when(F.col(f"_n_{name}") >= need, F.col(name)))
    return out.drop(*[f"_n_{name}" for name in long]).select(*df.columns, *[x for x in specs if x not in df.columns])


def _long_frames(df: DataFrame, specs: Mapping[str, tuple[str, int]], short: int) -> dict[str, tuple[str, int]]:
    """Specs whose frames are long and whose columns are numbers that a frame sums up in doubles."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    if len(kinds) > NARROW:
        return {}
    plain = (T.DoubleType, T.FloatType, T.IntegralType)
    return {name: (c, n) for name, (c, n) in specs.items() if n > short and name not in kinds and isinstance(kinds.get(c), plain)}


def _parts(rows: int, sizes: Sequence[int]) -> list[tuple[int, int]]:
    """A frame of ``rows`` rows as runs of the given sizes (one of them 1): size and distance of the last row of each run."""
    out, at = [], 0
    for size in sorted(sizes, reverse=True):
        while rows - at >= size:
            out.append((size, at))
            at += size
    return out


def _composed(df: DataFrame, w: WindowSpec, specs: Mapping[str, tuple[str, int]], deviation: bool) -> DataFrame:
    """Means (or sample deviations) over long frames, and ``_n_{name}``, the values in the frame.

    A frame is evaluated anew for each row, at a cost of its length. Here each row has the sums of the last 6, 36, ... rows, each from
    six of the size before, and a frame takes a few of these: no value leaves a sum again, so nothing cancels out. Counts,
    means and squared deviations are merged the same way.
    """
    columns = sorted({c for c, _ in specs.values()})
    name = lambda kind, size, c: f"_{kind}{size}_{columns.index(c)}"
    base = {}
    for c in columns:
        x = F.col(c).cast("double")
        base |= {name("n", 1, c): x.isNotNull().cast("double"), name("m", 1, c): x if deviation else F.coalesce(x, F.lit(0.0))}
    out, sizes = df.withColumns(base), [1]
    longest = max(n for _, n in specs.values())

    def add(wanted: Mapping[tuple[str, str, str], tuple[str, list[tuple[int, int]]]]) -> None:
        """``{(names of count, mean or sum, squares): (column, parts)}``"""
        nonlocal out
        at = lambda kind, size, c, back, *other: F.lag(name(kind, size, c), back, *other).over(w) if back else F.col(name(kind, size, c))
        if not deviation:
            out = out.withColumns({
                x: sum((at(kind, size, c, back, 0.0) for size, back in parts), F.lit(0.0))
                for names, (c, parts) in wanted.items() for x, kind in zip(names, "nm")})
            return
        held, means, squares = {}, {}, {}
        for names, (c, parts) in wanted.items():
            for k, (size, back) in enumerate(parts):
                held |= {f"_at{k}{x}": at(kind, size, c, back, *other) for x, kind, other in zip(names, "nm", ((0.0,), ()))}
                if size > 1:
                    held[f"_at{k}{names[2]}"] = at("q", size, c, back, 0.0)
            count, mean, square = names
            n = lambda k: F.col(f"_at{k}{count}")  # noqa: E731, B023
            m = lambda k: F.col(f"_at{k}{mean}")  # noqa: E731, B023
            every = range(len(parts))
            means[count] = sum((n(k) for k in every), F.lit(0.0))
            # distances to one of the means, so equal values have no deviation at all
            some = F.coalesce(*[m(k) for k in every])
            shift = sum((F.coalesce(n(k) * (m(k) - some), F.lit(0.0)) for k in every), F.lit(0.0))
            means[mean] = F.when(means[count] > 0, some + shift / means[count])
            squares[square] = sum((F.coalesce(n(k) * (m(k) - F.col(mean)) * (m(k) - F.col(mean)), F.lit(0.0)) for k in every), F.lit(0.0))
            squares[square] = sum((F.col(f"_at{k}{square}") for k, (size, _) in enumerate(parts) if size > 1), squares[square])
        out = out.withColumns(held).withColumns(means).withColumns(squares).drop(*held)

    while sizes[-1] * RADIX <= longest:
        size = sizes[-1] * RADIX
        add({tuple(name(kind, size, c) for kind in "nmq"): (c, _parts(size, sizes)) for c in columns if any(c == x and n >= size for x, n in specs.values())})
        sizes.append(size)
    add({(f"_n_{x}", x, f"_q_{x}"): (c, _parts(n, sizes)) for x, (c, n) in specs.items()})
    n = lambda x: F.col(f"_n_{x}")
    if deviation:
        out = out.withColumns({x: F.when(n(x) > 1, F.sqrt(F.col(f"_q_{x}") / (n(x) - 1))) for x in specs})
    else:
        out = out.withColumns({x: F.when(n(x) > 0, F.col(x) / n(x)) for x in specs})
    own = {name(kind, size, c) for kind in "nmq" for size in sizes for c in columns}
    return out.drop(*own, *[f"_q_{x}" for x in specs])


def _stages(df: DataFrame, panel: Panel, lookback: int, build: Callable[[WindowSpec], Sequence[Mapping[str, Column]]],
            blocked: bool, lookahead: int = 0) -> DataFrame:
    """Sets of window columns that build on each other; ``blocked`` cuts entities into slabs of bounded size."""
    if blocked:
        return blocks.with_halo(df, panel.entity, panel.order, lookback, build, lookahead=lookahead)
    for columns in build(panel.ordered()):
        df = df.withColumns(dict(columns))
    return df


def _trailing(w: WindowSpec, rows: int) -> WindowSpec:
    return w.rowsBetween(-(rows - 1), 0)


def pct_change(df: DataFrame, panel: Panel, specs: Mapping[str, tuple[str, int]], scale: float = 100.0,
               blocked: bool = False, arrays: bool = False) -> DataFrame:
    """Relative change over n rows of the padded column (gaps carry the last value first)."""
    if arrays:
        return _double_arrays(df, panel, specs, entity_arrays.changes(specs, scale))
    pads = {c: f"_pad_{c}" for c in {c for c, _ in specs.values()}}

    def changes(w: WindowSpec) -> list[dict[str, Column]]:
        return [{
            name: (ratio(F.col(pads[c]), F.lag(pads[c], n).over(w)) - 1) * F.lit(scale) for name, (c, n) in specs.items()
        }]

    if blocked:
        padded = blocks.fill_forward(df.withColumns({p: F.col(c) for c, p in pads.items()}), panel.entity, panel.order, list(pads.values()))
    else:
        padded = df.withColumns({p: F.last(c, ignorenulls=True).over(panel.upto()) for c, p in pads.items()})
    return _stages(padded, panel, max(n for _, n in specs.values()), changes, blocked).drop(*pads.values())


def annualized_volatility(df: DataFrame, panel: Panel, specs: Mapping[str, tuple[str, int]], blocked: bool = False,
                          arrays: bool = False) -> DataFrame:
    if arrays:
        return _double_arrays(df, panel, specs, entity_arrays.deviations(specs, _least(specs, 1), math.sqrt(TRADING_DAYS)))
    root = F.sqrt(F.lit(float(TRADING_DAYS)))
    if not blocked:
        return rolling_std(df, panel, specs).withColumns({name: F.col(name) * root for name in specs})
    return _stages(df, panel, max(n for _, n in specs.values()) - 1, lambda w: [{
        name: F.stddev_samp(c).over(_trailing(w, n)) * root for name, (c, n) in specs.items()
    }], blocked)


def relative_to_average(df: DataFrame, panel: Panel, specs: Mapping[str, tuple[str, int]], blocked: bool = False) -> DataFrame:
    """Value divided by its own moving average."""
    if not blocked:
        means = moving_average(df, panel, {f"_ma_{name}": x for name, x in specs.items()})
        return means.withColumns({name: ratio(F.col(c), F.col(f"_ma_{name}")) for name, (c, _) in specs.items()}).drop(*[f"_ma_{name}" for name in specs])
    return _stages(df, panel, max(n for _, n in specs.values()) - 1, lambda w: [{
        name: ratio(F.col(c), F.avg(c).over(_trailing(w, n))) for name, (c, n) in specs.items()
    }], blocked)


def rsi(df: DataFrame, panel: Panel, column: str, name: str, rows: int = 14, blocked: bool = False, arrays: bool = False) -> DataFrame:
    """Relative strength index. A step next to a gap counts as no move; no loss at all gives NULL."""
    if arrays:
        return _double_arrays(df, panel, [name], entity_arrays.strength(column, name, rows))
    step = F.col("_step")

    def build(w: WindowSpec) -> list[dict[str, Column]]:
        frame = _trailing(w, rows)
        gain = F.avg(F.when(step > 0, step).otherwise(0.0)).over(frame)
        loss = F.avg(F.when(step < 0, -step).otherwise(0.0)).over(frame)
        return [{"_step": F.col(column) - F.lag(column).over(w)}, {name: 100 - 100 / (1 + ratio(gain, loss))}]

    return _stages(df, panel, rows, build, blocked).drop("_step")


def macd(df: DataFrame, panel: Panel, column: str, name: str = "macd", signal: str = "macd_signal",
         spans: tuple[int, int, int] = (12, 26, 9), blocked: bool = False, arrays: bool = False) -> DataFrame:
    """MACD line and signal from recursive exponential averages.

    Averages carry over gaps, and an old average has less weight the longer the gap. At daily grain an entity is one bounded
    array that a fold walks through; ``blocked`` composes the recursion over slabs, for entities of any size.
    """
    if arrays:
        return _double_arrays(df, panel, [name, signal], entity_arrays.averages(column, name, signal, spans))
    walk = recursive.averages_of_any_size if blocked else recursive.averages_of_entities
    return walk(df, panel.entity, panel.order, column, name, signal, spans)


def trend_flag(df: DataFrame, panel: Panel, column: str, name: str, rows: int = 90, blocked: bool = False, arrays: bool = False) -> DataFrame:
    """1 if the last row of the frame is above its first row, else 0; NULL while nothing is known."""
    if arrays:
        return entity_arrays.by_entity(df, panel, {name: T.IntegerType()}, entity_arrays.trend(column, name, rows))

    def build(w: WindowSpec) -> list[dict[str, Column]]:
        frame = _trailing(w, rows)
        rising = (F.count(F.lit(1)).over(frame) > 1) & (F.last(column).over(frame) > F.first(column).over(frame))
        return [{name: F.when(F.count(column).over(frame) > 0, flag(rising))}]

    return _stages(df, panel, rows - 1, build, blocked)


def base_index(df: DataFrame, panel: Panel, column: str, name: str, base: float = 100.0) -> DataFrame:
    """The column relative to the first row of its entity, found by one combined aggregate: safe for hot entities."""
    first = df.groupBy(*panel.entity).agg(F.min_by(F.struct(F.col(column).alias("v")), F.struct(*panel.order)).alias("_first"))
    joined = join_checked(df, first, panel.entity) if panel.entity else df.withColumn("_first", first.select("_first").scalar())
    return joined.withColumn(name, ratio(F.col(column), F.col("_first.v")) * F.lit(base)).drop("_first")


def forward_targets(df: DataFrame, panel: Panel, column: str, specs: Mapping[str, int],
                    scale: float = 100.0, blocked: bool = False) -> DataFrame:
    """Change from this row to n rows ahead: labels for a model, not features."""
    return _stages(df, panel, 0, lambda w: [{
        name: (ratio(F.lead(column, n).over(w), F.col(column)) - 1) * F.lit(scale) for name, n in specs.items()
    }], blocked, lookahead=max(specs.values()))


def max_date_gap(df: DataFrame, panel: Panel, limit_days: int = 30, blocked: bool = False) -> DataFrame:
    """Largest distance between consecutive dates per entity, and whether it exceeds the limit."""
    steps = _stages(df.select(*panel.entity, *panel.order), panel, 1, lambda w: [{"_gap": F.datediff(panel.date, F.lag(panel.date).over(w))}], blocked)
    return steps.groupBy(*panel.entity).agg(F.max("_gap").alias("max_gap_days")).withColumn(
        "gap_warning", flag(F.col("max_gap_days") > limit_days)
    )
