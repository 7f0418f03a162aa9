"""Steps over whole entities of a daily panel, held as Arrow columns.

At daily grain an entity is bounded by the calendar, so a task may hold all its columns. Sums and deviations of all frames of n rows
then are merged from runs of 1, 2, 4, ... rows, column by column; no value leaves a sum again, so nothing cancels out. Steps that
follow each other directly on one panel share one pass over the rows. Missing values, NaN and zero denominators count as in the window forms.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from pitpanel.panel import Panel

Columns = Mapping[str, pa.Array]
Step = Callable[[Columns], Columns]
Parts = tuple[np.ndarray, ...]


def by_entity(df: DataFrame, panel: Panel, adds: Mapping[str, T.DataType], step: Step) -> DataFrame:
    """``df`` with the columns ``adds``, which ``step`` makes of the columns of an entity in the order of the panel.

    If ``df`` itself comes from here, for the same panel, its steps and this one run in the same pass.
    """
    base, made_for, before = df.__dict__.get("_by_entity", (df, panel, ()))
    if made_for != panel:
        base, before = df, ()
    steps = (*before, step)
    kinds = {f.name: f.dataType for f in df.schema.fields} | dict(adds)
    names, order = list(kinds), [(c, "ascending") for c in panel.order]

    def whole(table: pa.Table) -> pa.Table:
        table = table.take(pc.sort_indices(table, sort_keys=order, null_placement="at_start")).combine_chunks()
        columns = {c: _one(table.column(c)) for c in table.column_names}
        for each in steps:
            columns |= each(columns)
        return pa.table([columns[c] for c in names], names=names)

    out = base.groupBy(*panel.entity).applyInArrow(whole, T.StructType([T.StructField(c, kind) for c, kind in kinds.items()]))
    out._by_entity = (base, panel, steps)
    return out


def _one(column: pa.ChunkedArray) -> pa.Array:
    return column.chunk(0) if column.num_chunks == 1 else pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)


def numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values as doubles, 0 where missing, and which are there."""
    there = np.ones(len(column), bool) if not column.null_count else column.is_valid().to_numpy(zero_copy_only=False)
    values = column if column.type == pa.float64() else column.cast(pa.float64(), safe=False)
    return (values.fill_null(0.0) if column.null_count else values).to_numpy(zero_copy_only=False), there


def doubles(values: np.ndarray, there: np.ndarray) -> pa.Array:
    return pa.array(values, pa.float64(), mask=~there, from_pandas=False)


def picked(column: pa.Array, at: np.ndarray) -> pa.Array:
    """The values at these rows; a row below 0 gives null."""
    return column.take(pa.array(at, pa.int64(), mask=at < 0))


def last_rows(there: np.ndarray) -> np.ndarray:
    """For each row the last one so far that has a value, or -1."""
    return np.maximum.accumulate(np.where(there, np.arange(len(there)), -1))


def above(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a > b`` with NaN above every number, as Spark orders them."""
    return (a > b) | (np.isnan(a) & ~np.isnan(b))


def _held(there: np.ndarray, rows: int) -> np.ndarray:
    """Values in the frame of the last ``rows`` rows."""
    total = np.cumsum(there, dtype=np.int64)
    total[rows:] -= total[:-rows].copy()
    return total


def _back(values: np.ndarray, rows: int) -> np.ndarray:
    """The value so many rows before; 0 before the first row."""
    return np.concatenate([np.zeros(min(rows, len(values)), values.dtype), values[: max(len(values) - rows, 0)]]) if rows else values


def _over_frames(parts: Parts, rows: int, merged: Callable[[Parts, Parts], Parts]) -> Parts:
    """``merged`` over the last ``rows`` rows of each row: runs of 1, 2, 4, ... rows are made of two each, a frame of a few of these."""
    out, at, size = None, 0, 1
    while True:
        if rows & size:
            earlier = tuple(_back(x, at) for x in parts)
            out, at = earlier if out is None else merged(earlier, out), at + size
        if 2 * size > rows:
            return out
        parts, size = merged(tuple(_back(x, size) for x in parts), parts), 2 * size


def _sums(values: np.ndarray, rows: int) -> np.ndarray:
    (total,) = _over_frames((values,), rows, lambda a, b: (a[0] + b[0],))
    return total


def _spreads(a: Parts, b: Parts) -> Parts:
    """Count, mean and squared deviations of two runs as those of one; equal values have no deviation at all."""
    (n, mean, squares), (more, other, rest) = a, b
    count = n + more
    far = np.where((n > 0) & (more > 0), other - mean, 0.0)
    share = more / np.maximum(count, 1.0)
    return count, np.where(n > 0, mean + far * share, other), squares + rest + far * far * n * share


def _divided(a: np.ndarray, b: np.ndarray, there: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    there = there & (b != 0)
    with np.errstate(all="ignore"):
        return np.divide(a, b, out=np.zeros(len(a)), where=there), there


def lags(specs: Mapping[str, tuple[str, int]]) -> Step:
    return lambda columns: {name: picked(columns[c], np.arange(len(columns[c])) - n) for name, (c, n) in specs.items()}


def changes(specs: Mapping[str, tuple[str, int]], scale: float) -> Step:
    def step(columns: Columns) -> Columns:
        out = {}
        for name, (c, n) in specs.items():
            values, there = numbers(columns[c])
            rows = last_rows(there)
            before = np.concatenate([np.full(n, -1), rows])[: len(rows)]
            share, known = _divided(values[rows], values[before], (rows >= 0) & (before >= 0))
            with np.errstate(all="ignore"):
                out[name] = doubles((share - 1) * scale, known)
        return out

    return step


def means(specs: Mapping[str, tuple[str, int]], least: Mapping[str, int]) -> Step:
    """Means of frames with at least so many values."""
    def step(columns: Columns) -> Columns:
        out = {}
        for name, (c, n) in specs.items():
            values, there = numbers(columns[c])
            held = _held(there, n)
            with np.errstate(all="ignore"):
                out[name] = doubles(_sums(values, n) / np.maximum(held, 1), held >= max(least[name], 1))
        return out

    return step


def deviations(specs: Mapping[str, tuple[str, int]], least: Mapping[str, int], scale: float = 1.0) -> Step:
    """Sample deviations of frames with at least so many values, two at any rate."""
    def step(columns: Columns) -> Columns:
        out = {}
        for name, (c, n) in specs.items():
            values, there = numbers(columns[c])
            one = (there.astype(float), values, np.zeros(len(values)))
            with np.errstate(all="ignore"):
                held, _, squares = _over_frames(one, n, _spreads)
                out[name] = doubles(np.sqrt(squares / np.maximum(held - 1, 1)) * scale, held >= max(least[name], 2))
        return out

    return step


def strength(column: str, name: str, rows: int) -> Step:
    """Relative strength index; a step next to a gap counts as no move."""
    def step(columns: Columns) -> Columns:
        values, there = numbers(columns[column])
        moved, known = np.zeros(len(values)), np.zeros(len(values), bool)
        with np.errstate(all="ignore"):
            moved[1:], known[1:] = values[1:] - values[:-1], there[1:] & there[:-1]
            held = np.minimum(np.arange(1, len(values) + 1), rows)
            up, down = (np.where(known & sign, size, 0.0) for sign, size in ((above(moved, np.zeros(1)), moved), (moved < 0, -moved)))
            gain, loss = (_sums(x, rows) / held for x in (up, down))
            share, some = _divided(gain, loss, np.ones(len(values), bool))
            return {name: doubles(100 - 100 / (1 + share), some)}

    return step


def averages(column: str, line: str, signal: str, spans: tuple[int, int, int]) -> Step:
    """Difference of two exponential averages, and its own average; see ``recursive.averages_of_entities``."""
    fast_share, slow_share, smooth_share = (2.0 / (span + 1) for span in spans)

    def weights(share: float, gap: int) -> tuple[float, float]:
        old = (1.0 - share) ** gap
        return old / (old + share), share / (old + share)

    def step(columns: Columns) -> Columns:
        of_gap: dict[int, tuple[float, float, float, float]] = {}
        old_smooth, new_smooth = weights(smooth_share, 1)
        fast = slow = smooth = value = None
        gap, lines, signals = 1, [], []
        for x in columns[column].cast(pa.float64(), safe=False).to_pylist():
            if x is None:
                gap += 1
            else:
                if fast is None:
                    fast = slow = x
                else:
                    if gap not in of_gap:
                        of_gap[gap] = (*weights(fast_share, gap), *weights(slow_share, gap))
                    a, b, c, d = of_gap[gap]
                    fast, slow = a * fast + b * x, c * slow + d * x
                gap, value = 1, fast - slow
            if value is not None:
                smooth = value if smooth is None else old_smooth * smooth + new_smooth * value
            lines.append(value)
            signals.append(smooth)
        return {line: pa.array(lines, pa.float64()), signal: pa.array(signals, pa.float64())}

    return step


def trend(column: str, name: str, rows: int) -> Step:
    def step(columns: Columns) -> Columns:
        values, there = numbers(columns[column])
        first = np.maximum(np.arange(len(values)) - (rows - 1), 0)
        rising = there & there[first] & above(values, values[first])
        return {name: pa.array(rising.astype(np.int32), pa.int32(), mask=_held(there, rows) == 0)}

    return step


def quantile(ordered: Sequence[float] | np.ndarray, p: float) -> float:
    """Linear interpolation between sorted values, as ``percentile`` does."""
    at = p * (len(ordered) - 1)
    low, high = int(np.floor(at)), int(np.ceil(at))
    return float(ordered[low]) if low == high else float((high - at) * ordered[low] + (at - low) * ordered[high])


def clipped(columns_to_clip: Sequence[str], probs: Sequence[float], over: int) -> Step:
    """Columns clipped to two quantiles; those with at most ``over`` values stay as they are."""
    def step(columns: Columns) -> Columns:
        out = {}
        for c in columns_to_clip:
            values, there = numbers(columns[c])
            known = values if there.all() else values[there]
            if len(known) > over:
                ranks = sorted({int(k) for p in probs for k in (np.floor(p * (len(known) - 1)), np.ceil(p * (len(known) - 1)))})
                placed = np.partition(known, ranks)
                with np.errstate(all="ignore"):
                    low, high = (np.full(1, quantile(placed, p)) for p in probs)
                values = np.where(above(low, values), low, np.where(above(values, high), high, values))
            out[c] = doubles(values, there)
        return out

    return step


def filled(columns_to_fill: Sequence[str]) -> Step:
    """The last known value, or the first of all where nothing is known yet."""
    def step(columns: Columns) -> Columns:
        out = {}
        for c in columns_to_fill:
            if 0 < columns[c].null_count < len(columns[c]):
                there = columns[c].is_valid().to_numpy(zero_copy_only=False)
                rows = last_rows(there)
                out[c] = picked(columns[c], np.where(rows < 0, int(np.argmax(there)), rows))
        return out

    return step
