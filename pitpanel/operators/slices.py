"""Slice metrics and bias checks. Slices are group keys, never copies of the table."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitpanel.functions.columns import fractional, missing, ratio
from pitpanel.operators.drift import EXACT_PAIRS, ks_p, ks_p_value
from pitpanel.operators.features import volatility_regime
from pitpanel.operators.joins import join_checked, join_same
from pitpanel.session import stable

# fixed values: deviation from an equal share, imbalance and missing limits
SHARE_LIMIT = 0.3
IMBALANCE_LIMIT = 5.0
MISSING_LIMIT_PCT = 5.0


def metrics(df: DataFrame, date: str, returns: str | None = None, level: str | None = None) -> list[Column]:
    """Size, missing percent of cells, return mean and deviation, mean level and days covered."""
    cells = sum((missing(F.col(c), fractional(df, c)).cast("long") for c in df.columns), F.lit(0).cast("long"))
    out = [
        F.count("*").alias("n_samples"),
        F.round(F.sum(cells) * 100.0 / (F.count("*") * len(df.columns)), 2).alias("missing_pct"),
        F.datediff(F.max(date), F.min(date)).cast("long").alias("date_range_days"),
    ]
    if returns:
        out += [F.round(F.avg(returns), 4).alias("return_mean"), F.round(F.stddev_samp(returns), 4).alias("return_std")]
    if level:
        out.append(F.avg(level).alias("level_mean"))
    return out


def slice_metrics(df: DataFrame, dimensions: Sequence[str], date: str, returns: str | None = None,
                  level: str | None = None) -> DataFrame:
    """Metrics of every value of every dimension, from one pass with grouping sets."""
    aggs = metrics(df, date, returns, level)
    keyed = df.withColumns({f"_d_{d}": F.col(d).cast("string") for d in dimensions})
    grouped = keyed.groupingSets([[f"_d_{d}"] for d in dimensions], *[f"_d_{d}" for d in dimensions]).agg(
        F.grouping_id().alias("_gid"), *aggs)
    n = len(dimensions)
    name, value = F.lit(None), F.lit(None)
    for i, d in enumerate(dimensions):
        # the grouping id has a 0 bit for the one dimension that is grouped
        here = F.col("_gid") == (2**n - 1) - 2 ** (n - 1 - i)
        name = F.when(here, F.lit(d)).otherwise(name)
        value = F.when(here, F.col(f"_d_{d}")).otherwise(value)
    keep = [c for c in grouped.columns if not c.startswith("_")]
    return grouped.select(name.alias("dimension"), value.alias("slice"), *keep)


def temporal_slices(df: DataFrame, date: str, periods: Mapping[str, tuple[int, int]], returns: str | None = None,
                    level: str | None = None) -> DataFrame:
    """Metrics per named range of years; ranges may overlap, so a row may count in several."""
    year = F.year(date)
    aggs = metrics(df, date, returns, level)
    named = F.array_compact(F.array(*[F.when(year.between(a, b), F.lit(p)) for p, (a, b) in periods.items()]))
    return df.withColumn("period", F.explode(named)).groupBy("period").agg(*aggs)


def regime_slices(df: DataFrame, date: str, volatility: str, regime: str | None = None, returns: str | None = None) -> DataFrame:
    """Metrics per market regime: an existing regime column, else bins of the volatility."""
    aggs = metrics(df, date, returns)
    label = F.col(regime) if regime and regime in df.columns else volatility_regime(F.col(volatility))
    return df.groupBy(label.alias("regime")).agg(*aggs)


#: Cuts of the value range at which the distributions of all slices are known exactly.
CUTS = 256
#: Rows of a part of the value range, while there are fewer parts than cuts.
PART_ROWS = 100_000
#: Cells of the table of running shares that one step of a walk holds.
WALK_CELLS = 4_000_000


def _largest_gaps(batches: Iterator[Any]) -> Iterator[Any]:
    """Largest distance of each pair of slices over one part of the value range; all rows come in order.

    First the slices (``a`` number, ``b`` rows, ``c`` rows below the part), then the pairs (``a`` and ``b`` slices, ``c`` pair), then the
    values ``v`` (``a`` slice, ``c`` rows). A distance can only be largest where one of the two slices has a value, so
    each slice meets its partners at its own values.
    """
    import numpy as np
    import pyarrow as pa

    heads: dict[int, list[Any]] = {0: [], 1: []}
    ready = None

    def start() -> tuple:
        slices, pairs = (np.concatenate(heads[k]) if heads[k] else np.zeros((0, 3), "int64") for k in (0, 1))
        slices = slices[np.argsort(slices[:, 0])]
        one, two = (np.searchsorted(slices[:, 0], pairs[:, k]) for k in (0, 1))
        here, there, ids = np.concatenate([one, two]), np.concatenate([two, one]), np.tile(np.arange(len(pairs)), 2)
        by = np.argsort(here, kind="stable")
        ends = np.searchsorted(here[by], np.arange(len(slices) + 1))
        partners = [(there[by[lo:hi]], ids[by[lo:hi]]) for lo, hi in zip(ends, ends[1:])]
        return slices, pairs, partners, slices[:, 2].astype("float64"), np.zeros(len(pairs))

    def walk(v, k, c) -> None:
        slices, _, partners, below, best = ready
        first = np.r_[True, (v[1:] != v[:-1]) & ~(np.isnan(v[1:]) & np.isnan(v[:-1]))]
        place, starts = np.cumsum(first) - 1, np.flatnonzero(first)
        step = max(1, WALK_CELLS // max(1, len(slices)))
        for at in range(0, len(starts), step):
            lo, hi = starts[at], starts[at + step] if at + step < len(starts) else len(v)
            mine, p = k[lo:hi], place[lo:hi] - at
            share = np.zeros((len(slices), int(p[-1]) + 1))
            share[mine, p] = c[lo:hi]
            share[:, 0] += below
            np.cumsum(share, axis=1, out=share)
            below[:] = share[:, -1]
            share /= slices[:, 1:2]
            order = np.argsort(mine, kind="stable")
            ends = np.searchsorted(mine[order], np.arange(len(slices) + 1))
            for i in np.unique(mine):
                others, ids = partners[i]
                values = p[order[ends[i]:ends[i + 1]]]
                few = max(1, WALK_CELLS // len(values))
                for x in range(0, len(others), few):
                    gaps = np.abs(share[i, values] - share[np.ix_(others[x:x + few], values)]).max(axis=1)
                    best[ids[x:x + few]] = np.maximum(best[ids[x:x + few]], gaps)

    # the rows of the last value wait for the next batch, which may have more of it
    waiting = None
    for batch in batches:
        kind, v, a, b, c = (x.to_numpy(zero_copy_only=False) for x in batch.columns)
        for h in (0, 1):
            if (kind == h).any():
                heads[h].append(np.stack([a, b, c], axis=1)[kind == h])
        held = kind == 2
        if not held.any():
            continue
        ready = ready or start()
        v, k, c = v[held].astype("float64"), np.searchsorted(ready[0][:, 0], a[held]), c[held]
        if waiting is not None:
            v, k, c = (np.concatenate([x, y]) for x, y in zip(waiting, (v, k, c)))
        same = np.isnan(v) if np.isnan(v[-1]) else v == v[-1]
        cut = int(np.argmax(same))
        if cut:
            walk(v[:cut], k[:cut], c[:cut])
        waiting = v[cut:], k[cut:], c[cut:]
    if waiting is not None:
        walk(*waiting)
        yield pa.RecordBatch.from_arrays([pa.array(ready[1][:, 2]), pa.array(ready[4])], names=["pair", "gap"])


def _exact_gaps(rows: DataFrame, cdf: DataFrame, left: DataFrame) -> DataFrame:
    """``pair, ks_statistic`` of the pairs in ``left``, from one ordered walk over the values of their slices.

    Equal values are counted first. The value range is cut into parts at the common cuts, below which the counts of every slice are known, so
    parts are independent; a value goes to one part, once for all pairs, and a part reads its values as a sorted stream.
    """
    used = left.select(F.explode(F.array("k1", "k2")).alias("k")).distinct()
    slices = stable(cdf.join(used, "k").select("k", "s", "n", "below"))
    total = slices.agg(F.sum("n").alias("n")).first()["n"] or 0
    parts = min(CUTS, total // PART_ROWS + 1)
    part = lambda bin_: F.floor(bin_ * parts / CUTS).cast("int")
    # the first bin of a part is the first number k with floor(k * parts / CUTS) = part
    every = F.sequence(F.lit(0), F.lit(parts - 1))
    begun = F.explode(F.transform(every, lambda q: F.struct(q.alias("part"), F.element_at("below", F.ceil(q * CUTS / parts).cast("int") + 1).alias("c"))))
    heads = slices.select(begun.alias("x"), "k", "n").select(
        F.col("x.part").alias("part"), F.lit(0).alias("kind"), F.lit(None).cast("double").alias("v"), F.col("k").alias("a"), F.col("n").alias("b"), F.col("x.c").alias("c"))
    met = left.select(F.explode(every).alias("part"), F.lit(1).alias("kind"), F.lit(None).cast("double").alias("v"), F.col("k1").alias("a"), F.col("k2").alias("b"), F.col("pair").alias("c"))
    counted = join_same(rows, F.broadcast(slices.select("s", "k")), ["s"]).groupBy("k", "bin", "v").agg(F.count("*").alias("c"))
    values = counted.select(part(F.col("bin")).alias("part"), F.lit(2).alias("kind"), "v", F.col("k").alias("a"), F.lit(0).cast("long").alias("b"), "c")
    laid = heads.unionByName(met).unionByName(values).repartitionById(parts, F.col("part")).sortWithinPartitions("kind", "v")
    found = laid.select("kind", "v", "a", "b", "c").mapInArrow(_largest_gaps, "pair long, gap double")
    return found.groupBy("pair").agg(F.max("gap").alias("ks_statistic"))


def slice_ks_pairs(df: DataFrame, slice_column: str, values: Sequence[str] | None, feature: str, min_rows: int = 30,
                   alpha: float = 0.05) -> DataFrame:
    """Two-sample KS test between every pair of slices; keeps the significant ones, and pairs with fewer than
    ``min_rows`` rows on a side with ``tested`` false and no p-value.

    ``values`` names the slices to compare; None compares all, null included. Each slice is counted once between common cuts of the
    value range. These counts bound the distance of every pair from above; pairs whose bound is not significant
    are done. The others get the exact running comparison, all in one walk over the values.
    """
    s = F.col(slice_column)
    rows = df.filter(F.col(feature).isNotNull()).select(s.alias("s"), F.col(feature).cast("double").alias("v"))
    if values is not None:
        rows = rows.filter(s.isin(*values))
    cuts = rows.agg(F.array_distinct(F.percentile_approx("v", [k / CUTS for k in range(1, CUTS)], 10 * CUTS)).alias("x")).scalar()
    # the number of cuts below a value, by halves: bin k holds the values up to cut k
    halves = F.array(*[F.lit(1 << k) for k in reversed(range((CUTS - 1).bit_length()))])
    place = F.aggregate(halves, F.lit(0), lambda at, half: F.when(F.get("_cuts", at + half - 1) < F.col("v"), at + half).otherwise(at))
    rows = rows.withColumn("_cuts", cuts).select("s", "v", place.alias("bin"))
    binned = stable(rows.groupBy("s", "bin").agg(F.count("*").alias("n"), F.sum("v").alias("sum")))
    listed = binned.groupBy("s").agg(F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("bins"), F.sum("n").alias("n"), F.sum("sum").alias("sum"))
    upto = F.transform(F.sequence(F.lit(0), F.lit(CUTS - 1)), lambda k: F.coalesce(F.try_element_at("bins", k), F.lit(0)))
    shares = F.aggregate(upto, F.array(F.lit(0).cast("long")), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))
    order = F.struct(F.col("s").isNotNull(), "s")
    if values is not None:
        at = F.create_map(*[F.lit(x) for k, v in enumerate(values) for x in (v, k)])
        order = F.struct(at[F.col("s")])
    numbered = listed.select("s", order.alias("at"), "n", (F.col("sum") / F.col("n")).alias("mean"), shares.alias("below"))
    numbered = stable(numbered.withColumn("k", F.row_number().over(Window.orderBy("at")).cast("long")))
    cdf = numbered.select("s", "at", "k", "n", "mean", F.transform("below", lambda x: x / F.col("n")).alias("f"))
    # one entry for each slice; a pair of them is an answer of its own
    every = cdf.agg(F.collect_list(F.struct(*cdf.columns)).alias("x")).scalar()
    a = cdf.select(*[F.col(c).alias(f"{c}1") for c in cdf.columns]).withColumn("_every", every)
    pairs = a.withColumn("_b", F.explode(F.filter("_every", lambda x: x["at"] > F.col("at1")))).drop("_every")
    pairs = pairs.select(*[f"{c}1" for c in cdf.columns], *[F.col(f"_b.{c}").alias(f"{c}2") for c in cdf.columns])
    # inside a bin one distribution may already have all it gains there while the other has none of it
    gaps = F.zip_with(F.zip_with("f1", F.slice("f2", 2, CUTS + 1), lambda x, y: F.struct(x.alias("x"), y.alias("y"))),
                      F.zip_with("f2", F.slice("f1", 2, CUTS + 1), lambda x, y: F.struct(x.alias("x"), y.alias("y"))),
                      lambda p, q: F.greatest(F.coalesce(p["y"] - p["x"], F.lit(0.0)), F.coalesce(q["y"] - q["x"], F.lit(0.0))))
    tested = (F.col("n1") >= min_rows) & (F.col("n2") >= min_rows)
    most = F.least(F.lit(1.0), F.array_max(gaps) + 1e-12)
    # written down, or each term of the series would compare the two slices anew
    bounded = stable(pairs.select("s1", "s2", "k1", "k2", "n1", "n2", (F.col("mean1") - F.col("mean2")).alias("mean_diff"), most.alias("most")))
    # small samples have a test of their own, and little to compare
    open_pairs = ~tested | (F.col("n1") * F.col("n2") <= EXACT_PAIRS) | (ks_p_value(F.col("most"), F.col("n1"), F.col("n2")) < alpha)
    left = stable(bounded.filter(open_pairs).drop("most").withColumn("pair", F.monotonically_increasing_id()))
    exact = _exact_gaps(rows, numbered, left)
    out = left.join(exact, "pair").select(
        F.lit(feature).alias("feature"), F.col("s1").alias("slice1"), F.col("s2").alias("slice2"), "ks_statistic", "n1", "n2", "mean_diff",
        tested.alias("tested"), F.when(tested, ks_p(F.col("ks_statistic"), F.col("n1"), F.col("n2"))).alias("p_value"))
    return stable(out).filter(~F.col("tested") | (F.col("p_value") < alpha))


def representation_bias(df: DataFrame, entity: str, limit: float = SHARE_LIMIT) -> DataFrame:
    """Entities whose row count deviates from an equal share by more than the limit."""
    n = df.groupBy(entity).agg(F.count("*").alias("n_samples"))
    expected = n.agg(F.avg("n_samples").alias("e")).scalar()
    out = n.withColumn("deviation", F.col("n_samples") / expected - 1)
    status = F.when(F.col("deviation") < -limit, "under").when(F.col("deviation") > limit, "over").otherwise("balanced")
    return out.withColumn("status", status)


def imbalance_ratio(df: DataFrame, dimension: str, limit: float = IMBALANCE_LIMIT) -> DataFrame:
    n = df.groupBy(dimension).agg(F.count("*").alias("_n"))
    out = n.agg(F.max("_n").alias("max_samples"), F.min("_n").alias("min_samples"))
    out = out.withColumn("imbalance_ratio", F.col("max_samples") / F.col("min_samples"))
    return out.withColumn("imbalanced", F.col("imbalance_ratio") > limit)


def temporal_quality_bias(slices: DataFrame, limit_pct: float = MISSING_LIMIT_PCT) -> DataFrame:
    """Periods whose missing percent exceeds the limit."""
    return slices.filter(F.col("missing_pct") > limit_pct).select(
        F.lit("Temporal Quality Bias").alias("type"), "period", F.lit("MEDIUM").alias("severity"), "missing_pct")


def sample_weights(df: DataFrame, entity: str, name: str = "weight") -> DataFrame:
    """Each row weighs one over the row count of its entity; the counts are combined map-side."""
    n = df.groupBy(entity).agg((1.0 / F.count("*")).alias(name))
    return join_checked(df, n, [entity])


# fixed values: bias type -> advice
ADVICE = {
    "Representation Bias": "sample stratified by entity, or weight the loss by one over the entity row count",
    "Sector Imbalance": "split stratified by sector",
    "Temporal Quality Bias": "include crisis periods in validation",
}
NO_ADVICE = "data is balanced, nothing to mitigate"


def bias_report(representation: DataFrame, imbalance: DataFrame, temporal: DataFrame) -> DataFrame:
    """Detected bias types with severity, number of affected slices and advice; one row if none."""
    r = representation.agg(F.count(F.when(F.col("status") != "balanced", 1)).alias("n")).select(
        F.lit("Representation Bias").alias("type"), F.lit("HIGH").alias("severity"), "n")
    s = imbalance.agg(F.count(F.when(F.col("imbalanced"), 1)).alias("n")).select(
        F.lit("Sector Imbalance").alias("type"), F.lit("MEDIUM").alias("severity"), "n")
    t = temporal.agg(F.count("*").alias("n")).select(
        F.lit("Temporal Quality Bias").alias("type"), F.lit("MEDIUM").alias("severity"), "n")
    found = r.unionByName(s).unionByName(t)
    advice = F.create_map(*[F.lit(x) for pair in ADVICE.items() for x in pair])
    listed = found.filter("n > 0").withColumn("advice", advice[F.col("type")])
    none = found.agg(F.sum("n").alias("n")).filter("n = 0").select(
        F.lit("none").alias("type"), F.lit("INFO").alias("severity"), "n", F.lit(NO_ADVICE).alias("advice"))
    return listed.unionByName(none)
