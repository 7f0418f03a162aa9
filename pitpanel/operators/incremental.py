"""A panel that grows by batches: what the next batch needs of the past is a small state for each entity.

The state holds the last rows of each entity, with their fills already made: as many as the longest window looks
back. A batch is put behind them, the same function that builds a whole panel runs over both, and only the rows of the batch are
kept. So a batch costs what it holds and ``rows`` rows for each entity, however long the panel already is, and base
plus batches equal a panel that is built at once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitpanel.operators.joins import join_same
from pitpanel.panel import Panel


def panel_state(df: DataFrame, panel: Panel, columns: Sequence[str], rows: int, state: DataFrame | None = None) -> DataFrame:
    """The last ``rows`` rows of each entity, with the ``columns`` that later windows read.

    ``df`` has the rows of the newest batch, filled; ``state`` what was kept before it. Spark limits each entity before the shuffle as well.
    """
    kept = df.select(*panel.entity, *panel.order, *columns)
    if state is not None:
        kept = kept.unionByName(state)
    newest = Window.partitionBy(*panel.entity).orderBy(*[F.col(c).desc() for c in panel.order])
    return kept.withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") <= rows).drop("_rank")


def extend_panel(state: DataFrame, batch: DataFrame, panel: Panel, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``build`` over the state and the batch, without the rows of the state.

    ``build`` may only look back, by fills or by windows of at most as many rows as the state keeps.
    Rows of the batch that are not newer than the state belong to ``late_rows``; they are left out here.
    """
    known = state.columns
    both = state.withColumn("_old", F.lit(True)).unionByName(_newer(state, batch, panel, True).select(*known).withColumn("_old", F.lit(False)))
    return build(both).filter(~F.col("_old")).drop("_old")


def late_rows(state: DataFrame, batch: DataFrame, panel: Panel) -> DataFrame:
    """Rows of a batch at or before the last date of their entity: their entities have to be built anew from that date on."""
    return _newer(state, batch, panel, False)


def _newer(state: DataFrame, batch: DataFrame, panel: Panel, newer: bool) -> DataFrame:
    last = state.groupBy(*panel.entity).agg(F.max(panel.date).alias("_last"))
    placed = join_same(batch, last, panel.entity, "left") if panel.entity else batch.withColumn("_last", last.select("_last").scalar())
    is_newer = F.col("_last").isNull() | (F.col(panel.date) > F.col("_last"))
    return placed.filter(is_newer if newer else ~is_newer).drop("_last")
