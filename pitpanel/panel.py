"""The key description every panel operator works with."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Window, WindowSpec


@dataclass(frozen=True)
class Panel:
    """Keys of a panel: entity columns, the date column and optional tie-break columns.

    Window operators called with ``blocked=False`` expect daily grain, that is at most one row
    (or a small fixed number of rows) per entity and calendar day; ``operators.dedupe`` and any
    ``groupBy(entity, day)`` produce it with map-side combining. An entity then owns at most one
    row per calendar day (about 36,500 rows a century), so no window group grows with the data
    and no entity can be hot. Frames at a finer grain use ``blocked=True`` or
    ``operators.blocks``, which cut every entity into slabs of bounded size.
    """

    entity: tuple[str, ...] = ()
    date: str = "dt"
    tie: tuple[str, ...] = ()

    @property
    def order(self) -> list[str]:
        return [self.date, *self.tie]

    @property
    def keys(self) -> list[str]:
        return [*self.entity, self.date]

    def ordered(self) -> WindowSpec:
        return Window.partitionBy(*self.entity).orderBy(*self.order)

    def trailing(self, rows: int) -> WindowSpec:
        """The current row and the ``rows - 1`` rows before it."""
        return self.ordered().rowsBetween(-(rows - 1), 0)

    def upto(self) -> WindowSpec:
        return self.ordered().rowsBetween(Window.unboundedPreceding, 0)

    def whole(self) -> WindowSpec:
        return Window.partitionBy(*self.entity)
