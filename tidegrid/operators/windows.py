"""Window specifications shared by the ordered operators.

``by`` holds the series key(s). Every ordered operator runs on frames that were already reduced to
at most one row per series and period, so a window partition is never longer than the calendar,
whatever the number of raw observations of its series. An empty ``by`` is for frames with one row
per period in total. Longer orders belong to :mod:`tidegrid.operators.segments`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Window, WindowSpec


def ordered(by: Sequence[str], *order: str) -> WindowSpec:
    return Window.partitionBy(*by).orderBy(*order)


def up_to_here(by: Sequence[str], *order: str) -> WindowSpec:
    return ordered(by, *order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def from_here(by: Sequence[str], *order: str) -> WindowSpec:
    return ordered(by, *order).rowsBetween(Window.currentRow, Window.unboundedFollowing)


def whole(by: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*by)
