"""Exact, interpolating quantiles of whole columns on frames of any size.

``percentile`` keeps every distinct value of a group in one task. That is right for a series that
was reduced to one row per period, and wrong for a raw column. Here an order statistic is found by narrowing a value range
around it. One scan gives the extremes and a coarse mergeable sketch, which proposes a range; the next counts the rows below
and inside, for all ranges at once. A rank among few rows is picked from the counts of their values in order. Among more, a
scan counts the two ends apart, where most ties are, and sketches what lies between them for a range inside. A range that misses its rank is replaced by its neighbour up to the last known end. Counts decide and sketches only
propose, so the result is exact whatever the distribution, and no task ever sorts more than ``SORTED_ROWS`` rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

#: A sketch places a quantile within a share of 1 / ACCURACY of the rows; ranges reach MARGIN such shares to each side.
ACCURACY, MARGIN = 2_000, 2
#: Rows between the ends of a range that are sorted, in one task.
SORTED_ROWS = 500_000
#: Quantiles that a scan sketches between the ends of a range.
GRID = [i / 200 for i in range(201)]


@dataclass(frozen=True)
class Edges:
    """Row count, extremes and bracketing values (by probability) of one column."""

    rows: int
    lo: float | None
    hi: float | None
    around: dict[float, tuple[float, float]]


@dataclass(frozen=True)
class _Range:
    """Values ``lo`` to ``hi`` of a column that should hold its order statistic ``rank`` (0-based).

    ``floor`` and ``ceiling`` are ends that are known to hold it; the column has ``rows`` values. After a scan, ``below`` rows
    are smaller than ``lo`` and ``inside`` lie in the range. If the ends are counted apart (``apart``), ``at_lo`` and ``at_hi``
    rows are at them, ``inside`` between them, and ``grid`` has the values at the shares ``GRID`` of those.
    """

    column: int
    rank: int
    lo: float
    hi: float
    floor: float
    ceiling: float
    apart: bool = False
    below: int = 0
    at_lo: int = 0
    inside: int = 0
    at_hi: int = 0
    grid: tuple[float, ...] = ()

    @property
    def offset(self) -> int:
        """Place of the rank among the rows inside."""
        return self.rank - self.below - self.at_lo

    @property
    def found(self) -> float | None:
        if 0 <= self.rank - self.below < (self.inside if self.lo == self.hi else self.at_lo):
            return self.lo
        if 0 <= self.offset - self.inside < self.at_hi:
            return self.hi
        return None

    @property
    def few(self) -> bool:
        return 0 <= self.offset < self.inside <= SORTED_ROWS

    def holds(self, value: Column) -> Column:
        """Whether a value counts as inside."""
        if self.apart:
            return (value > F.lit(self.lo)) & (value < F.lit(self.hi))
        return value.between(F.lit(self.lo), F.lit(self.hi))

    def narrowed(self) -> _Range:
        """Where to look next."""
        if self.rank < self.below:
            return replace(self, lo=self.floor, hi=self.lo, ceiling=self.lo, apart=False, at_lo=0, at_hi=0)
        if self.offset >= self.inside + self.at_hi:
            return replace(self, lo=self.hi, hi=self.ceiling, floor=self.hi, apart=False, at_lo=0, at_hi=0)
        if not self.apart:
            return replace(self, apart=True)
        share, reach = self.offset / self.inside, MARGIN / ACCURACY
        lower = [v for p, v in zip(GRID, self.grid) if p <= share - reach]
        upper = [v for p, v in zip(GRID, self.grid) if p >= share + reach]
        return replace(self, floor=self.lo, ceiling=self.hi, lo=lower[-1] if lower else self.grid[0],
                       hi=upper[0] if upper else self.grid[-1])


def _sides(probs: Sequence[float]) -> list[float]:
    reach = MARGIN / ACCURACY
    return [min(1.0, max(0.0, p + side)) for p in probs for side in (-reach, reach)]


def edge_aggregates(columns: Sequence[str], probs: Sequence[float]) -> list[Column]:
    """Aggregates that :func:`read_edges` understands; add them to any pass over the data."""
    values = [F.col(c).cast("double") for c in columns]
    plain = [agg(v).alias(f"_{k}{i}") for i, v in enumerate(values)
             for k, agg in (("n", F.count), ("lo", F.min), ("hi", F.max))]
    return plain + [F.percentile_approx(v, _sides(probs), ACCURACY).alias(f"_q{i}") for i, v in enumerate(values)]


def read_edges(row: Row, columns: Sequence[str], probs: Sequence[float]) -> dict[str, Edges]:
    out = {}
    for i, c in enumerate(columns):
        q = row[f"_q{i}"] or []
        out[c] = Edges(row[f"_n{i}"], row[f"_lo{i}"], row[f"_hi{i}"], dict(zip(probs, zip(q[::2], q[1::2]))))
    return out


def _value(columns: Sequence[str], r: _Range) -> Column:
    return F.col(columns[r.column]).cast("double")


def _alike(ranges: Sequence[_Range]) -> list[list[_Range]]:
    """Ranges with the same ends together: neighbouring ranks mostly are."""
    out: dict[tuple, list[_Range]] = {}
    for r in ranges:
        out.setdefault((r.column, r.lo, r.hi, r.apart), []).append(r)
    return list(out.values())


def _count(df: DataFrame, columns: Sequence[str], ranges: Sequence[_Range]) -> list[_Range]:
    """The counts, and grids where the ends are apart, of all ranges: one scan, one aggregate."""
    parts, groups = [], _alike(ranges)
    for i, (r, *_) in enumerate(groups):
        v = _value(columns, r)
        parts += [F.count_if(v < F.lit(r.lo)).alias(f"_below{i}"), F.count_if(r.holds(v)).alias(f"_in{i}")]
        if r.apart:
            parts += [F.count_if(v == F.lit(r.lo)).alias(f"_lo{i}"), F.count_if((v == F.lit(r.hi)) & F.lit(r.lo < r.hi)).alias(f"_hi{i}"),
                      F.percentile_approx(F.when(r.holds(v), v), GRID, ACCURACY).alias(f"_grid{i}")]
    row = df.agg(*parts).first().asDict()
    return [replace(r, below=row[f"_below{i}"], inside=row[f"_in{i}"], at_lo=row.get(f"_lo{i}", 0), at_hi=row.get(f"_hi{i}", 0),
                    grid=tuple(row.get(f"_grid{i}") or ())) for i, group in enumerate(groups) for r in group]


def _sorted_ranks(df: DataFrame, columns: Sequence[str], ranges: Sequence[_Range]) -> dict[tuple[int, int], float]:
    """Values of the ranks of ranges with few rows between their ends: one scan, and their counts in order."""
    if not ranges:
        return {}
    groups = _alike(ranges)
    cells = [F.when(r.holds(_value(columns, r)), F.struct(F.lit(i).alias("range"), _value(columns, r).alias("value")))
             for i, (r, *_) in enumerate(groups)]
    inside = df.select(F.inline(F.filter(F.array(*cells), lambda x: x.isNotNull())))
    counts = inside.groupBy("range", "value").agg(F.count("*").alias("rows"))
    # At most SORTED_ROWS rows to a window.
    up_to = Window.partitionBy("range").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    spots = F.array(*[F.array(*[F.lit(r.offset).cast("bigint") for r in group]) for group in groups])
    placed = counts.withColumn("end", F.sum("rows").over(up_to)).select(
        "range", "value", "end", "rows", F.explode(F.get(spots, F.col("range"))).alias("spot"))
    held = placed.where((F.col("end") - F.col("rows") <= F.col("spot")) & (F.col("spot") < F.col("end")))
    found = {(r["range"], r["spot"]): r["value"] for r in held.collect()}
    return {(r.column, r.rank): found[i, r.offset] for i, group in enumerate(groups) for r in group}


def quantiles_from_edges(
    df: DataFrame, edges: dict[str, Edges], probs: Sequence[float]
) -> dict[str, list[float | None]]:
    """:func:`column_quantiles` for columns whose edges are already known."""
    columns, limits = list(edges), list(edges.values())
    ranges = {}
    for i, e in enumerate(limits):
        for p in probs if e.rows else ():
            lo, hi = e.around[p]
            for rank in (math.floor(p * (e.rows - 1)), math.ceil(p * (e.rows - 1))):
                ranges[i, rank] = _Range(i, rank, lo, hi, e.lo, e.hi)
    exact: dict[tuple[int, int], float] = {}
    few = []
    open_ranges = list(ranges.values())
    while open_ranges:
        scanned, open_ranges = _count(df, columns, open_ranges), []
        for r in scanned:
            if r.found is not None:
                exact[r.column, r.rank] = r.found
            elif r.few:
                few.append(r)
            else:
                open_ranges.append(r.narrowed())
    exact |= _sorted_ranks(df, columns, few)

    def interpolated(i: int, p: float) -> float | None:
        n = limits[i].rows
        if not n:
            return None
        spot = p * (n - 1)
        lo, hi = exact[i, math.floor(spot)], exact[i, math.ceil(spot)]
        return lo if lo == hi else lo + (hi - lo) * (spot - math.floor(spot))

    return {c: [interpolated(i, p) for p in probs] for i, c in enumerate(columns)}


def column_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> dict[str, list[float | None]]:
    """Exact quantiles with linear interpolation for each column, ignoring missing values.

    Scans ``df`` three times up to about 10^8 rows, and once or twice more for every factor of 100 beyond (or where a sketch
    was off); returns a handful of numbers. Write an expensive ``df`` first.
    """
    edges = read_edges(df.agg(*edge_aggregates(columns, probs)).first(), columns, probs)
    return quantiles_from_edges(df, edges, probs)


def column_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Exact median of each column, ignoring missing values; ``None`` for an empty column."""
    return {c: q[0] for c, q in column_quantiles(df, columns, [0.5]).items()}
