"""Imputation: ordered carries, constants, medians and the full feature chain."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from heapq import heappush, heappushpop

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid.functions.numeric import inf_to_null
from tidegrid.operators.quantiles import edge_aggregates, quantiles_from_edges, read_edges
from tidegrid.operators.windows import from_here, up_to_here, whole


def _forward(col: str, by: Sequence[str], time: str) -> Column:
    return F.last(col, ignorenulls=True).over(up_to_here(by, time))


def _backward(col: str, by: Sequence[str], time: str) -> Column:
    return F.first(col, ignorenulls=True).over(from_here(by, time))


def ffill(df: DataFrame, columns: Sequence[str], *, by: Sequence[str], time: str = "month") -> DataFrame:
    """Carry the last known value forward within each series."""
    return df.withColumns({c: _forward(c, by, time) for c in columns})


def ffill_bfill(df: DataFrame, columns: Sequence[str], *, by: Sequence[str], time: str = "month") -> DataFrame:
    """Carry forward, then fill what is left at the start from the first known value."""
    return df.withColumns({c: F.coalesce(_forward(c, by, time), _backward(c, by, time)) for c in columns})


def fill_constant(df: DataFrame, columns: Sequence[str], value: float = 0.0) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(value)) for c in columns})


def fill_median(df: DataFrame, columns: Sequence[str], *, by: Sequence[str]) -> DataFrame:
    """Fill with the median of the column inside each series.

    The median is a window aggregate over the series, so it runs on the partitioning the ordered
    operators already use, with no statistics join whose size would grow with the series count.
    """
    w = whole(by)
    gaps = {c: f"_gaps{i}" for i, c in enumerate(columns)}
    # Series without gaps feed no values to their median, which is the costly part.
    counted = df.withColumns({gap: F.count(F.when(F.col(c).isNull(), 1)).over(w) for c, gap in gaps.items()})
    medians = {c: F.median(F.when(F.col(gap) > 0, F.col(c))).over(w) for c, gap in gaps.items()}
    return counted.withColumns({c: F.coalesce(F.col(c), m) for c, m in medians.items()}).drop(*gaps.values())


def _order_keys(values: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of doubles, NaN last; the same step leads back."""
    bits = values.view(np.int64)
    return bits ^ ((bits >> 63) & np.int64((1 << 63) - 1))


def running_medians(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Median of the known values up to each place, NaN before the first.

    The lower half is kept in a heap with its largest on top, the upper half in one with its least on top, so a value costs
    the logarithm of their number.
    """
    below: list[int] = []  # negated
    above: list[int] = []
    middle = np.zeros((len(values), 2), dtype=np.int64)
    for i, (key, seen) in enumerate(zip(_order_keys(values).tolist(), known.tolist())):
        if seen and len(below) == len(above):
            heappush(below, -heappushpop(above, key))
        elif seen:
            heappush(above, -heappushpop(below, -key))
        if below:
            middle[i] = -below[0], -below[0] if len(below) > len(above) else above[0]
    lo, hi = _order_keys(middle.reshape(-1)).view(np.float64).reshape(-1, 2).T
    with np.errstate(invalid="ignore"):
        return np.where(np.cumsum(known) == 0, np.nan, np.where(lo == hi, lo, 0.5 * lo + 0.5 * hi))


def fill_expanding_median(df: DataFrame, columns: Sequence[str], *, by: Sequence[str], time: str = "month") -> DataFrame:
    """Fill with the median of the values known up to each row of the series: nothing later is looked at.

    What precedes the first known value stays missing. A running ``percentile`` sorts all values so far for every row; here a
    task goes through a series once, with two heaps for each column. Filled columns become doubles.
    """
    schema = T.StructType([T.StructField(f.name, T.DoubleType() if f.name in columns else f.dataType) for f in df.schema])

    def fill(series: pa.Table) -> pa.Table:
        series = series.take(pc.sort_indices(series, sort_keys=[(time, "ascending")], null_placement="at_start"))
        for c in columns:
            cells = series[c].combine_chunks()
            known = cells.is_valid().to_numpy(zero_copy_only=False)
            medians = running_medians(cells.fill_null(0.0).to_numpy(zero_copy_only=False), known)
            filled = pc.if_else(pa.array(known), cells, pa.array(medians, mask=np.cumsum(known) == 0))
            series = series.set_column(series.schema.get_field_index(c), c, filled)
        return series

    rows = df.withColumns({c: F.col(c).cast("double") for c in columns})
    return rows.groupBy(*by).applyInArrow(fill, schema)


def fill_values(df: DataFrame, values: Mapping[str, float | None]) -> DataFrame:
    """Fill each column with its fitted statistic; a plain projection."""
    known = {c: v for c, v in values.items() if v is not None}
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(float(v))) for c, v in known.items()}) if known else df


def fill_global_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill with whole-column medians of a frame of any size.

    Fits first, exactly; columns without gaps cost no more than their count.
    """
    row = df.agg(*edge_aggregates(columns, [0.5]), F.count("*").alias("_rows")).first()
    gappy = {c: e for c, e in read_edges(row, columns, [0.5]).items() if e.rows < row["_rows"]}
    medians = quantiles_from_edges(df, gappy, [0.5])
    return fill_values(df, {c: q[0] for c, q in medians.items()})


def impute_chain(
    df: DataFrame,
    *,
    levels: Sequence[str] = (),
    changes: Sequence[str] = (),
    returns: Sequence[str] = (),
    by: Sequence[str],
    time: str = "month",
    bfill: bool = True,
) -> DataFrame:
    """The feature imputation chain; the order of its steps matters.

    Levels are carried forward (and back, unless ``bfill`` is off), missing changes become 0,
    missing returns the median of the series, then infinities become missing and everything still
    missing becomes the median of its column as it stands after the infinities are gone.
    """
    carry = ffill_bfill if bfill else ffill
    out = carry(df, levels, by=by, time=time) if levels else df
    out = fill_constant(out, changes) if changes else out
    out = fill_median(out, returns, by=by) if returns else out
    touched = [*levels, *changes, *returns]
    out = out.withColumns({c: inf_to_null(F.col(c)) for c in touched})
    return fill_median(out, touched, by=by)
