"""Resampling to a calendar grid, gap filling of the grid, and alignment of series."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.periods import period_sequence, period_start, shift_period
from tidegrid.operators.windows import ordered, up_to_here

_KEY_SPAN = Decimal(1 << 64)


def _last_order(ts: Column, tie_break: Column | None, text_key: bool) -> Column:
    """Ordering value for "last in period": the full time, then the key.

    Time and a whole-number key share one decimal of 38 digits (microseconds times 2^64 plus the key): a number lives in a
    hash-aggregation buffer. A struct does not; Spark would sort all raw rows before the partial aggregation instead
    (about six times slower on few, long series), which only text keys pay.
    """
    if tie_break is None:
        return ts
    if text_key:
        return F.struct(ts, tie_break)
    micros = F.unix_micros(ts.cast("timestamp")).cast("decimal(19,0)")
    return (micros * F.lit(_KEY_SPAN) + tie_break.cast("decimal(19,0)")).cast("decimal(38,0)")


def resample_last(
    df: DataFrame,
    *,
    by: Sequence[str],
    ts: str,
    value: str,
    grain: str = "month",
    tie_break: str | None = None,
    out_time: str = "month",
    out_value: str | None = None,
    sparse: bool = False,
) -> DataFrame:
    """Last non-missing value of each series in each period, one row per observed period.

    A period whose observations are all missing stays in the result with a missing value, so that
    it still counts for the extent of the series. ``tie_break`` is a key (any BIGINT, or text) that orders
    observations of the same time, a missing key before all others; without it, ``ts`` must be unique per series.

    The grouping is hash-aggregated map-side before the shuffle, so a hot series ships at most one
    row per period and task. ``sparse`` is for many series with about one row per period: rows are dealt by series first, and
    the windows that follow need no exchange of their own.
    """
    period = period_start(F.col(ts), grain)
    text_key = tie_break is not None and dict(df.dtypes)[tie_break] == "string"
    key = None if tie_break is None else F.coalesce(
        F.col(tie_break), F.lit("") if text_key else F.lit(-(1 << 63)))
    observed = F.when(F.col(value).isNotNull(), _last_order(F.col(ts), key, text_key))
    rows = df.repartition(*by) if sparse and by else df
    return rows.groupBy(*by, period.alias(out_time)).agg(
        F.max_by(F.col(value), observed).alias(out_value or value)
    )


def densify(df: DataFrame, *, by: Sequence[str], time: str = "month", grain: str = "month") -> DataFrame:
    """Add the missing periods between the first and last period of each series.

    Each row generates itself and the gap behind it, so there is no calendar table and no join:
    one window over the series, then a generator. Other columns are NULL on generated rows. Rows
    without a period belong to none and are left out.
    """
    values = [c for c in df.columns if c not in (*by, time)]
    step_back = shift_period(F.lead(time).over(ordered(by, time)), -1, grain)
    spans = df.withColumn("_until", F.coalesce(step_back, F.col(time)))
    grid = spans.withColumn("_at", F.explode(period_sequence(F.col(time), F.col("_until"), grain)))
    return grid.select(
        *by,
        F.col("_at").alias(time),
        *[F.when(F.col("_at") == F.col(time), F.col(c)).alias(c) for c in values],
    )


def align_wide(
    df: DataFrame,
    *,
    on: Sequence[str],
    series: str,
    columns: Mapping[str, tuple[object, str]],
) -> DataFrame:
    """Outer-align long series into one row per ``on`` key.

    ``columns`` maps each output column to ``(series id, value column)``. The result has every key
    at which any series has a row. Alignment is one grouped aggregate with map-side combine,
    instead of a chain of full outer joins.
    """
    cells = [F.max(F.when(F.col(series) == F.lit(sid), F.col(val))).alias(name)
             for name, (sid, val) in columns.items()]
    return df.groupBy(*on).agg(*cells)


def stack_long(frames: Sequence[DataFrame]) -> DataFrame:
    """Union long frames that carry different value columns."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def asof_carry(
    grid: DataFrame,
    low: DataFrame,
    *,
    by: Sequence[str],
    time: str,
    value: str,
    out: str = "carried",
) -> DataFrame:
    """Carry a low-frequency series onto the rows of a finer grid.

    Each grid row gets the latest non-missing ``low`` value at or before its period (``out``) and
    the value observed exactly in its period, if any (``value``). Both inputs are stacked and
    shuffled once by series; no range join.
    """
    mark = "_grid_row"
    stacked = stack_long([
        grid.withColumn(mark, F.lit(True)),
        low.select(*by, time, value).withColumn(mark, F.lit(False)),
    ])
    here = ordered(by, time, mark)
    same_period = F.lag(time).over(here) == F.col(time)
    exact = F.when(same_period, F.lag(value).over(here))
    return (
        stacked.withColumn(out, F.last(value, ignorenulls=True).over(up_to_here(by, time, mark)))
        .withColumn(value, F.when(F.col(mark), exact))
        .where(F.col(mark))
        .drop(mark)
    )
