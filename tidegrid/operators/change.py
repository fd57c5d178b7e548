"""Changes, returns, lags and leads. All expect the dense grid: an offset counts rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.functions.numeric import ieee_div, pct_change
from tidegrid.operators.windows import ordered


def percent_change(
    df: DataFrame, value: str, out: str, *, by: Sequence[str], time: str = "month", periods: int
) -> DataFrame:
    """Percent change against ``periods`` rows earlier, two decimals.

    A zero base gives a signed infinity, zero over zero is missing.
    """
    base = "_base"
    based = df.withColumn(base, F.lag(value, periods).over(ordered(by, time)))
    return based.withColumn(out, pct_change(F.col(value), F.col(base))).drop(base)


def yoy_change(df: DataFrame, value: str, out: str = "yoy", *, by: Sequence[str], time: str = "month") -> DataFrame:
    return percent_change(df, value, out, by=by, time=time, periods=12)


def mom_change(df: DataFrame, value: str, out: str = "mom", *, by: Sequence[str], time: str = "month") -> DataFrame:
    return percent_change(df, value, out, by=by, time=time, periods=1)


def period_return(
    df: DataFrame, value: str, out: str = "ret", *, by: Sequence[str], time: str = "month", pad: bool = True
) -> DataFrame:
    """Fractional return against the previous period, unrounded.

    ``pad`` carries the last known value through gaps first, so a gap shows a zero return.
    """
    level, base = "_level", "_base"
    levels = {level: known_before(value, 0, by, time), base: known_before(value, 1, by, time)} if pad else {
        level: F.col(value), base: F.lag(value).over(ordered(by, time))}
    return df.withColumns(levels).withColumn(out, ieee_div(F.col(level), F.col(base)) - F.lit(1.0)).drop(level, base)


def known_before(value: str, rows: int, by: Sequence[str], time: str) -> Column:
    """The last known value of all rows up to ``rows`` earlier (later, if negative).

    That is the value so many rows earlier once it is carried forward, in one window instead of two. (Later rows: if the
    series has no value in as many first ones, which an offset would not reach.)
    """
    return F.last(value, ignorenulls=True).over(ordered(by, time).rowsBetween(Window.unboundedPreceding, -rows))


def add_lags(
    df: DataFrame, value: str, names: Sequence[str], *, by: Sequence[str], time: str = "month"
) -> DataFrame:
    """Add ``value`` of 1, 2, ... rows earlier under the given names."""
    w = ordered(by, time)
    return df.withColumns({name: F.lag(value, k).over(w) for k, name in enumerate(names, start=1)})


def add_lead(
    df: DataFrame, value: str, name: str, *, by: Sequence[str], time: str = "month", periods: int = 1
) -> DataFrame:
    return df.withColumn(name, F.lead(value, periods).over(ordered(by, time)))
