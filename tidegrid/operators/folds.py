"""Contiguous, unshuffled folds over time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid.operators.segments import row_index
from tidegrid.operators.windows import ordered


def series_folds(df: DataFrame, k: int = 5, *, by: Sequence[str], time: str = "month", out: str = "fold") -> DataFrame:
    """Fold 0..k-1 of each row in the time order of its series.

    Fold sizes differ by at most one and the larger folds come first.
    """
    return df.withColumn(out, F.ntile(k).over(ordered(by, time)) - 1)


def calendar_folds(df: DataFrame, k: int = 5, *, time: str = "month", out: str = "fold") -> DataFrame:
    """Give all rows of one period the same fold, with contiguous runs of periods per fold.

    Rows without a period are left out. Only the distinct periods are ordered globally; the calendar bounds them when ``time``
    is a date. Distinct timestamps grow with the rows: they are numbered by segments, and the first time of each fold is
    compared with the rows.
    """
    if isinstance(df.schema[time].dataType, (T.TimestampType, T.TimestampNTZType)):
        return _time_folds(df, k, time, out)
    periods = df.select(time).distinct().withColumn(out, F.ntile(k).over(Window.orderBy(time)) - 1)
    return df.join(periods, time)


def _time_folds(df: DataFrame, k: int, time: str, out: str) -> DataFrame:
    at = F.unix_micros(F.col(time).cast("timestamp"))
    times = row_index(df.where(F.col(time).isNotNull()).select(at.alias("at")).distinct(), order=["at"], out="place")
    size, larger = divmod(times.count(), k)
    starts = {fold * size + min(fold, larger) for fold in range(1, k) if fold < larger or size}
    firsts = [r["at"] for r in times.where(F.col("place").isin(starts)).collect()] if starts else []
    fold = sum((F.when(at >= F.lit(first), 1).otherwise(0) for first in firsts), F.lit(0))
    rest = [c for c in df.columns if c not in (time, out)]
    return df.where(F.col(time).isNotNull()).select(time, *rest, fold.cast("int").alias(out))
