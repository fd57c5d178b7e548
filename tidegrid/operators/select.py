"""Row and column selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.operators.windows import ordered


def matching_columns(df: DataFrame, *fragments: str) -> list[str]:
    """Names of the columns that contain any of the fragments, in frame order."""
    return [c for c in df.columns if any(f in c for f in fragments)]


def select_matching(df: DataFrame, *fragments: str, keep: Sequence[str] = ()) -> DataFrame:
    return df.select(*keep, *[c for c in matching_columns(df, *fragments) if c not in keep])


def move_to_front(df: DataFrame, column: str) -> DataFrame:
    return df.select(column, *[c for c in df.columns if c != column])


def drop_last_period(df: DataFrame, *, by: Sequence[str], time: str = "month") -> DataFrame:
    """Drop the last row of each series: the one without a successor."""
    kept = df.withColumn("_next", F.lead(time).over(ordered(by, time)))
    return kept.where(F.col("_next").isNotNull()).drop("_next")


def latest_row(df: DataFrame, *, by: Sequence[str], time: str = "month") -> DataFrame:
    """Last row of each series. A ranked window lets Spark keep one row per series and task
    before the shuffle."""
    w = Window.partitionBy(*by).orderBy(F.col(time).desc())
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") == 1).drop("_rank")


def add_row_index(df: DataFrame, *, by: Sequence[str], time: str = "month", out: str = "row_idx") -> DataFrame:
    """0-based position of each row in the time order of its series."""
    return df.withColumn(out, F.row_number().over(ordered(by, time)) - 1)


def lookback(df: DataFrame, ts: str, lo, hi) -> DataFrame:
    """Half-open date range on the raw column, so that the filter reaches the file scan."""
    return df.where((F.col(ts) >= F.lit(lo)) & (F.col(ts) < F.lit(hi)))
