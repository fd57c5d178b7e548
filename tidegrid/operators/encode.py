"""Calendar parts, one-hot and cyclic encodings. Fixed domains, so nothing is fitted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.periods import sin_cos_month

MONTH_FLAGS = {m: f"Month_{m:02d}" for m in range(1, 13)}
QUARTER_FLAGS = {q: f"Quarter_{q}" for q in range(1, 5)}


def calendar_parts(
    df: DataFrame, time: str = "month", *, year: str = "Year", month: str = "Month", quarter: str = "Quarter"
) -> DataFrame:
    at = F.col(time)
    return df.withColumns({year: F.year(at), month: F.month(at), quarter: F.quarter(at)})


def _flags(df: DataFrame, column: str, names: dict[int, str]) -> DataFrame:
    return df.withColumns({name: (F.col(column) == k).cast("int") for k, name in names.items()})


def onehot_month(df: DataFrame, column: str = "Month") -> DataFrame:
    return _flags(df, column, MONTH_FLAGS)


def onehot_quarter(df: DataFrame, column: str = "Quarter") -> DataFrame:
    return _flags(df, column, QUARTER_FLAGS)


def cyclic_month(df: DataFrame, column: str = "Month", *, sin: str = "Month_Sin", cos: str = "Month_Cos") -> DataFrame:
    s, c = sin_cos_month(F.col(column))
    return df.withColumns({sin: s, cos: c})
