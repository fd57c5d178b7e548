"""Explicit schemas. Types are never inferred: inference reads ``yyyy-MM`` labels as timestamps
and an all-empty column as text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import types as T

PRICES = "series_id string, ts date, adj_close double"
OBSERVATIONS = "series_id string, ts date, value double"

CALENDAR = ("Year", "Month", "Quarter")
LAGS = (1, 2, 3)


def change_columns(indicators: Sequence[str]) -> list[str]:
    return [f"{i}_YOY" for i in indicators] + [f"{i}_MOM" for i in indicators]


def lag_columns(ticker: str) -> list[str]:
    return [f"{ticker}_Return_Prev{k}M" for k in LAGS]


def target_column(ticker: str) -> str:
    return f"Next_Month_{ticker}"


def dataset_columns(tickers: Sequence[str], indicators: Sequence[str]) -> list[str]:
    """Column order of the monthly dataset, without its leading ``Date`` label."""
    return [
        *CALENDAR,
        *indicators,
        *change_columns(indicators),
        *[c for t in tickers for c in lag_columns(t)],
        *[target_column(t) for t in tickers],
    ]


def dataset_schema(tickers: Sequence[str], indicators: Sequence[str]) -> T.StructType:
    kinds = {c: T.IntegerType() for c in CALENDAR}
    return T.StructType(
        [T.StructField("Date", T.StringType())]
        + [T.StructField(c, kinds.get(c, T.DoubleType())) for c in dataset_columns(tickers, indicators)]
    )
