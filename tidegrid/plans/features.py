"""From the supervised frame to a clean feature matrix and training frame."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.operators.encode import MONTH_FLAGS, QUARTER_FLAGS, cyclic_month, onehot_month, onehot_quarter
from tidegrid.operators.fill import fill_median, impute_chain
from tidegrid.operators.profile import require_columns
from tidegrid.operators.select import add_row_index
from tidegrid.sources.schemas import change_columns, lag_columns, target_column


def feature_columns(tickers: Sequence[str], indicators: Sequence[str]) -> list[str]:
    """Column order of the feature matrix."""
    return [
        "Year",
        *MONTH_FLAGS.values(),
        *QUARTER_FLAGS.values(),
        "Month_Sin", "Month_Cos",
        *indicators,
        *change_columns(indicators),
        *[c for t in tickers for c in lag_columns(t)],
    ]


def encode_calendar(frame: DataFrame) -> DataFrame:
    return cyclic_month(onehot_quarter(onehot_month(frame)))


def feature_matrix(
    frame: DataFrame,
    *,
    tickers: Sequence[str],
    indicators: Sequence[str],
    by: Sequence[str] = (),
    time: str = "period",
    keep: Sequence[str] = (),
    bfill: bool = True,
) -> DataFrame:
    """Encode the calendar, impute, and project the fixed feature list.

    ``by`` is the scope of fills and medians: the series of a panel, or nothing for a frame with
    one row per month.
    """
    imputed = impute_chain(
        encode_calendar(frame),
        levels=indicators,
        changes=change_columns(indicators),
        returns=[c for t in tickers for c in lag_columns(t)],
        by=by, time=time, bfill=bfill,
    )
    return imputed.select(*by, time, *feature_columns(tickers, indicators), *keep)


def training_frame(
    frame: DataFrame,
    *,
    tickers: Sequence[str],
    indicators: Sequence[str],
    run_date: date,
    by: Sequence[str] = (),
    time: str = "period",
    fill_labels: bool = True,
    keep_unlabelled: bool = False,
    bfill: bool = True,
) -> DataFrame:
    """Features, targets, 0-based row index and processing date.

    Missing targets become the median of their series. With ``fill_labels`` off, rows without all
    targets are left out, or kept as rows to score with ``keep_unlabelled``.
    """
    targets = [target_column(t) for t in tickers]
    require_columns(frame, targets)
    matrix = feature_matrix(frame, tickers=tickers, indicators=indicators, by=by, time=time, keep=targets, bfill=bfill)
    if fill_labels:
        labelled = fill_median(matrix, targets, by=by)
    else:
        labelled = matrix if keep_unlabelled else matrix.dropna(subset=targets)
    stamped = labelled.withColumn("Processing_Date", F.date_format(F.lit(run_date), "yyyy-MM-dd"))
    return add_row_index(stamped, by=by, time=time)


def panel_lags(own: DataFrame, *, by: Sequence[str], time: str = "period") -> DataFrame:
    """The lagged returns of each series, imputed inside the series."""
    return impute_chain(own, returns=lag_columns("Own"), by=by, time=time)


def panel_join(
    imputed: DataFrame,
    calendar: DataFrame,
    *,
    indicators: Sequence[str],
    by: Sequence[str],
    time: str = "period",
    keep: Sequence[str] = (),
    bfill: bool = True,
) -> DataFrame:
    """Feature matrix of a panel, from the rows of :func:`panel_lags` and the indicators of the calendar.

    Indicators are imputed on the calendar, once per month and not once per series and month, and joined at the end.
    """
    finished = impute_chain(calendar, levels=indicators, changes=change_columns(indicators), by=[], time=time, bfill=bfill)
    joined = encode_calendar(imputed).join(finished, time, "left")
    return joined.select(*by, time, *feature_columns(["Own"], indicators), *keep)


def panel_matrix(own: DataFrame, calendar: DataFrame, *, by: Sequence[str], time: str = "period", **options) -> DataFrame:
    """:func:`panel_join` of the series' own columns, their lagged returns imputed inside each series."""
    return panel_join(panel_lags(own, by=by, time=time), calendar, by=by, time=time, **options)
