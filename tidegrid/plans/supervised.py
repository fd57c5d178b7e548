"""The supervised monthly frame: features, lags and targets of many series on one calendar."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.numeric import fraction_to_percent
from tidegrid.functions.periods import period_label
from tidegrid.operators.change import add_lags, add_lead, known_before, mom_change, period_return, yoy_change
from tidegrid.operators.encode import calendar_parts
from tidegrid.operators.fill import ffill
from tidegrid.operators.grid import align_wide, densify, stack_long
from tidegrid.operators.select import drop_last_period, move_to_front
from tidegrid.sources.schemas import (
    change_columns,
    dataset_columns,
    lag_columns,
    target_column,
)

LAG_NAMES = ("lag1", "lag2", "lag3")


def indicator_features(monthly: DataFrame, *, by: Sequence[str], time: str = "period", value: str = "value") -> DataFrame:
    """Level and percent changes of each indicator on its own dense grid.

    Changes are taken before any carry, so a quarterly series has no monthly change and a yearly
    change in its observed months only.
    """
    dense = densify(monthly, by=by, time=time)
    return mom_change(yoy_change(dense, value, by=by, time=time), value, by=by, time=time)


def price_features(monthly: DataFrame, *, by: Sequence[str], time: str = "period", value: str = "value") -> DataFrame:
    """Lagged returns and the next period's return of each price series.

    Row t holds the returns of t-1, t-2, t-3 and the target of t+1; the return of t itself is not
    a feature.
    """
    returns = period_return(densify(monthly, by=by, time=time), value, by=by, time=time)
    lagged = add_lags(returns, "ret", LAG_NAMES, by=by, time=time)
    return add_lead(lagged, "ret", "next1", by=by, time=time)


def _indicator_cells(names: Mapping[object, str]) -> dict[str, tuple[object, str]]:
    return {f"{name}{suffix}": (sid, col) for sid, name in names.items()
            for suffix, col in (("", "value"), ("_YOY", "yoy"), ("_MOM", "mom"))}


def _price_cells(names: Mapping[object, str]) -> dict[str, tuple[object, str]]:
    cells = {}
    for sid, name in names.items():
        cells |= {col: (sid, lag) for col, lag in zip(lag_columns(name), LAG_NAMES)}
        cells[target_column(name)] = (sid, "next1")
    return cells


def supervised_frame(
    prices: DataFrame,
    observations: DataFrame,
    *,
    tickers: Mapping[object, str],
    indicators: Mapping[object, str],
    by: Sequence[str] = (),
    series: str = "series_id",
    time: str = "period",
    fill_targets: bool = True,
    drop_last: bool = True,
) -> DataFrame:
    """One row per month with calendar parts, indicators, changes, lagged returns and targets.

    ``prices`` and ``observations`` are monthly long frames ``(series, period, value)``; the two
    mappings give the column name of each series. (The time column is not called ``month``: column
    names ignore case and ``Month`` is a feature.) All series meet in one grouped aggregate that is
    the full outer alignment. ``by`` keeps several frames apart, e.g. one per market.

    Carrying forward covers every column, which also repeats the last known target at the tail
    when some series outlives the prices; ``fill_targets=False`` leaves targets alone.
    """
    keys = [*by, series]
    observed = observations.where(F.col(series).isin(list(indicators)))
    priced = prices.where(F.col(series).isin(list(tickers)))
    # Prices and indicators fill different value columns, so they may share series ids.
    stacked = stack_long([
        indicator_features(observed, by=keys, time=time),
        price_features(priced, by=keys, time=time).drop("value", "ret"),
    ])
    cells = _indicator_cells(indicators) | _price_cells(tickers)
    wide = align_wide(stacked, on=[*by, time], series=series, columns=cells)

    names = list(tickers.values())
    targets = [target_column(t) for t in names]
    carried = [c for c in cells if fill_targets or c not in targets]
    frame = ffill(wide, carried, by=by, time=time)
    percent = [c for t in names for c in lag_columns(t)] + targets
    frame = frame.withColumns({c: fraction_to_percent(F.col(c)) for c in percent})
    if drop_last:
        frame = drop_last_period(frame, by=by, time=time)
    frame = calendar_parts(frame, time)
    return frame.select(*by, time, *dataset_columns(names, list(indicators.values())))


def indicator_frame(
    observations: DataFrame, indicators: Mapping[object, str], *, series: str = "series_id", time: str = "period"
) -> DataFrame:
    """Indicators and their changes aligned on the calendar; one row per month."""
    observed = observations.where(F.col(series).isin(list(indicators)))
    changes = indicator_features(observed, by=[series], time=time)
    return align_wide(changes, on=[time], series=series, columns=_indicator_cells(indicators))


def shared_calendar(
    prices: DataFrame,
    observations: DataFrame,
    *,
    indicators: Mapping[object, str],
    series_of_indicators: str = "series_id",
    time: str = "period",
) -> DataFrame:
    """Indicators and changes carried forward on one calendar, from the first to the last month of either side.

    One row per calendar month whatever the size of the data; of ``prices`` only the column ``time`` is read. Carrying here, and not inside each price series, gives a
    series that starts between two observations the last one before its start.
    """
    shared = indicator_frame(observations, indicators, series=series_of_indicators, time=time)
    ends = prices.agg(F.array(F.min(time), F.max(time)).alias("ends")).select(F.explode("ends").alias(time))
    names = list(indicators.values())
    columns = names + change_columns(names)
    months = stack_long([shared, ends.where(F.col(time).isNotNull())]).groupBy(time).agg(*[F.max(c).alias(c) for c in columns])
    return ffill(densify(months, by=[], time=time), columns, by=[], time=time)


def own_panel(prices: DataFrame, *, series: str = "series_id", time: str = "period", drop_last: bool = True) -> DataFrame:
    """Calendar parts, lagged returns and target of every price series, one row per series and month.

    The columns are those of :func:`price_features`, carried forward. As the first row of a series has no return, each is
    the last known return up to its offset, and all of them take one window.
    """
    returns = period_return(densify(prices, by=[series], time=time), "value", by=[series], time=time)
    offsets = {**{name: k for k, name in enumerate(LAG_NAMES, 1)}, "next1": -1}
    frame = returns.withColumns({name: known_before("ret", k, [series], time) for name, k in offsets.items()}).drop("value", "ret")
    frame = frame.withColumns({c: fraction_to_percent(F.col(c)) for c in (*LAG_NAMES, "next1")})
    if drop_last:
        frame = drop_last_period(frame, by=[series], time=time)
    renamed = {**dict(zip(LAG_NAMES, lag_columns("Own"))), "next1": target_column("Own")}
    return calendar_parts(frame, time).withColumnsRenamed(renamed)


def supervised_panel(
    prices: DataFrame,
    observations: DataFrame,
    *,
    indicators: Mapping[object, str],
    series: str = "series_id",
    series_of_indicators: str = "series_id",
    time: str = "period",
    drop_last: bool = True,
) -> DataFrame:
    """The supervised frame in panel form: one row per price series and month.

    Every series gets its own lags and target next to the shared indicators, which are carried forward on their own
    calendar before they are joined.
    """
    calendar = shared_calendar(prices, observations, indicators=indicators, series_of_indicators=series_of_indicators,
                               time=time)
    frame = own_panel(prices, series=series, time=time, drop_last=drop_last).join(calendar, time, "left")
    return frame.select(series, time, *dataset_columns(["Own"], list(indicators.values())))


def with_label(frame: DataFrame, time: str = "period") -> DataFrame:
    """Replace the period by its ``yyyy-MM`` label in a leading ``Date`` column."""
    return move_to_front(frame.withColumn("Date", period_label(F.col(time))), "Date").drop(time)
