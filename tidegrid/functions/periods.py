"""Calendar arithmetic on period-start dates (day, month or quarter grain)."""

from __future__ import annotations

import math
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

_TRUNC = {"day": "DD", "month": "MM", "quarter": "QUARTER"}
_STEP = {"day": "interval 1 day", "month": "interval 1 month", "quarter": "interval 3 months"}
_MONTHS = {"month": 1, "quarter": 3}


def _known(grain: str) -> str:
    if grain not in _TRUNC:
        raise ValueError(f"unknown grain {grain!r}; use one of {sorted(_TRUNC)}")
    return grain


def period_start(ts: Column, grain: str = "month") -> Column:
    """First day of the period holding ``ts``, as DATE."""
    return F.to_date(ts) if _known(grain) == "day" else F.trunc(ts, _TRUNC[grain])


def shift_period(start: Column, n: int, grain: str = "month") -> Column:
    if _known(grain) == "day":
        return F.date_add(start, n)
    return F.add_months(start, n * _MONTHS[grain])


def period_sequence(first: Column, last: Column, grain: str = "month") -> Column:
    """Array of every period start from ``first`` to ``last``, both included."""
    return F.sequence(first, last, F.expr(_STEP[_known(grain)]))


def lookback_bounds(run_date: date, months: int, warm_up: int = 13) -> tuple[date, date]:
    """Half-open ``[lo, hi)`` window ending before the run month.

    ``warm_up`` extra months in front make year-over-year changes available from the first wanted
    month on.
    """
    hi = run_date.replace(day=1)
    year, month0 = divmod(hi.year * 12 + hi.month - 1 - (months + warm_up), 12)
    return date(year, month0 + 1, 1), hi


def next_month(day: date) -> date:
    """First day of the month after ``day``."""
    return lookback_bounds(day, -1, 0)[0]


def version_of(run_date: Column) -> Column:
    """Dataset version label ``yyyy_MM``."""
    return F.date_format(run_date, "yyyy_MM")


def period_label(start: Column) -> Column:
    """Period label ``yyyy-MM``."""
    return F.date_format(start, "yyyy-MM")


def sin_cos_month(month: Column) -> tuple[Column, Column]:
    """Position of a month number (1-12) on the yearly circle."""
    angle = F.lit(2 * math.pi) * month / F.lit(12)
    return F.sin(angle), F.cos(angle)
