from __future__ import annotations

import math
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidegrid.functions import numeric, periods


def _eval(spark, column, **values):
    kinds = {float: "double", int: "bigint", date: "date", datetime: "timestamp_ntz"}
    schema = ", ".join(f"{k} {kinds.get(type(v), 'double')}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("r")).first()["r"]


@pytest.mark.parametrize("x, want", [
    (0.125, 0.12), (0.135, 0.14), (0.375, 0.38), (-0.125, -0.12), (2.5, 2.5), (-0.001, 0.0),
    (math.inf, math.inf), (None, None),
])
def test_rounding_is_half_to_even(spark, x, want):
    got = _eval(spark, numeric.rint_to(F.col("x")), x=x)
    assert got == want
    if got == 0:
        assert math.copysign(1, got) == 1


@pytest.mark.parametrize("a, b, want", [
    (1.0, 0.0, math.inf), (-1.0, 0.0, -math.inf), (0.0, 0.0, None), (1.0, 4.0, 0.25), (None, 0.0, None), (1.0, None, None),
])
def test_division_keeps_infinities(spark, a, b, want):
    assert _eval(spark, numeric.ieee_div(F.col("a"), F.col("b")), a=a, b=b) == want


@pytest.mark.parametrize("x, want", [(math.inf, None), (-math.inf, None), (3.0, 3.0), (None, None)])
def test_infinities_become_missing(spark, x, want):
    assert _eval(spark, numeric.inf_to_null(F.col("x")), x=x) == want


@pytest.mark.parametrize("x, want", [
    (0.1568406126258346, "0.156841"), (0.10408981684912547, "0.10409"), (0.09113106885123684, "0.0911311"),
    (1234.0, "1234"), (100000.0, "100000"), (1234567.89, "1234570"), (0.0, "0"), (-0.25, "-0.25"), (None, None),
])
def test_significant_digits(spark, x, want):
    assert _eval(spark, numeric.significant(F.col("x")), x=x) == want


@pytest.mark.parametrize("x, want", [(0.125, "0.12%"), (-0.125, "-0.12%"), (4.2, "4.20%")])
def test_fixed_text_rounds_half_to_even(spark, x, want):
    assert _eval(spark, numeric.fixed(F.col("x"), 2, "%"), x=x) == want


@pytest.mark.parametrize("run, n, lo, hi", [
    (date(2025, 1, 20), 36, date(2020, 12, 1), date(2025, 1, 1)),
    (date(2025, 1, 20), 2, date(2023, 10, 1), date(2025, 1, 1)),
    (date(2024, 12, 31), 11, date(2022, 12, 1), date(2024, 12, 1)),
])
def test_lookback_bounds(run, n, lo, hi):
    assert periods.lookback_bounds(run, n) == (lo, hi)


def test_period_starts_and_shifts(spark):
    day = datetime(2024, 5, 31, 23, 59)
    starts = {g: _eval(spark, periods.period_start(F.col("x"), g), x=day) for g in ("day", "month", "quarter")}
    assert starts == {"day": date(2024, 5, 31), "month": date(2024, 5, 1), "quarter": date(2024, 4, 1)}
    assert _eval(spark, periods.shift_period(F.col("x"), -1, "quarter"), x=date(2024, 1, 1)) == date(2023, 10, 1)
    assert periods.next_month(date(2024, 12, 9)) == date(2025, 1, 1)
    with pytest.raises(ValueError):
        periods.period_start(F.col("x"), "week")


def test_version_and_label(spark):
    assert _eval(spark, periods.version_of(F.col("x")), x=date(2025, 1, 20)) == "2025_01"
    assert _eval(spark, periods.period_label(F.col("x")), x=date(2025, 1, 20)) == "2025-01"
