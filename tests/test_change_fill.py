from __future__ import annotations

import math
import random
import time
from datetime import date
from statistics import median

import numpy as np
from conftest import as_dict, months
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidegrid.operators import change, fill, grid
from tidegrid.plans.supervised import supervised_panel

BY = ["series_id"]

# Consumer price levels from December 2020 and their published percent changes.
CPI = [262.005, 262.518, 263.583, 264.910, 266.752, 268.452, 270.664, 271.994, 272.789, 273.887, 276.434,
       278.799, 280.808, 282.390]
CPI_MOM = [None, 0.2, 0.41, 0.5, 0.7]


def test_price_level_changes(panel):
    df = panel({"cpi": dict(zip(months("2020-12", len(CPI)), CPI))})
    mom = as_dict(change.mom_change(df, "value", by=BY), "series_id", "month", "mom")
    assert [mom[("cpi", m)] for m in months("2020-12", 5)] == CPI_MOM
    yoy = as_dict(change.yoy_change(df, "value", by=BY), "series_id", "month", "yoy")
    assert yoy[("cpi", "2021-11")] is None
    assert yoy[("cpi", "2021-12")] == round((280.808 - 262.005) / 262.005 * 100, 2)


def test_quarterly_series_on_a_monthly_grid(panel):
    quarters = [m for m in months("2020-01", 24) if m[5:] in ("01", "04", "07", "10")]
    dense = grid.densify(panel({"q": {m: 100.0 + i for i, m in enumerate(quarters)}}), by=BY)
    rows = change.yoy_change(change.mom_change(dense, "value", by=BY), "value", by=BY).collect()
    assert all(r["mom"] is None for r in rows)
    assert {f"{r['month']:%Y-%m}" for r in rows if r["yoy"] is not None} == {m for m in quarters if m >= "2021"}


def test_zero_base(panel):
    df = panel({"a": {"2024-01": 0.0, "2024-02": 5.0}, "b": {"2024-01": 0.0, "2024-02": -5.0},
                "c": {"2024-01": 0.0, "2024-02": 0.0}})
    got = as_dict(change.mom_change(df, "value", by=BY), "series_id", "month", "mom")
    assert (got[("a", "2024-02")], got[("b", "2024-02")], got[("c", "2024-02")]) == (math.inf, -math.inf, None)


def test_returns_pad_gaps_and_do_not_leak_between_series(panel):
    df = panel({"up": {"2024-01": 1.0, "2024-02": 2.0, "2024-04": 3.0}, "down": {"2024-02": 8.0, "2024-03": 4.0}})
    got = as_dict(change.period_return(grid.densify(df, by=BY), "value", by=BY), "series_id", "month", "ret")
    assert got == {("up", "2024-01"): None, ("up", "2024-02"): 1.0, ("up", "2024-03"): 0.0, ("up", "2024-04"): 0.5,
                   ("down", "2024-02"): None, ("down", "2024-03"): -0.5}


def test_lead_undoes_lag(panel):
    df = panel({s: {m: float(i * k) for i, m in enumerate(months("2023-01", 8))} for s, k in (("a", 1), ("b", -1))})
    lagged = change.add_lags(df, "value", ["p1", "p2", "p3"], by=BY)
    back = change.add_lead(lagged, "p1", "again", by=BY)
    rows = back.orderBy("series_id", "month").collect()
    for r, nxt in zip(rows, rows[1:]):
        if r["series_id"] == nxt["series_id"]:
            assert r["again"] == r["value"] and nxt["p1"] == r["value"]


def _col(df, value="value"):
    return [r[value] for r in df.orderBy("series_id", "month").collect()]


def test_fills(panel):
    df = panel({"a": dict(zip(months("2024-01", 5), [None, 1.0, None, 3.0, None])), "b": {"2024-01": None, "2024-02": None}})
    forward = fill.ffill(df, ["value"], by=BY)
    assert _col(forward) == [None, 1.0, 1.0, 3.0, 3.0, None, None]
    assert _col(fill.ffill(forward, ["value"], by=BY)) == _col(forward)
    assert _col(fill.ffill_bfill(df, ["value"], by=BY)) == [1.0, 1.0, 1.0, 3.0, 3.0, None, None]
    assert _col(fill.fill_constant(df, ["value"])) == [0.0, 1.0, 0.0, 3.0, 0.0, 0.0, 0.0]
    assert _col(fill.fill_median(df, ["value"], by=BY)) == [2.0, 1.0, 2.0, 3.0, 2.0, None, None]
    assert _col(fill.fill_global_median(df, ["value"])) == [2.0, 1.0, 2.0, 3.0, 2.0, 2.0, 2.0]


def test_chain_zeroes_missing_changes_before_infinities_become_medians(spark):
    values = [None, 1.0, math.inf, 3.0, 8.0]
    rows = [("a", i, lvl, chg, ret) for i, (lvl, chg, ret) in enumerate(
        zip([None, 5.0, None, 6.0, math.inf], values, [None, 2.0, 4.0, -math.inf, 6.0]))]
    df = spark.createDataFrame(rows, "series_id string, month int, lvl double, chg double, ret double")
    out = fill.impute_chain(df, levels=["lvl"], changes=["chg"], returns=["ret"], by=BY).orderBy("month").collect()
    # The missing change is 0 and counts in the median that replaces the infinity.
    assert [r["chg"] for r in out] == [0.0, 1.0, median([0.0, 1.0, 3.0, 8.0]), 3.0, 8.0]
    assert [r["lvl"] for r in out] == [5.0, 5.0, 5.0, 6.0, 5.0]
    # The missing return is the median with the infinity still in, the infinity the median without.
    first = median([-math.inf, 2.0, 4.0, 6.0])
    assert [r["ret"] for r in out] == [first, 2.0, 4.0, median([first, 2.0, 4.0, 6.0]), 6.0]


def test_expanding_median_equals_a_running_percentile(spark):
    rng = random.Random(6)
    choices = [None, None, 0.0, -0.0, 1.5, -2.25, 1e300, math.inf, -math.inf, 7.0, math.nan]
    rows = [(s, m, rng.choice(choices) if rng.random() < 0.6 else rng.uniform(-9, 9), None if rng.random() < 0.5 else m, (1 << 62) + 1)
            for s in ("a", "b", None) for m in range(60)] + [("gap", 0, None, None, None)]
    df = spark.createDataFrame(rows, "series_id string, month int, value double, whole int, wide bigint").repartition(3)
    so_far = Window.partitionBy("series_id").orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.percentile(c, F.lit(0.5)).over(so_far)) for c in ("value", "whole")})
    got = fill.fill_expanding_median(df, ["value", "whole"], by=BY)
    assert dict(got.dtypes) == dict(want.dtypes)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_expanding_median_of_a_long_series_takes_n_log_n():
    def seconds(n):
        values = np.random.default_rng(1).normal(size=n)
        start = time.process_time()
        got = fill.running_medians(values, np.arange(n) % 3 > 0)
        assert got[-1] == np.median(values[np.arange(n) % 3 > 0])
        return time.process_time() - start

    assert seconds(100_000) < 40 * max(seconds(10_000), 0.01)  # the square would be 100 times


def test_expanding_median_of_an_empty_frame(spark):
    df = spark.createDataFrame([], "series_id string, month int, value double")
    assert fill.fill_expanding_median(df, ["value"], by=BY).collect() == []


def test_chain_without_looking_ahead(spark):
    df = spark.createDataFrame([("a", 0, None), ("a", 1, 1.0), ("a", 2, 9.0)], "series_id string, month int, lvl double")
    out = fill.impute_chain(df, levels=["lvl"], by=BY, bfill=False).orderBy("month").collect()
    assert [r["lvl"] for r in out] == [5.0, 1.0, 9.0]


def test_panel_indicators_are_carried_from_before_a_series_starts(spark):
    """A series that starts in February has the indicator of January, not a gap and not April's."""
    prices = spark.createDataFrame([("s", date(2024, m, 1), float(m)) for m in range(2, 7)], "series_id string, period date, value double")
    quarterly = spark.createDataFrame([("g", date(2024, 1, 1), 101.0), ("g", date(2024, 4, 1), 104.0)],
                                      "series_id string, period date, value double")
    panel = supervised_panel(prices, quarterly, indicators={"g": "GDP"}).orderBy("period")
    assert [r["GDP"] for r in panel.collect()] == [101.0, 101.0, 104.0, 104.0]


def test_known_values_before_are_carried_offsets_in_one_window(spark):
    rng = random.Random(8)
    rows = [(s, i, None if i == 0 or rng.random() < 0.5 else rng.random()) for s in range(9) for i in range(rng.randrange(1, 12))]
    df = spark.createDataFrame(rows, "s int, month int, v double")
    offsets = {"lag1": 1, "lag2": 2, "lag3": 3, "next1": -1, "same": 0}
    moved = change.add_lead(change.add_lags(df, "v", ["lag1", "lag2", "lag3"], by=["s"]), "v", "next1", by=["s"])
    want = fill.ffill(moved.withColumn("same", F.col("v")), list(offsets), by=["s"])
    got = df.withColumns({c: change.known_before("v", k, ["s"], "month") for c, k in offsets.items()})
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    plan = change.period_return(df, "v", by=["s"], time="month")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") == 1
