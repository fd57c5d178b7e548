from __future__ import annotations

from datetime import date, datetime

import pytest
from conftest import as_dict, months
from pyspark.sql import functions as F

from tidegrid.operators import grid
from tidegrid.operators.change import yoy_change


def test_last_value_with_ties_and_missing(spark):
    rows = [
        ("a", date(2024, 1, 3), 1, 10.0), ("a", date(2024, 1, 31), 5, 20.0), ("a", date(2024, 1, 31), 7, 30.0),
        ("a", date(2024, 1, 31), 9, None), ("a", date(2024, 2, 1), 2, None), ("b", date(2024, 1, 31), 99, 1.0),
    ]
    df = spark.createDataFrame(rows, "series_id string, ts date, k bigint, value double")
    got = as_dict(grid.resample_last(df, by=["series_id"], ts="ts", value="value", tie_break="k"),
                  "series_id", "month", "value")
    assert got == {("a", "2024-01"): 30.0, ("a", "2024-02"): None, ("b", "2024-01"): 1.0}


def test_resample_without_tie_break_uses_the_time_of_day(spark):
    rows = [("a", datetime(2024, 1, 3, 9), 1.0), ("a", datetime(2024, 1, 3, 17), 2.0)]
    df = spark.createDataFrame(rows, "series_id string, ts timestamp_ntz, value double")
    out = grid.resample_last(df, by=["series_id"], ts="ts", value="value", grain="day", out_time="day")
    assert [tuple(r) for r in out.collect()] == [("a", date(2024, 1, 3), 2.0)]


@pytest.mark.parametrize("kind,early,late", [("bigint", 10, 5), ("bigint", (1 << 63) - 1, -(1 << 63)), ("string", "z", "a")])
def test_time_of_day_comes_before_the_key(spark, kind, early, late):
    at = datetime(2024, 1, 31, 17)
    rows = [("a", datetime(2024, 1, 31, 9), early, 1.0), ("a", at, late, 2.0), ("b", at, late, 3.0), ("b", at, early, 4.0),
            ("c", at, None, 5.0), ("c", at, late, 6.0)]
    df = spark.createDataFrame(rows, f"series_id string, ts timestamp_ntz, k {kind}, value double")
    out = grid.resample_last(df, by=["series_id"], ts="ts", value="value", tie_break="k")
    assert {r["series_id"]: r["value"] for r in out.collect() if r["series_id"] != "c"} == {"a": 2.0, "b": 4.0}
    if late != -(1 << 63):
        assert out.where("series_id = 'c'").first()["value"] == 6.0


def test_resample_stays_hash_aggregated(spark):
    df = spark.createDataFrame([], "series_id string, ts date, k bigint, value double")
    out = grid.resample_last(df, by=["series_id"], ts="ts", value="value", tie_break="k")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "partial_max_by" in plan


def test_sparse_panels_shuffle_once(spark):
    df = spark.createDataFrame([], "series_id string, ts date, k bigint, value double")
    out = grid.resample_last(df, by=["series_id"], ts="ts", value="value", tie_break="k", sparse=True)
    for frame in (grid.densify(out, by=["series_id"]), yoy_change(grid.densify(out, by=["series_id"]), "value", by=["series_id"])):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "SortAggregate" not in plan


def test_densify_has_every_month_and_keeps_series_apart(panel):
    df = panel({"a": {"2023-11": 1.0, "2024-02": 2.0}, "b": {"2024-01": 5.0}, "c": {"2024-01": None, "2024-03": 1.0}})
    got = as_dict(grid.densify(df, by=["series_id"]), "series_id", "month", "value")
    assert got == {
        ("a", "2023-11"): 1.0, ("a", "2023-12"): None, ("a", "2024-01"): None, ("a", "2024-02"): 2.0,
        ("b", "2024-01"): 5.0,
        ("c", "2024-01"): None, ("c", "2024-02"): None, ("c", "2024-03"): 1.0,
    }


def test_densify_needs_one_shuffle(panel):
    df = panel({"a": {"2024-01": 1.0}})
    plan = grid.densify(df, by=["series_id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_hot_series_with_most_rows(spark):
    """Half of all rows in one series and month: same result as computed by hand."""
    rows = spark.range(200_000).select(
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 50).cast("string"))).alias("series_id"),
        F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") % 31).cast("int")).alias("ts"),
        F.col("id").alias("k"), F.col("id").cast("double").alias("value"))
    out = grid.resample_last(rows, by=["series_id"], ts="ts", value="value", tie_break="k")
    last = max((i % 31, i) for i in range(0, 200_000, 2))[1]
    assert out.where("series_id = 'hot'").first()["value"] == float(last)
    assert out.count() == 26


def test_align_is_a_full_outer_join(panel):
    df = panel({"a": {"2024-01": 1.0, "2024-02": 2.0}, "b": {"2024-02": 3.0, "2024-03": 4.0}})
    cells = {"A": ("a", "value"), "B": ("b", "value"), "C": ("absent", "value")}
    out = grid.align_wide(df, on=["month"], series="series_id", columns=cells).orderBy("month")
    assert [(r["A"], r["B"], r["C"]) for r in out.collect()] == [(1.0, None, None), (2.0, 3.0, None), (None, 4.0, None)]


def test_asof_carry(panel):
    base = panel({"a": dict.fromkeys(months("2024-01", 6), 0.0), "b": {"2024-05": 0.0}}).select("series_id", "month")
    low = panel({"a": {"2023-10": 1.0, "2024-01": 2.0, "2024-04": None}, "b": {"2024-06": 9.0}})
    out = grid.asof_carry(base, low, by=["series_id"], time="month", value="value")
    assert as_dict(out, "series_id", "month", "carried") == {
        **{("a", m): 2.0 for m in months("2024-01", 6)}, ("b", "2024-05"): None}
    assert as_dict(out, "series_id", "month", "value")[("a", "2024-01")] == 2.0
    assert as_dict(out, "series_id", "month", "value")[("a", "2024-02")] is None
