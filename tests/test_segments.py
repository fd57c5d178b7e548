"""Scans along long orders against plain Python, with segments of a few rows."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidegrid.operators import folds, segments

SCHEMA = "s string, t timestamp_ntz, k bigint, v double, name string"


@pytest.fixture(scope="module")
def rows():
    """One series with a third of the rows, one time with another third, missing keys and times, gaps of whole segments."""
    rng = random.Random(3)
    start = datetime(2024, 1, 1)

    def one(k):
        s = "hot" if k % 3 == 0 else rng.choice(["a", "b", None, "c"])
        t = None if k % 29 == 0 else start if k % 3 == 1 else start + timedelta(microseconds=rng.randrange(10**6))
        known = s != "c" and (k < 40 or rng.random() < 0.1)
        return s, t, k, float(k) if known else None, f"n{k}" if known else None

    return [one(k) for k in range(400)]


def ordered(rows, by):
    def key(r):
        return ((r[0] is not None, r[0] or "") if by else (), r[1] is not None, r[1] or datetime.min, r[2])
    return sorted(rows, key=key)


@pytest.mark.parametrize("by", [[], ["s"]])
@pytest.mark.parametrize("back", [False, True])
@pytest.mark.parametrize("segment_rows,broadcast", [(7, 100_000), (7, 0), (1000, 100_000)])
def test_carry(spark, monkeypatch, rows, by, back, segment_rows, broadcast):
    monkeypatch.setattr(segments, "BROADCAST_SEGMENTS", broadcast)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = segments.carry(df, ["v", "name"], by=by, order=["t", "k"], back=back, segment_rows=segment_rows)
    assert got.columns == df.columns
    want, last = {}, {}
    for s, _, k, v, name in ordered(rows, by):
        last[s if by else 0] = (v, name) if v is not None else last.get(s if by else 0, (None, None))
        want[k] = last[s if by else 0]
    if back:
        following: dict = {}
        for s, _, k, v, name in reversed(ordered(rows, by)):
            following[s if by else 0] = (v, name) if v is not None else following.get(s if by else 0, (None, None))
            want[k] = want[k] if want[k][0] is not None else following[s if by else 0]
    assert {r["k"]: (r["v"], r["name"]) for r in got.collect()} == want


@pytest.mark.parametrize("by", [[], ["s"]])
def test_row_index(spark, rows, by):
    got = segments.row_index(spark.createDataFrame(rows, SCHEMA).repartition(5), by=by, order=["t", "k"], segment_rows=7)
    want, count = {}, {}
    for r in ordered(rows, by):
        want[r[2]] = count.setdefault(r[0] if by else 0, 0)
        count[r[0] if by else 0] += 1
    assert {r["k"]: r["row_idx"] for r in got.collect()} == want


@pytest.mark.parametrize("by", [[], ["s"]])
def test_asof(spark, rows, by):
    left, right = [r for r in rows if r[2] % 2], [r for r in rows if not r[2] % 2]
    got = segments.asof(spark.createDataFrame(left, SCHEMA).drop("v"), spark.createDataFrame(right, SCHEMA), by=by, time="t",
                        value="v", tie_break="k", segment_rows=7)

    def found(row):
        at = lambda r: (r[1] is not None, r[1] or datetime.min)
        seen = [r for r in right if r[3] is not None and at(r) <= at(row) and (not by or r[0] == row[0])]
        best = max(seen, key=lambda r: (at(r), r[2]), default=None)
        return best and best[3]

    assert {r["k"]: r["carried"] for r in got.collect()} == {r[2]: found(r) for r in left}


@pytest.mark.parametrize("n", [0, 1, 3, 5, 7, 60])
def test_folds_over_times(spark, n):
    times = [datetime(2024, 1, 1) + timedelta(microseconds=7 * i) for i in range(n)]
    df = spark.createDataFrame([(t, j) for t in times for j in range(2)] + [(None, 9)], "t timestamp_ntz, j int")
    got = {(r["t"], r["fold"]) for r in folds.calendar_folds(df, 5, time="t").collect()}
    size, larger = divmod(n, 5)
    deal = [f for f in range(5) for _ in range(size + (f < larger))]
    assert got == set(zip(times, deal))


def test_no_task_sees_the_whole_frame(spark, rows):
    """Neither numbering nor carrying without a key has a single-partition exchange, and the summary alone is broadcast."""
    df = spark.createDataFrame(rows, SCHEMA)
    for out in (segments.row_index(df, order=["t", "k"], segment_rows=7),
                segments.carry(df, ["v"], order=["t", "k"], back=True, segment_rows=7),
                folds.calendar_folds(df, 5, time="t")):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SinglePartition" not in plan
    frame, count = segments.cut(df, ["t", "k"], 7)
    sizes = [r["count"] for r in frame.groupBy("_segment").count().collect()]
    assert len(sizes) > 20 and max(sizes) < 80 and count == -(-len(rows) // 7)


def test_empty_frames_and_missing_columns(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert segments.carry(df, ["v"], by=["s"], order=["t"], back=True).collect() == []
    assert segments.row_index(df, order=["t"]).collect() == []
    assert segments.asof(df, df, time="t", value="v").collect() == []
    blank = spark.createDataFrame([("a", None, None, None, None)] * 3, SCHEMA)
    assert [r["v"] for r in segments.carry(blank, ["v"], order=["t"], back=True).collect()] == [None] * 3
    assert sorted(r["row_idx"] for r in segments.row_index(blank.withColumn("x", F.lit(1)), order=["t"]).collect()) == [0, 1, 2]
