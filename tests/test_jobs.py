"""The jobs end to end, against the same frame computed with pandas."""

from __future__ import annotations

import math
import random
from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest

from tidegrid.operators import change, fill
from tidegrid.operators.forest import ForestParams
from tidegrid.operators.profile import missing_profile
from tidegrid.plans import jobs
from tidegrid.sources.schemas import OBSERVATIONS, PRICES, dataset_columns, dataset_schema
from tidegrid.sources.versions import read_latest

NAMES, IND = list(jobs.TICKERS.values()), list(jobs.INDICATORS.values())
RUN = date(2024, 3, 20)


@pytest.fixture(scope="module")
def raw():
    """Daily prices with a month missing, monthly indicators, and a quarterly one with a gap."""
    rng = random.Random(11)
    prices, obs = [], []
    for t, base in (("SPY", 300.0), ("QQQ", 200.0)):
        for n in range(1900):
            day = date(2019, 1, 1) + timedelta(days=n)
            if day.weekday() < 5 and not (t == "QQQ" and (day.year, day.month) == (2022, 5)):
                base *= math.exp(rng.gauss(0, 0.01))
                prices.append((t, day, base))
    for y in range(2019, 2025):
        for m in range(1, 13):
            if (y, m) > (2024, 2):
                continue
            for s, v in (("CPIAUCSL", 250 + y - 2019 + m / 10), ("UNRATE", float(rng.randrange(0, 6))),
                         ("IPMAN", None if (y, m) == (2023, 3) else 95 + rng.random())):
                obs.append((s, date(y, m, 1), v))
            if m % 3 == 1:
                obs.append(("GDPC1", date(y, m, 1), 20000 + rng.random() * 1000))
    return prices, obs


@pytest.fixture(scope="module")
def tables(spark, raw):
    prices, obs = raw
    return spark.createDataFrame(prices, PRICES), spark.createDataFrame(obs, OBSERVATIONS)


class ByHand:
    """Cells of the dataset for single months, from the raw rows by plain lookups."""

    def __init__(self, raw, lo: tuple[int, int], hi: tuple[int, int]):
        self.lo, self.hi, self.last = lo, hi, {}
        for rows in raw:
            for sid, day, value in sorted(rows, key=lambda r: r[1]):
                if value is not None and lo <= (day.year, day.month) <= hi:
                    self.last[sid, day.year * 12 + day.month - 1] = value

    def at(self, sid, month):
        return self.last.get((sid, month))

    def carried(self, sid, month, read):
        """The latest known value at or before ``month``, inside the window and up to the last month of the series."""
        for m in range(month, self.lo[0] * 12 + self.lo[1] - 2, -1):
            if read(sid, m) is not None:
                return read(sid, m)
        return None

    def change(self, back):
        def read(sid, month):
            now, then = self.at(sid, month), self.at(sid, month - back)
            if now is None or then is None or (now == then == 0):
                return None
            return math.copysign(math.inf, now - then) if then == 0 else round((now - then) / then * 100, 2)

        return read

    def returned(self, sid, month):
        """Percent return of a month over the one before; a month without prices keeps the last price."""
        first = min(m for s, m in self.last if s == sid)
        last = max(m for s, m in self.last if s == sid)
        if not first < month <= last:
            return None
        now, then = (self.carried(sid, m, self.at) for m in (month, month - 1))
        return round((now / then - 1) * 100, 2)

    def row(self, year, month):
        at, out = year * 12 + month - 1, {"Year": year, "Month": month, "Quarter": (month + 2) // 3}
        for sid, name in jobs.INDICATORS.items():
            out[name] = self.carried(sid, at, self.at)
            out[f"{name}_YOY"] = self.carried(sid, at, self.change(12))
            out[f"{name}_MOM"] = self.carried(sid, at, self.change(1))
        for sid, name in jobs.TICKERS.items():
            for k in (1, 2, 3):
                out[f"{name}_Return_Prev{k}M"] = self.returned(sid, at - k)
            out[f"Next_Month_{name}"] = self.carried(sid, at, lambda s, m: self.returned(s, m + 1))
        return out


def _pandas(df, key="Date"):
    return df.toPandas().sort_values(key).reset_index(drop=True)


def test_dataset_matches_plain_lookups(raw, tables):
    got = _pandas(jobs.build_dataset(*tables, run_date=RUN))
    assert list(got.columns) == ["Date", *dataset_columns(NAMES, IND)]
    # The newest month, 2024-02, is left out; 36 months before the run month and one more make the window.
    assert list(got["Date"]) == [f"{p}" for p in pd.period_range("2020-02", "2024-01", freq="M")]
    hand = ByHand(raw, (2020, 2), (2024, 2))
    for _, row in got.iterrows():
        want = hand.row(*map(int, row["Date"].split("-")))
        for c in dataset_columns(NAMES, IND):
            assert row[c] == pytest.approx(math.nan if want[c] is None else want[c], abs=1e-9, nan_ok=True), (row["Date"], c)
    assert np.isinf(got["Unemployment_MOM"]).any() and got["GDP_MOM"].isna().all()


# Monthly returns in percent, the numbers of missing cells of their lags and target in a frame of 50 months,
# and the medians that fill them.
RETURNS = [-1.02, 2.78, 4.54, 5.29, 0.66, 2.24, 2.44, 2.98, -4.66, 7.02, -0.8, 4.62, -5.27, -2.95, 3.76, -8.78, 0.23, -8.25,
           9.21, -4.08, -9.24, 8.13, 5.56, -5.76, 6.29, -2.51, 3.71, 1.6, 0.46, 6.48, 3.27, -1.63, -4.74, -2.17, 9.13, 4.57,
           1.59, 5.22, 3.27, -4.03, 5.06, 3.53, 1.21, 2.34, 2.1, -0.89, 5.96, -2.41]
GAPS, MEDIANS = {"lag1": 4, "lag2": 5, "lag3": 6, "next1": 2}, {"lag1": 2.17, "lag2": 2.24, "lag3": 2.29, "next1": 2.17}


def _months_from(year, month, values):
    return [(date(year + (month - 1 + i) // 12, (month - 1 + i) % 12 + 1, 1), v) for i, v in enumerate(values)]


def test_golden_gaps_and_medians(spark):
    # Returns start in the fourth of 50 months; the target of a month is the return of the next.
    df = spark.createDataFrame(_months_from(2020, 10, [None] * 3 + RETURNS[:47]), "period date, ret double")
    lagged = change.add_lags(df, "ret", ["lag1", "lag2", "lag3"], by=[], time="period")
    frame = lagged.join(spark.createDataFrame(_months_from(2020, 10, [None] * 2 + RETURNS), "period date, next1 double"), "period")
    assert {r["column_name"]: r["n_missing"] for r in missing_profile(frame, list(GAPS)).collect()} == GAPS
    filled = fill.fill_median(frame, list(MEDIANS), by=[]).orderBy("period").first()
    assert {c: round(filled[c], 3) for c in MEDIANS} == MEDIANS


def test_empty_window_fails(spark, tables, tmp_path):
    with pytest.raises(ValueError, match="no prices of QQQ, SPY"), pytest.warns(UserWarning, match="CPIAUCSL has no"):
        jobs.collect(spark, *tables, root=str(tmp_path), run_date=date(1999, 1, 1))


def test_a_misspelt_ticker_is_named(spark, tables, tmp_path):
    with pytest.raises(ValueError, match="no prices of SPYY in"):
        jobs.collect(spark, *tables, root=str(tmp_path), run_date=RUN, tickers={"SPY": "SPY", "SPYY": "QQQ"})
    found = {r["series_id"]: (r["n_obs"], r["is_empty"]) for r in spark.read.parquet(f"{tmp_path}/coverage").collect()}
    assert found["SPYY"] == (0, True) and found["SPY"][0] > 900


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_collect_forecast_report(spark, raw, tables, tmp_path, fmt):
    root = str(tmp_path)
    prices, obs = tables
    params = ForestParams(trees=5, depth=3)
    early = date(2024, 2, 20)
    # The version of March is first built without February's data, as if collected early.
    late = dict(root=root, run_date=RUN, fmt=fmt)
    assert jobs.collect(spark, prices.where("ts < '2024-02-01'"), obs.where("ts < '2024-02-01'"), **late) == "created"
    assert jobs.collect(spark, prices, obs, **late) == "appended"
    assert jobs.collect(spark, prices, obs, **late) == "unchanged"
    assert jobs.collect(spark, prices, obs, root=root, run_date=early, fmt=fmt) == "created"

    data = _pandas(read_latest(spark, f"{root}/dataset", dataset_schema(NAMES, IND), fmt))
    assert set(data["version"]) == {"2024_03"}
    assert list(data["Date"]) == [f"{p}" for p in pd.period_range("2020-02", "2024-01", freq="M")]

    record = jobs.forecast(spark, params=params, **late).toPandas()
    assert record.shape == (1, 35) and record["Target_Month"][0] == "2024-03"
    row = record.iloc[0]
    for t in NAMES:
        assert row[f"{t}_Confidence_Lower"] <= row[f"{t}_Confidence_Upper"]
        tops = [row[f"{t}_Top{i}_Importance"] for i in range(1, 6)]
        assert tops == sorted(tops, reverse=True) and row[f"{t}_R2_Score"] <= 1

    again = jobs.forecast(spark, params=params, **late).toPandas()
    pd.testing.assert_frame_equal(record, again)
    counts = {(r["measure"], r["column_name"]): int(r["n"]) for r in spark.read.format(fmt).option("header", True)
              .load(f"{root}/profile").collect()}
    assert counts["missing", "GDP_MOM"] == len(data) and any(m == "infinite" for m, _ in counts)

    lines = [r["line"] for r in jobs.report(spark, **late).orderBy("line_no").collect()]
    assert lines[0] == "Forecast month: 2024-03"
    assert lines[1] == f"- **QQQ expected return**: {row['QQQ_Predicted_Return']:.2f}%"
    assert sum(line.startswith("| ") and line[2].isdigit() for line in lines) == 10
    assert lines[-1] == f"- Unemployment: {data['Unemployment'].iloc[-1]:.2f}%"
    (part,) = (tmp_path / "reports" / "version=2024_03").glob("part-*")
    assert part.read_text().splitlines() == lines


def test_forecast_of_the_newest_period(spark, tables, tmp_path):
    root = str(tmp_path)
    jobs.collect(spark, *tables, root=root, run_date=RUN, keep_last=True, fill_targets=False)
    record = jobs.forecast(spark, root=root, run_date=RUN, params=ForestParams(trees=3, depth=2), score_row="last_observed")
    assert record.first()["Target_Month"] == "2024-03"
    with pytest.raises(ValueError):
        jobs.forecast(spark, root=root, run_date=RUN, score_row="other")
