from __future__ import annotations

import sys
from datetime import date
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidegrid.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[8]", spark__ui__enabled="false", spark__driver__memory="8g",
        spark__sql__shuffle__partitions="4", spark__ui__showConsoleProgress="false",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoint")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def panel(spark):
    """Build a long frame from ``{series: {"2020-01": value, ...}}``."""

    def build(series: dict[str, dict[str, float | None]]):
        rows = [(s, date(int(ym[:4]), int(ym[5:7]), 1), v) for s, obs in series.items() for ym, v in obs.items()]
        return spark.createDataFrame(rows, "series_id string, month date, value double")

    return build


def months(start: str, n: int) -> list[str]:
    first = int(start[:4]) * 12 + int(start[5:7]) - 1
    return [f"{(first + i) // 12}-{(first + i) % 12 + 1:02d}" for i in range(n)]


def as_dict(df, series: str, time: str, value: str) -> dict:
    return {(r[series], f"{r[time]:%Y-%m}"): r[value] for r in df.collect()}
