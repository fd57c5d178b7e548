"""Report text as data: one row per line."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.functions.numeric import fixed, significant
from tidegrid.operators.grid import stack_long


def _part(rows: DataFrame, section: int, group: Column, pos: Column, line: Column) -> DataFrame:
    return rows.select(F.lit(section).alias("section"), group.alias("grp"), pos.alias("pos"), line.alias("line"))


def month_line(months: DataFrame) -> DataFrame:
    """The predicted month from ``(target_month)``."""
    return _part(months, 0, F.lit(""), F.lit(0), F.concat(F.lit("Forecast month: "), F.col("target_month")))


def prediction_lines(predictions: DataFrame) -> DataFrame:
    """Expected return and band of each target from ``(target, mean, p25, p75)``."""
    band = F.concat(F.lit("  - Inter-quartile band: "), fixed(F.col("p25"), 2, "%"), F.lit(" to "),
                    fixed(F.col("p75"), 2, "%"))
    expected = F.concat(F.lit("- **"), F.col("target"), F.lit(" expected return**: "), fixed(F.col("mean"), 2, "%"))
    return stack_long([
        _part(predictions, 1, F.col("target"), F.lit(0), expected),
        _part(predictions, 1, F.col("target"), F.lit(1), band),
    ])


def metric_lines(metrics: DataFrame) -> DataFrame:
    """In-sample R2 of each target from ``(target, metric, value)``."""
    line = F.concat(F.lit("- "), F.col("target"), F.lit(" model R2 score: "), fixed(F.col("value"), 4))
    return _part(metrics.where(F.col("metric") == "r2"), 2, F.col("target"), F.lit(0), line)


def factor_lines(tops: DataFrame) -> DataFrame:
    """A heading and a table of the top features of each target, ranks counted from 0."""
    rows = F.concat(F.lit("| "), F.concat_ws(" | ", (F.col("rank") - 1).cast("string"), F.col("feature"),
                                             significant(F.col("importance"))), F.lit(" |"))
    heads = tops.select("target").distinct().select("target", F.posexplode(F.array(
        F.concat(F.lit("### "), F.col("target"), F.lit(" key factors")),
        F.lit("|  | feature | importance |"),
        F.lit("|---|---|---|"),
    )).alias("pos", "line"))
    return stack_long([
        _part(heads, 3, F.col("target"), F.col("pos") - 3, F.col("line")),
        _part(tops, 3, F.col("target"), F.col("rank"), rows),
    ])


def snapshot_lines(snapshot: DataFrame, units: Mapping[str, str] | None = None) -> DataFrame:
    """Latest indicator levels from ``(name, value)``."""
    text = F.concat(F.lit("- "), F.col("name"), F.lit(": "), fixed(F.col("value"), 2))
    for name, unit in (units or {}).items():
        text = F.when(F.col("name") == name, F.concat(text, F.lit(unit))).otherwise(text)
    return _part(snapshot, 4, F.col("name"), F.lit(0), text)


def report_lines(
    *,
    months: DataFrame | None = None,
    predictions: DataFrame | None = None,
    metrics: DataFrame | None = None,
    tops: DataFrame | None = None,
    snapshot: DataFrame | None = None,
    units: Mapping[str, str] | None = None,
) -> DataFrame:
    """``(line_no, line)`` rows of the report. Its length follows the number of targets and
    indicators, never the data, so one global order is fine."""
    parts = [
        make(frame) for make, frame in (
            (month_line, months), (prediction_lines, predictions), (metric_lines, metrics), (factor_lines, tops),
            (lambda s: snapshot_lines(s, units), snapshot),
        ) if frame is not None
    ]
    order = Window.orderBy("section", "grp", "pos")
    return stack_long(parts).select(F.row_number().over(order).alias("line_no"), "line")
