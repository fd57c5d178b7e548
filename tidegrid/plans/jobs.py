"""The three monthly jobs: collect a dataset, forecast from it, report the forecast.

Each job takes its run date as a parameter, writes one version partition per table under ``root``
and fails on error. Repeating a run gives the same state.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid.functions.periods import lookback_bounds, next_month
from tidegrid.operators import folds, forest
from tidegrid.operators.grid import resample_last, stack_long
from tidegrid.operators.profile import describe, describe_wide, inf_profile, missing_profile, require_clean, series_coverage
from tidegrid.operators.rank import topk, unpivot_topk
from tidegrid.operators.select import latest_row
from tidegrid.plans.features import feature_columns, training_frame
from tidegrid.plans.report import report_lines
from tidegrid.plans.supervised import supervised_frame, with_label
from tidegrid.sources.readers import scan_series
from tidegrid.sources.schemas import dataset_columns, dataset_schema, target_column
from tidegrid.sources.versions import VERSION, has_version, read_latest, read_versions, version_label
from tidegrid.sources.writers import absent_rows, append_rows, overwrite_version, write_lines

# The default series and the column names they get.
TICKERS = {"SPY": "SPY", "QQQ": "QQQ"}
INDICATORS = {"GDPC1": "GDP", "CPIAUCSL": "CPI", "UNRATE": "Unemployment", "IPMAN": "PMI"}
UNITS = {"Unemployment": "%"}

DATASET, COVERAGE, PROFILE, PROCESSED, STATISTICS, MODELS, RESULTS, REPORTS = (
    "dataset", "coverage", "profile", "processed", "statistics", "models", "results", "reports")
TOP = 5


def build_dataset(
    prices: DataFrame,
    observations: DataFrame,
    *,
    run_date: date,
    months: int = 36,
    tickers: Mapping[str, str] = TICKERS,
    indicators: Mapping[str, str] = INDICATORS,
    keep_last: bool = False,
    fill_targets: bool = True,
) -> DataFrame:
    """The monthly dataset as of a run date, from raw ``(series_id, ts, adj_close)`` prices and
    ``(series_id, ts, value)`` observations."""
    lo, hi = lookback_bounds(run_date, months)
    monthly = []
    for rows, ids, value in ((prices, tickers, "adj_close"), (observations, indicators, "value")):
        wanted = scan_series(rows, list(ids), lo, hi, series="series_id", ts="ts")
        # Of several observations of one day the greatest counts, so the result does not depend on their order.
        daily = wanted.groupBy("series_id", "ts").agg(F.max(value).alias(value))
        monthly.append(resample_last(daily, by=["series_id"], ts="ts", value=value,
                                     out_time="period", out_value="value"))
    frame = supervised_frame(*monthly, tickers=tickers, indicators=indicators,
                             drop_last=not keep_last, fill_targets=fill_targets)
    return with_label(frame)


def requested_coverage(
    spark: SparkSession,
    prices: DataFrame,
    observations: DataFrame,
    *,
    run_date: date,
    months: int,
    tickers: Mapping[str, str],
    indicators: Mapping[str, str],
) -> DataFrame:
    """``(kind, series_id, n_obs, n_rows, n_undated, is_empty)`` of every requested series in the lookback window.

    Rows without a date belong to no month; they are counted apart, over all dates.
    """
    lo, hi = lookback_bounds(run_date, months)
    parts = []
    for kind, rows, ids, value in (("price", prices, tickers, "adj_close"), ("indicator", observations, indicators, "value")):
        wanted = spark.createDataFrame([(i,) for i in ids], "series_id string")
        inside = series_coverage(scan_series(rows, list(ids), lo, hi, series="series_id", ts="ts"), wanted,
                                 series="series_id", value=value)
        undated = rows.where(F.col("ts").isNull() & F.col("series_id").isin(list(ids))).groupBy("series_id").agg(
            F.count("*").alias("n_undated"))
        parts.append(inside.join(undated, "series_id", "left").select(
            F.lit(kind).alias("kind"), "series_id", "n_obs", F.col("n_grid").alias("n_rows"),
            F.coalesce("n_undated", F.lit(0).cast("bigint")).alias("n_undated"), "is_empty"))
    return stack_long(parts)


def _report_missing(coverage: DataFrame, months: int, run_date: date) -> None:
    """Raise for a ticker without observations, warn for an indicator without."""
    empty = [(r["kind"], r["series_id"]) for r in coverage.where("is_empty").collect()]  # one row per requested series
    span = f"in the {months} months before {run_date:%Y-%m}"
    for kind, sid in empty:
        if kind == "indicator":
            warnings.warn(f"indicator {sid} has no observations {span}", stacklevel=3)
    tickers = [sid for kind, sid in empty if kind == "price"]
    if tickers:
        raise ValueError(f"no prices of {', '.join(sorted(tickers))} {span}")


def collect(
    spark: SparkSession,
    prices: DataFrame,
    observations: DataFrame,
    *,
    root: str,
    run_date: date,
    months: int = 36,
    tickers: Mapping[str, str] = TICKERS,
    indicators: Mapping[str, str] = INDICATORS,
    fmt: str = "parquet",
    keep_last: bool = False,
    fill_targets: bool = True,
) -> str:
    """Create the dataset version of the run month, or append its newest period if absent.

    Returns ``"created"``, ``"appended"`` or ``"unchanged"``. A new version also gets a table of what was found for each
    requested series; a ticker without prices is an error that names it, an indicator without observations a warning.
    """
    path, version = f"{root}/{DATASET}", version_label(run_date)
    options = dict(run_date=run_date, tickers=tickers, indicators=indicators, keep_last=keep_last,
                   fill_targets=fill_targets)
    if not has_version(spark, path, version):
        coverage = requested_coverage(spark, prices, observations, run_date=run_date, months=months, tickers=tickers,
                                      indicators=indicators)
        overwrite_version(coverage, f"{root}/{COVERAGE}", run_date, fmt)
        _report_missing(coverage, months, run_date)
        frame = build_dataset(prices, observations, months=months, **options)
        if frame.isEmpty():
            raise ValueError(f"the {months} months before {run_date:%Y-%m} hold no complete month")
        overwrite_version(frame, path, run_date, fmt)
        return "created"

    recent = build_dataset(prices, observations, months=2, **options)
    newest = latest_row(recent, by=[], time="Date")
    schema = dataset_schema(list(tickers.values()), list(indicators.values()))
    stored = read_versions(spark, path, schema, fmt).where(F.col(VERSION) == version)
    fresh = absent_rows(stored, newest, ["Date"])
    if fresh.isEmpty():
        return "unchanged"
    append_rows(fresh, path, run_date, fmt)
    return "appended"


def _processed_schema(features: Sequence[str], targets: Sequence[str]) -> T.StructType:
    whole = {"row_idx", "Year", *[f for f in features if f.startswith(("Month_0", "Month_1", "Quarter_"))]}
    schema = T.StructType()
    for c in ["row_idx", *features, *targets]:
        schema = schema.add(c, T.IntegerType() if c in whole else T.DoubleType())
    return schema.add("Processing_Date", T.StringType())


def _results_schema(tickers: Sequence[str]) -> T.StructType:
    schema = T.StructType().add("Prediction_Date", T.StringType()).add("Target_Month", T.StringType())
    for name, text in _result_slots(tickers):
        schema = schema.add(name, T.StringType() if text else T.DoubleType())
    return schema


def _result_slots(tickers: Sequence[str]) -> list[tuple[str, bool]]:
    """Column order of the prediction record, with whether a column is text."""
    bands = [(f"{t}_{what}", False) for t in tickers
             for what in ("Predicted_Return", "Confidence_Lower", "Confidence_Upper", "Std")]
    scores = [(f"{t}_{what}", False) for what in ("R2_Score", "CV_Score") for t in tickers]
    tops = [(f"{t}_Top{i}_{what}", what == "Feature") for t in tickers for i in range(1, TOP + 1)
            for what in ("Feature", "Importance")]
    return bands + scores + tops


def features_of_dataset(tickers: Sequence[str], indicators: Sequence[str]) -> list[str]:
    return [c for c in dataset_columns(tickers, indicators) if c not in ("Year", "Month", "Quarter")]


def data_profile(monthly: DataFrame, columns: Sequence[str], targets: Sequence[str], filled: bool) -> DataFrame:
    """``(measure, column_name, n)`` of the data before imputation: missing and infinite cells, and the labels that
    training fills with their median."""
    parts = [missing_profile(monthly, columns).select(F.lit("missing").alias("measure"), "column_name", F.col("n_missing").alias("n")),
             inf_profile(monthly, columns).select(F.lit("infinite").alias("measure"), "column_name", F.col("n_inf").alias("n"))]
    if filled:
        parts.append(missing_profile(monthly, targets).select(
            F.lit("filled label").alias("measure"), "column_name", F.col("n_missing").alias("n")))
    return stack_long(parts)


def prediction_record(
    bands: DataFrame, metrics: DataFrame, tops: DataFrame, *, tickers: Mapping[str, str], run_date: date,
    target_month: date,
) -> DataFrame:
    """The one-row wide record, pivoted from the long ``(target, ...)`` tables."""
    names = F.create_map(*[F.lit(x) for t in tickers.values() for x in (target_column(t), t)])
    who = F.concat(F.element_at(names, F.col("target")), F.lit("_"))
    null_text = F.lit(None).cast("string")

    def slots(rows: DataFrame, *cells) -> DataFrame:
        return rows.select(F.inline(F.array(*[
            F.struct(F.concat(who, slot).alias("slot"), number.alias("number"), text.alias("text"))
            for slot, number, text in cells])))

    null_number = F.lit(None).cast("double")
    long = stack_long([
        slots(bands, *[(F.lit(name), F.col(c), null_text) for name, c in (
            ("Predicted_Return", "mean"), ("Confidence_Lower", "p25"), ("Confidence_Upper", "p75"), ("Std", "std"))]),
        slots(metrics.where(F.col("metric").isin("r2", "cv_mean")),
              (F.when(F.col("metric") == "r2", "R2_Score").otherwise("CV_Score"), F.col("value"), null_text)),
        slots(tops, (F.format_string("Top%d_Feature", "rank"), null_number, F.col("feature")),
              (F.format_string("Top%d_Importance", "rank"), F.col("importance"), null_text)),
    ])
    cells = [F.max(F.when(F.col("slot") == name, F.col("text" if text else "number"))).alias(name)
             for name, text in _result_slots(list(tickers.values()))]
    wide = long.agg(*cells)
    return wide.select(F.lit(f"{run_date:%Y-%m-%d}").alias("Prediction_Date"),
                       F.lit(f"{target_month:%Y-%m}").alias("Target_Month"), *wide.columns)


def forecast(
    spark: SparkSession,
    *,
    root: str,
    run_date: date,
    tickers: Mapping[str, str] = TICKERS,
    indicators: Mapping[str, str] = INDICATORS,
    params: forest.ForestParams = forest.ForestParams(),
    fmt: str = "parquet",
    score_row: str = "last_labelled",
    bfill: bool = True,
    k: int = 5,
    expanding: bool = False,
) -> DataFrame:
    """Train one forest per target on the latest dataset, validate, predict, and store everything.

    ``score_row="last_labelled"`` predicts the last training row, whose target is known, and
    fills missing labels with their median. ``"last_observed"`` trains on labelled rows only and
    predicts the newest row of a dataset collected with ``keep_last=True, fill_targets=False``. ``expanding`` validates each
    fold with forests of the earlier folds only.
    """
    if score_row not in ("last_labelled", "last_observed"):
        raise ValueError(f"unknown score_row {score_row!r}")
    names, ind = list(tickers.values()), list(indicators.values())
    features, targets = feature_columns(names, ind), [target_column(t) for t in names]
    ahead = score_row == "last_observed"

    dataset = read_latest(spark, f"{root}/{DATASET}", dataset_schema(names, ind), fmt).drop(VERSION)
    monthly = dataset.withColumn("period", F.to_date("Date", "yyyy-MM"))
    if ahead:
        newest = monthly.agg(F.max("period")).first()[0]
        target_month = next_month(newest)
    else:
        target_month = run_date
    overwrite_version(data_profile(monthly, [*features_of_dataset(names, ind)], targets, filled=not ahead),
                      f"{root}/{PROFILE}", run_date, fmt)
    frame = training_frame(monthly, tickers=names, indicators=ind, run_date=run_date, fill_labels=not ahead,
                           bfill=bfill, keep_unlabelled=ahead)
    columns = ["row_idx", *features, *targets, "Processing_Date"]
    processed_path = f"{root}/{PROCESSED}"
    overwrite_version(frame.select(*columns), processed_path, run_date, fmt)

    # Everything below reads the stored frame: the fits never depend on the feature lineage.
    version = version_label(run_date)
    stored = read_versions(spark, processed_path, _processed_schema(features, targets), fmt)
    stored = stored.where(F.col(VERSION) == version).drop(VERSION)
    require_clean(stored, features)
    labelled = stored.dropna(subset=targets)
    stats = describe_wide(describe(labelled, [*features, *targets]), [*features, *targets])
    overwrite_version(stats, f"{root}/{STATISTICS}", run_date, fmt)

    training = folds.series_folds(labelled, k, by=[], time="row_idx")
    bundle = forest.fit_forests(training, features, targets, params, keys=["row_idx"])
    bundle.save(f"{root}/{MODELS}/{VERSION}={version}")
    metrics = forest.model_metrics(training, bundle, "fold", k, keys=["row_idx"], expanding=expanding)
    latest = latest_row(stored, by=[], time="row_idx")
    bands = stack_long([forest.forest_band(latest, bundle, t).select(F.lit(t).alias("target"), "mean", "std", "p25", "p75")
                        for t in targets])
    importances = stack_long([forest.feature_importance(bundle, training, t).drop("rank").withColumn("target", F.lit(t))
                              for t in targets])
    record = prediction_record(bands, metrics, topk(importances, TOP, by=["target"]), tickers=tickers,
                               run_date=run_date, target_month=target_month)
    overwrite_version(record, f"{root}/{RESULTS}", run_date, fmt)
    return read_versions(spark, f"{root}/{RESULTS}", _results_schema(names), fmt).where(F.col(VERSION) == version)


def report(
    spark: SparkSession,
    *,
    root: str,
    run_date: date,
    tickers: Mapping[str, str] = TICKERS,
    indicators: Mapping[str, str] = INDICATORS,
    units: Mapping[str, str] = UNITS,
    fmt: str = "parquet",
) -> DataFrame:
    """Write the report lines of the latest forecast and the latest indicator levels."""
    names, ind = list(tickers.values()), list(indicators.values())
    record = read_latest(spark, f"{root}/{RESULTS}", _results_schema(names), fmt)
    dataset = read_latest(spark, f"{root}/{DATASET}", dataset_schema(names, ind), fmt)

    def per_ticker(make) -> DataFrame:
        return stack_long([make(t) for t in names])

    predictions = per_ticker(lambda t: record.select(
        F.lit(t).alias("target"), F.col(f"{t}_Predicted_Return").alias("mean"),
        F.col(f"{t}_Confidence_Lower").alias("p25"), F.col(f"{t}_Confidence_Upper").alias("p75")))
    metrics = per_ticker(lambda t: record.select(
        F.lit(t).alias("target"), F.lit("r2").alias("metric"), F.col(f"{t}_R2_Score").alias("value")))
    tops = per_ticker(lambda t: unpivot_topk(
        record.withColumn("target", F.lit(t)), TOP, by=["target"], pattern=f"{t}_Top{{i}}_{{what}}", feature="Feature", importance="Importance"))
    newest = latest_row(dataset.select("Date", *ind), by=[], time="Date")
    snapshot = newest.unpivot([], ind, "name", "value")
    months = record.select(F.col("Target_Month").alias("target_month"))
    lines = report_lines(months=months, predictions=predictions, metrics=metrics, tops=tops, snapshot=snapshot, units=units)
    write_lines(lines, f"{root}/{REPORTS}/{VERSION}={version_label(run_date)}")
    return lines
