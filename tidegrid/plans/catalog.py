"""The registered queries: every operator over whole benchmark tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.functions.numeric import fraction_to_percent, ieee_div, rint_to
from tidegrid.functions.numeric import inf_to_null as finite_or_null
from tidegrid.functions.periods import lookback_bounds, period_label
from tidegrid.operators import change, encode, fill, folds, forest, grid, profile, rank, segments, select
from tidegrid.operators.ensemble import ensemble_band as band_of_votes
from tidegrid.operators.quantiles import column_medians as column_medians_of
from tidegrid.operators.quantiles import column_quantiles
from tidegrid.operators.scale import standardize as z_scores
from tidegrid.operators.windows import ordered
from tidegrid.plans import features, report, supervised
from tidegrid.plans.inputs import (
    INDICATORS,
    TICKERS,
    discount_panel,
    indicator_panel,
    long_indicators,
    long_prices,
    money_sum,
    price_panel,
    quarterly_indicators,
    table,
    wide_panel,
)
from tidegrid.session import stored
from tidegrid.sources import readers, versions, writers
from tidegrid.sources.schemas import lag_columns, target_column

RUN_DATE = date(2001, 8, 15)
PRIORITY, CUSTOMER, FLAG = ["o_orderpriority"], ["o_custkey"], ["l_returnflag"]
NAMES, INDICATOR_NAMES = list(TICKERS.values()), list(INDICATORS.values())

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


# Scans and date ranges


@_query
def scan_prices(spark, sf):
    lo, hi = lookback_bounds(RUN_DATE, 36)
    rows = readers.scan_series(table(spark, sf, "orders"), [*TICKERS, "9-ABSENT"], lo, hi,
                               series="o_orderpriority", ts="o_orderdate")
    return rows.select("o_orderpriority", "o_orderkey", F.to_date("o_orderdate").alias("day"), "o_totalprice")


@_query
def scan_indicators(spark, sf):
    lo, hi = lookback_bounds(RUN_DATE, 36)
    rows = readers.scan_series(table(spark, sf, "lineitem"), list(INDICATORS), lo, hi,
                               series="l_returnflag", ts="l_shipdate")
    return rows.select("l_returnflag", "l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("day"),
                       "l_extendedprice")


@_query
def lookback_window(spark, sf):
    spans = {m: lookback_bounds(RUN_DATE, m) for m in (2, 36)}
    orders = table(spark, sf, "orders")
    reach = select.lookback(orders, "o_orderdate", min(lo for lo, _ in spans.values()), RUN_DATE.replace(day=1))
    at = F.col("o_orderdate")
    counts = reach.agg(*[F.count(F.when((at >= F.lit(lo)) & (at < F.lit(hi)), 1)).alias(str(m))
                         for m, (lo, hi) in spans.items()])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(m).alias("months"), F.lit(lo).alias("lo"), F.lit(hi).alias("hi"),
                 F.col(str(m)).alias("n_rows")) for m, (lo, hi) in spans.items()])))


# Grid, changes, lags


@_query
def resample_last(spark, sf):
    return price_panel(spark, sf)


@_query
def resample_daily(spark, sf):
    events = table(spark, sf, "events")
    daily = grid.resample_last(events, by=["event_type"], ts="ts", value="value", grain="day", out_time="day",
                               tie_break="event_id")
    dense = grid.densify(daily, by=["event_type"], time="day", grain="day")
    return change.percent_change(dense, "value", "wow", by=["event_type"], time="day", periods=7)


def _price_grid(spark, sf):
    return grid.densify(price_panel(spark, sf), by=PRIORITY)


def _wide_grid(spark, sf):
    return grid.densify(wide_panel(spark, sf), by=CUSTOMER)


@_query
def calendar_spine(spark, sf):
    return _wide_grid(spark, sf)


@_query
def period_return(spark, sf):
    returns = change.period_return(_price_grid(spark, sf), "price", by=PRIORITY)
    return returns.select("o_orderpriority", "month", rint_to(F.col("ret"), 6).alias("ret"))


@_query
def yoy_change(spark, sf):
    return change.yoy_change(_wide_grid(spark, sf), "price", by=CUSTOMER)


@_query
def mom_change(spark, sf):
    return change.mom_change(_price_grid(spark, sf), "price", by=PRIORITY)


def _discount_change(spark, sf):
    by = ["l_suppkey"]
    dense = grid.densify(discount_panel(spark, sf), by=by)
    previous = F.lag("discount").over(ordered(by, "month"))
    return dense.withColumn("previous", previous).withColumn(
        "chg", rint_to(ieee_div(F.col("discount") - F.col("previous"), F.col("previous")) * 100))


@_query
def zero_base_change(spark, sf):
    kind = (F.when(F.col("chg") == float("inf"), "+inf").when(F.col("chg") == float("-inf"), "-inf")
            .when(F.col("chg").isNotNull(), "finite")
            .when((F.col("discount") == 0) & (F.col("previous") == 0), "zero over zero").otherwise("unknown"))
    return _discount_change(spark, sf).select(
        "l_suppkey", "month", kind.alias("chg_class"), finite_or_null(F.col("chg")).alias("chg"))


@_query
def inf_to_null(spark, sf):
    return _discount_change(spark, sf).select("l_suppkey", "month", finite_or_null(F.col("chg")).alias("clean"))


def _returns(spark, sf):
    return change.period_return(_price_grid(spark, sf), "price", by=PRIORITY)


@_query
def lag_features(spark, sf):
    lagged = change.add_lags(_returns(spark, sf), "ret", ["prev1", "prev2", "prev3"], by=PRIORITY)
    return lagged.select("o_orderpriority", "month", *[rint_to(F.col(c), 6).alias(c) for c in ("prev1", "prev2", "prev3")])


@_query
def lead_target(spark, sf):
    led = change.add_lead(_returns(spark, sf), "ret", "next1", by=PRIORITY)
    return led.select("o_orderpriority", "month", rint_to(F.col("next1"), 6).alias("next1"))


@_query
def percent_scale(spark, sf):
    return _returns(spark, sf).select("o_orderpriority", "month", fraction_to_percent(F.col("ret")).alias("pct"))


# Imputation


@_query
def ffill(spark, sf):
    dense = _wide_grid(spark, sf).withColumn("filled", F.col("price"))
    return fill.ffill(dense, ["filled"], by=CUSTOMER)


@_query
def ffill_bfill(spark, sf):
    # The yearly change starts late in each series, so both directions have work to do.
    dense = change.yoy_change(_wide_grid(spark, sf), "price", by=CUSTOMER).withColumn("filled", F.col("yoy"))
    return fill.ffill_bfill(dense, ["filled"], by=CUSTOMER)


@_query
def fill_zero(spark, sf):
    dense = change.yoy_change(_wide_grid(spark, sf), "price", by=CUSTOMER)
    return fill.fill_constant(dense.withColumn("filled", F.col("yoy")), ["filled"])


@_query
def fill_median(spark, sf):
    dense = _wide_grid(spark, sf).withColumn("filled", F.col("price"))
    filled = fill.fill_median(dense, ["filled"], by=CUSTOMER)
    return filled.withColumn("filled", rint_to(F.col("filled"), 4))


@_query
def fill_expanding_median(spark, sf):
    dense = _price_grid(spark, sf).withColumn("filled", F.when(F.month("month") % 3 != 0, F.col("price")))
    filled = fill.fill_expanding_median(dense, ["filled"], by=PRIORITY)
    return filled.withColumn("filled", rint_to(F.col("filled"), 4))


@_query
def fill_global_median(spark, sf):
    # Gaps do not enter a median: it is fitted on the observed rows, before the grid is made dense.
    medians = column_medians_of(wide_panel(spark, sf), ["price"])
    filled = fill.fill_values(_wide_grid(spark, sf).withColumn("filled", F.col("price")), {"filled": medians["price"]})
    return filled.withColumn("filled", rint_to(F.col("filled"), 4))


@_query
def impute_chain(spark, sf):
    dense = _wide_grid(spark, sf)
    derived = change.period_return(change.yoy_change(dense, "price", by=CUSTOMER), "price", by=CUSTOMER)
    chain = fill.impute_chain(derived, levels=["price"], changes=["yoy"], returns=["ret"], by=CUSTOMER)
    return chain.select("o_custkey", "month", F.col("price").alias("level"), "yoy",
                        rint_to(F.col("ret"), 6).alias("ret"))


# Alignment


@_query
def asof_carry(spark, sf):
    quarterly = price_panel(spark, sf, grain="quarter").withColumnRenamed("price", "q_price")
    base = _price_grid(spark, sf).select("o_orderpriority", "month")
    return grid.asof_carry(base, quarterly, by=PRIORITY, time="month", value="q_price")


@_query
def align_outer(spark, sf):
    stacked = grid.stack_long([
        _price_grid(spark, sf).toDF("series_id", "month", "price"),
        grid.densify(indicator_panel(spark, sf), by=FLAG).toDF("series_id", "month", "revenue"),
    ])
    cells = {name: (sid, "price") for sid, name in TICKERS.items()}
    cells |= {name: (sid, "revenue") for sid, name in INDICATORS.items()}
    return grid.align_wide(stacked, on=["month"], series="series_id", columns=cells)


# Calendar


def _months(spark, sf):
    return table(spark, sf, "orders").select(F.trunc("o_orderdate", "MM").alias("month")).distinct()


@_query
def calendar_parts(spark, sf):
    parts = encode.calendar_parts(_months(spark, sf), year="year", month="month_no", quarter="quarter")
    return parts.withColumn("month_end", F.last_day("month"))


@_query
def format_period(spark, sf):
    labelled = _months(spark, sf).withColumns({
        "ym_us": F.date_format("month", "yyyy_MM"),
        "ymd": F.date_format("month", "yyyy-MM-dd"),
        "ym": period_label(F.col("month")),
    })
    return select.move_to_front(labelled, "ym")


def _calendar(spark, sf):
    return encode.calendar_parts(_months(spark, sf).withColumnRenamed("month", "period"), "period")


@_query
def onehot_month(spark, sf):
    return encode.onehot_month(_calendar(spark, sf)).select("period", *encode.MONTH_FLAGS.values())


@_query
def onehot_quarter(spark, sf):
    return encode.onehot_quarter(_calendar(spark, sf)).select("period", *encode.QUARTER_FLAGS.values())


@_query
def cyclic_month(spark, sf):
    return encode.cyclic_month(_calendar(spark, sf)).select(
        "period", rint_to(F.col("Month_Sin"), 12).alias("m_sin"), rint_to(F.col("Month_Cos"), 12).alias("m_cos"))


# Supervised frames


@_query
def supervised_frame(spark, sf):
    return supervised.supervised_frame(long_prices(spark, sf), long_indicators(spark, sf),
                                       tickers=TICKERS, indicators=INDICATORS)


@_query
def supervised_panel(spark, sf):
    prices = wide_panel(spark, sf).toDF("o_custkey", "period", "value")
    return supervised.supervised_panel(prices, long_indicators(spark, sf), indicators=INDICATORS, series="o_custkey")


@_query
def supervised_panel_quarterly(spark, sf):
    """Indicators that are observed every third month only."""
    prices = wide_panel(spark, sf).toDF("o_custkey", "period", "value")
    return supervised.supervised_panel(prices, quarterly_indicators(spark, sf), indicators=INDICATORS, series="o_custkey")


@_query
def select_by_pattern(spark, sf):
    return select.select_matching(supervised_frame(spark, sf), "YOY", "MOM", keep=["period"])


@_query
def feature_matrix(spark, sf):
    matrix = features.feature_matrix(supervised_frame(spark, sf), tickers=NAMES, indicators=INDICATOR_NAMES)
    return matrix.withColumns({c: rint_to(F.col(c), 9) for c in ("Month_Sin", "Month_Cos", *_lags())})


def _lags():
    return [c for t in NAMES for c in lag_columns(t)]


@_query
def training_frame(spark, sf):
    frame = features.training_frame(supervised_frame(spark, sf), tickers=NAMES, indicators=INDICATOR_NAMES,
                                    run_date=RUN_DATE)
    rounded = ("Month_Sin", "Month_Cos", *_lags(), *[target_column(t) for t in NAMES])
    return frame.withColumns({c: rint_to(F.col(c), 9) for c in rounded})


def _own_features(spark, sf):
    """Complete features of the customer panel: a customer without any return takes the median of
    all customers. The customers' own columns are cut from their lineage, as the medians read them again: three of them. So is
    the calendar, which is known to be small then and joins the rows where they are."""
    prices = wide_panel(spark, sf).toDF("o_custkey", "period", "value")
    own = stored(features.panel_lags(supervised.own_panel(prices, series="o_custkey"), by=CUSTOMER))
    # The calendar needs the extent of the prices only, which the raw dates have without the panel.
    months = table(spark, sf, "orders").select(F.trunc("o_orderdate", "MM").alias("period"))
    calendar = stored(supervised.shared_calendar(months, long_indicators(spark, sf), indicators=INDICATORS))
    matrix = features.panel_join(own, calendar, indicators=INDICATOR_NAMES, by=CUSTOMER, keep=[target_column("Own")])
    overall = column_medians_of(own, lag_columns("Own"))
    return fill.fill_values(matrix, overall)


@_query
def feature_panel(spark, sf):
    rounded = ("Month_Sin", "Month_Cos", *lag_columns("Own"))
    matrix = _own_features(spark, sf).drop(target_column("Own"))
    return matrix.withColumns({c: rint_to(F.col(c), 9) for c in rounded})


# Selection


@_query
def drop_last_period(spark, sf):
    return select.drop_last_period(_price_grid(spark, sf), by=PRIORITY)


@_query
def latest_row(spark, sf):
    return select.latest_row(wide_panel(spark, sf), by=CUSTOMER)


# Profiles and statistics


def _value_columns(frame):
    return [c for c in frame.columns if c != "period"]


@_query
def missing_profile(spark, sf):
    frame = supervised_frame(spark, sf)
    return profile.missing_profile(frame, _value_columns(frame))


@_query
def inf_profile(spark, sf):
    return profile.inf_profile(_discount_change(spark, sf), ["discount", "previous", "chg"])


@_query
def series_coverage(spark, sf):
    wanted = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"))
    return profile.series_coverage(_wide_grid(spark, sf), wanted, series="o_custkey", value="price")


@_query
def column_medians(spark, sf):
    rows = table(spark, sf, "lineitem")
    medians = column_quantiles(rows, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], [0.5])
    return spark.createDataFrame([(c, q[0]) for c, q in medians.items()], "column_name string, median double").select(
        "column_name", rint_to(F.col("median"), 4).alias("median"))


@_query
def quality_gate(spark, sf):
    matrix = feature_matrix(spark, sf)
    return profile.quality_gate(matrix, _value_columns(matrix))


@_query
def describe(spark, sf):
    orders = profile.describe(table(spark, sf, "orders"))
    lines = profile.describe(table(spark, sf, "lineitem"))
    return orders.unionByName(lines).withColumn("value", rint_to(F.col("value"), 4))


@_query
def standardize(spark, sf):
    priced = wide_panel(spark, sf).withColumn("const", F.lit(1.0))
    return z_scores(priced, {"price": "z", "const": "z_const"}).select(
        "o_custkey", "month", rint_to(F.col("z"), 6).alias("z"), "z_const")


@_query
def r2_score(spark, sf):
    carried = fill.ffill(_wide_grid(spark, sf).withColumn("carried", F.col("price")), ["carried"], by=CUSTOMER)
    guessed = carried.withColumn("guess", F.lag("carried").over(ordered(CUSTOMER, "month")))
    return profile.r2_score(guessed, "price", "guess", by=CUSTOMER).select(
        "o_custkey", rint_to(F.col("r2"), 6).alias("r2"))


@_query
def kfold_ids(spark, sf):
    return folds.series_folds(_price_grid(spark, sf).select("o_orderpriority", "month"), 5, by=PRIORITY)


@_query
def calendar_kfold_ids(spark, sf):
    return folds.calendar_folds(_wide_grid(spark, sf).select("o_custkey", "month"), 5)


# Orders longer than a task: events, whole and by type


def _ticks(spark, sf):
    return table(spark, sf, "events").select("event_id", "ts", "event_type", "value")


@_query
def carry_ticks(spark, sf):
    """The value of the last purchase before or at each event."""
    ticks = _ticks(spark, sf).withColumn("filled", F.when(F.col("event_type") == "purchase", F.col("value")))
    return segments.carry(ticks, ["filled"], order=["ts", "event_id"])


@_query
def carry_series_ticks(spark, sf):
    """Few long series with values at every third event, carried both ways."""
    ticks = _ticks(spark, sf).withColumn("filled", F.when(F.col("event_id") % 3 == 0, F.col("value")))
    return segments.carry(ticks, ["filled"], by=["event_type"], order=["ts", "event_id"], back=True)


@_query
def asof_ticks(spark, sf):
    """Errors with the last purchase at or before them."""
    ticks = _ticks(spark, sf)
    errors = ticks.where("event_type = 'error'").select("event_id", "ts")
    return segments.asof(errors, ticks.where("event_type = 'purchase'"), time="ts", value="value", tie_break="event_id")


@_query
def number_ticks(spark, sf):
    numbered = segments.row_index(_ticks(spark, sf), order=["ts", "event_id"])
    return segments.row_index(numbered, by=["event_type"], order=["ts", "event_id"], out="type_idx")


@_query
def fold_ticks(spark, sf):
    return folds.calendar_folds(_ticks(spark, sf).select("event_id", "ts"), 5, time="ts")


@_query
def ensemble_band(spark, sf):
    bands = band_of_votes(table(spark, sf, "embeddings"), "embedding")
    return bands.select("vec_id", *[rint_to(F.col(c), 9).alias(c) for c in ("mean", "std", "p25", "p75")])


# Versioned storage


def _versioned(spark, sf):
    return versions.stamp_version(table(spark, sf, "orders"), "o_orderdate")


@_query
def stamp_version(spark, sf):
    return _versioned(spark, sf).groupBy("version").agg(F.count("*").alias("n"))


@_query
def list_versions(spark, sf):
    return versions.list_versions(_versioned(spark, sf))


@_query
def latest_version(spark, sf):
    # The version is a function of the date, so the newest one is a date range that reaches the scan.
    orders = table(spark, sf, "orders")
    newest = orders.agg(F.trunc(F.max("o_orderdate"), "MM")).first()[0]
    recent = orders.where(F.col("o_orderdate") >= F.lit(newest)) if newest else orders
    return versions.stamp_version(recent, "o_orderdate").select(
        "version", "o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice")


@_query
def append_if_absent(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice",
                                               F.to_date("o_orderdate").alias("day"))
    known = orders.where(F.col("day") < F.lit(date(2000, 1, 1)))
    delivered = orders.where(F.col("day") >= F.lit(date(1999, 1, 1))).withColumn(
        "o_totalprice", rint_to(F.col("o_totalprice") * 2, 2))
    return writers.append_if_absent(known, delivered, ["o_orderkey"])


@_query
def append_repeated_keys(spark, sf):
    """A delivery keyed by customer: keys repeat, and those of every seventh customer are missing."""
    orders = table(spark, sf, "orders").select(
        F.when(F.col("o_custkey") % 7 != 0, F.col("o_custkey")).alias("k"), "o_orderkey", "o_totalprice")
    known = orders.where((F.col("o_orderkey") % 5 == 0) & F.col("k").isNotNull())
    return writers.append_if_absent(known, orders.where(F.col("o_orderkey") % 5 != 0), ["k"], order=["o_orderkey"])


# Ranking and report data


def _ranked(spark, sf):
    revenue = table(spark, sf, "lineitem").groupBy("l_returnflag", F.col("l_partkey").cast("string").alias("feature")).agg(
        money_sum("l_extendedprice").alias("importance"))
    return rank.topk(revenue, 5, by=FLAG)


@_query
def topk_importance(spark, sf):
    return _ranked(spark, sf).select("l_returnflag", "rank", "feature", "importance")


@_query
def prediction_record(spark, sf):
    return rank.topk_record(_ranked(spark, sf), 5, by=FLAG)


@_query
def unpivot_topk(spark, sf):
    return rank.unpivot_topk(prediction_record(spark, sf), 5, by=FLAG)


@_query
def report_lines(spark, sf):
    levels = select.latest_row(grid.densify(indicator_panel(spark, sf), by=FLAG), by=FLAG)
    snapshot = levels.select(F.col("l_returnflag").alias("name"), F.col("revenue").alias("value"))
    tops = _ranked(spark, sf).withColumnRenamed("l_returnflag", "target")
    lines = table(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias("target"))
    predictions = lines.agg(F.avg(F.col("l_discount").cast("decimal(18,4)")).cast("double").alias("mean"),
                            F.min("l_tax").alias("p25"), F.max("l_tax").alias("p75"))
    metrics = lines.agg(F.max("l_discount").alias("value")).withColumn("metric", F.lit("r2"))
    return report.report_lines(predictions=predictions, metrics=metrics, snapshot=snapshot, tops=tops)


# Forests


KEYS = [*PRIORITY, "period"]
TARGET = target_column("Own")


def _panel_training(spark, sf):
    """Training rows of the priority panel, cut from their lineage before the folds and fits."""
    prices = price_panel(spark, sf).toDF("o_orderpriority", "period", "value")
    calendar = supervised.shared_calendar(prices, long_indicators(spark, sf), indicators=INDICATORS)
    matrix = features.panel_matrix(supervised.own_panel(prices, series="o_orderpriority"), calendar,
                                   indicators=INDICATOR_NAMES, by=PRIORITY, keep=[TARGET])
    frame = stored(fill.fill_median(matrix, [TARGET], by=PRIORITY))
    return folds.calendar_folds(frame, 5, time="period"), features.feature_columns(["Own"], INDICATOR_NAMES)


def _fitted(spark, sf):
    frame, cols = _panel_training(spark, sf)
    return frame, forest.fit_forests(frame, cols, [TARGET], keys=KEYS)


def _near(a, b):
    return F.abs(F.col(a) - F.col(b)) <= F.lit(1e-9) * F.greatest(F.lit(1.0), F.abs(F.col(b)))


def _within_labels(predicted, labelled):
    """Whether each prediction lies between the least and the greatest label, as a mean of labels must."""
    lo, hi = labelled.agg(F.min(TARGET), F.max(TARGET)).first()
    return predicted.withColumn("within_labels", F.col("prediction").between(lo - 1e-9, hi + 1e-9))


# A forest has no SQL equivalent, so these queries fit and predict in full and return, for every key, whether what must hold
# of its values does.


@_query
def forest_fit_predict(spark, sf):
    frame, bundle = _fitted(spark, sf)
    predicted = forest.predict(frame, bundle, TARGET)
    # A forest that always answered the mean label would have an R2 of 0 over the rows that it was fitted on.
    r2 = profile.r2_score(predicted, TARGET, "prediction").first()["r2"]
    return _within_labels(predicted, frame).select(*KEYS, "within_labels", F.lit(r2 > 0.25).alias("better_than_mean"))


@_query
def forest_band(spark, sf):
    frame, bundle = _fitted(spark, sf)
    bands = forest.forest_band(forest.predict(frame, bundle, TARGET), bundle, TARGET)
    return bands.select(*KEYS, _near("mean", "prediction").alias("mean_is_prediction"),
                        (F.col("p25") <= F.col("p75")).alias("band_in_order"), (F.col("std") >= 0).alias("spread_known"))


@_query
def feature_importance(spark, sf):
    frame, bundle = _fitted(spark, sf)
    ranked = forest.feature_importance(bundle, frame, TARGET)
    total, count, last = ranked.agg(F.sum("importance"), F.count("*"), F.max("rank")).first()
    return ranked.select("feature", F.col("importance").between(0, 1).alias("is_share"),
                         F.lit(abs(total - 1) < 1e-9).alias("total_is_one"), F.lit(last == count).alias("ranks_complete"))


@_query
def cv_scores(spark, sf):
    frame, cols = _panel_training(spark, sf)
    predicted = forest.out_of_fold(frame, forest.fit_scaler(frame, cols), [TARGET], "fold", keys=KEYS)
    scores = stored(forest.fold_scores(predicted, "fold"))
    by_hand = scores.groupBy("target").agg(
        (F.sum("r2") / F.count("r2")).alias("mean"),
        F.sqrt(F.sum(F.col("r2") * F.col("r2")) / F.count("r2") - F.pow(F.sum("r2") / F.count("r2"), 2)).alias("std"))
    joined = scores.join(forest.cv_scores(scores), "target").join(by_hand, "target")
    return joined.select("target", "fold", (F.col("r2") <= 1).alias("is_score"), _near("fold_mean", "mean").alias("mean_holds"),
                         (F.abs(F.col("fold_std") - F.col("std")) <= 1e-6).alias("std_holds"))


@_query
def model_metrics(spark, sf):
    frame, bundle = _fitted(spark, sf)
    metrics = forest.model_metrics(frame, bundle, "fold", 5, keys=KEYS)
    holds = F.when(F.col("metric") == "cv_std", F.col("value") >= 0).when(
        F.col("metric") == "r2", (F.col("value") > 0.25) & (F.col("value") <= 1)).otherwise(F.col("value") <= 1)
    return metrics.select("target", "metric", holds.alias("holds"))


@_query
def forest_panel(spark, sf):
    """One forest over all customers: the fit grows with the panel."""
    frame = _own_features(spark, sf)
    labelled = frame.dropna(subset=[TARGET])
    cols = features.feature_columns(["Own"], INDICATOR_NAMES)
    by_month = [c for c in cols if c not in lag_columns("Own")]
    bundle = forest.fit_forests(labelled, cols, [TARGET], keys=[*CUSTOMER, "period"], shared=("period", by_month))
    return _within_labels(forest.predict(frame, bundle, TARGET), labelled).select("o_custkey", "period", "within_labels")


@_query
def fold_scores(spark, sf):
    """The validation arithmetic on a predictor that SQL has too: the last known price."""
    carried = fill.ffill(_price_grid(spark, sf).withColumn("carried", F.col("price")), ["carried"], by=PRIORITY)
    guessed = carried.withColumn("guess", F.lag("carried").over(ordered(PRIORITY, "month")))
    dealt = folds.calendar_folds(guessed, 5)
    scores = forest.fold_scores(dealt.select(F.lit("price").alias("target"), "fold", F.col("price").alias("label"),
                                             F.col("guess").alias("prediction")), "fold")
    summary = forest.cv_scores(scores)
    return scores.join(summary, "target").select("fold", *[
        rint_to(F.col(c), 6).alias(c) for c in ("r2", "fold_mean", "fold_std")])
