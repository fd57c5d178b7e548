"""Counts, profiles, quality gates and descriptive statistics."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.numeric import is_inf
from tidegrid.operators.quantiles import edge_aggregates, quantiles_from_edges, read_edges

# The statistics table's rows and their order.
STATISTICS = ("count", "mean", "std", "min", "25%", "50%", "75%", "max")


def _count_if(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def _column_counts(df: DataFrame, columns: Sequence[str], test, out: str) -> DataFrame:
    """One pass over ``df``, then columns to rows; only columns with a hit remain."""
    row = df.agg(*[_count_if(test(F.col(c))).alias(c) for c in columns])
    return row.unpivot([], list(columns), "column_name", out).where(F.col(out) > 0)


def missing_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number of missing values of each column that has any."""
    return _column_counts(df, columns, lambda c: c.isNull(), "n_missing")


def inf_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number of infinite values of each column that has any."""
    return _column_counts(df, columns, is_inf, "n_inf")


def quality_gate(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: rows, missing and infinite cells over all columns, and whether the frame passes."""
    missing = sum((F.col(c).isNull().cast("bigint") for c in columns), F.lit(0).cast("bigint"))
    infinite = sum((F.coalesce(is_inf(F.col(c)), F.lit(False)).cast("bigint") for c in columns),
                   F.lit(0).cast("bigint"))
    totals = df.agg(
        F.count("*").alias("n_rows"),
        F.coalesce(F.sum(missing), F.lit(0).cast("bigint")).alias("n_missing"),
        F.coalesce(F.sum(infinite), F.lit(0).cast("bigint")).alias("n_inf"),
    )
    return totals.withColumn("passed", (F.col("n_missing") == 0) & (F.col("n_inf") == 0))


def require_clean(df: DataFrame, columns: Sequence[str]) -> int:
    """Raise unless the frame is free of missing and infinite cells; returns the row count."""
    gate = quality_gate(df, columns).first()
    if not gate["passed"]:
        raise ValueError(f"{gate['n_missing']} missing and {gate['n_inf']} infinite cells remain")
    return gate["n_rows"]


def require_columns(df: DataFrame, columns: Iterable[str]) -> None:
    """Raise when a needed column is absent, before any job runs."""
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"missing required columns: {', '.join(absent)}")


def series_coverage(df: DataFrame, wanted: DataFrame, *, series: str, value: str) -> DataFrame:
    """Observed values and grid rows of each requested series; absent series show zero.

    ``wanted`` has one row per requested series in its column ``series``.
    """
    found = df.groupBy(series).agg(F.count(value).alias("n_obs"), F.count("*").alias("n_grid"))
    zero = F.lit(0).cast("bigint")
    return wanted.select(series).join(found, series, "left").select(
        series,
        F.coalesce("n_obs", zero).alias("n_obs"),
        F.coalesce("n_grid", zero).alias("n_grid"),
        (F.coalesce("n_obs", zero) == 0).alias("is_empty"),
    )


def numeric_columns(df: DataFrame) -> list[str]:
    kinds = ("int", "bigint", "smallint", "tinyint", "double", "float", "decimal")
    return [name for name, kind in df.dtypes if kind.split("(")[0] in kinds]


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Long statistics table ``(stat, column_name, value)`` of the numeric columns.

    ``std`` is the sample deviation and quartiles interpolate linearly. Moments come from one
    aggregate; quartiles from the exact distributed quantiles. The few resulting numbers are kept
    as a local table.
    """
    cols = list(columns) if columns is not None else numeric_columns(df)
    moments = [agg(F.col(c).cast("double")).alias(f"_{k}{i}")
               for i, c in enumerate(cols) for k, agg in (("mean", F.avg), ("std", F.stddev_samp))]
    probs = [0.25, 0.5, 0.75]
    row = df.agg(*edge_aggregates(cols, probs), *moments).first()
    edges = read_edges(row, cols, probs)
    quarts = quantiles_from_edges(df, edges, probs)
    cells = []
    for i, c in enumerate(cols):
        e = edges[c]
        values = (float(e.rows), row[f"_mean{i}"], row[f"_std{i}"], e.lo, *quarts[c], e.hi)
        cells += [(stat, c, value) for stat, value in zip(STATISTICS, values)]
    return df.sparkSession.createDataFrame(cells, "stat string, column_name string, value double")


def describe_wide(stats: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Statistics table with one row per statistic and one column per described column."""
    order = F.array_position(F.array(*[F.lit(s) for s in STATISTICS]), F.col("stat"))
    cells = [F.max(F.when(F.col("column_name") == c, F.col("value"))).alias(c) for c in columns]
    return stats.groupBy("stat").agg(*cells).orderBy(order)


def r2_score(df: DataFrame, label: str, prediction: str, *, by: Sequence[str] = ()) -> DataFrame:
    """Coefficient of determination per group, over rows where both sides are known.

    A constant label gives 1 for a perfect and 0 for any other prediction.
    """
    known = df.where(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    sums = known.groupBy(*by).agg(
        F.sum(F.pow(F.col(label) - F.col(prediction), 2)).alias("_sse"),
        (F.var_pop(label) * F.count(label)).alias("_sst"),
    )
    r2 = F.when(F.col("_sst") != 0, 1 - F.col("_sse") / F.col("_sst")).when(F.col("_sse") == 0, 1.0).otherwise(0.0)
    return sums.select(*by, r2.alias("r2"))
