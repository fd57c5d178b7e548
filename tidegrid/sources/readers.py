"""Table scans."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid.functions.numeric import nan_to_null
from tidegrid.operators.select import lookback


def missing_as_null(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL in every floating column."""
    floats = (T.DoubleType, T.FloatType)
    return df.withColumns({
        f.name: nan_to_null(F.col(f.name)) for f in df.schema.fields if isinstance(f.dataType, floats)
    })


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Headered text table with an explicit schema; a malformed row fails the job."""
    df = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)
    return missing_as_null(df)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return missing_as_null(spark.read.parquet(path))


def scan_series(
    df: DataFrame, ids: Sequence[object], lo: date, hi: date, *, series: str, ts: str
) -> DataFrame:
    """Rows of the requested series in the half-open range ``[lo, hi)``.

    Both conditions are on raw columns and reach the file scan. A series that does not exist
    contributes no rows; later alignment still gives it an empty column, and
    :func:`tidegrid.operators.profile.series_coverage` reports it.
    """
    return lookback(df.where(F.col(series).isin(list(ids))), ts, lo, hi)
