"""Standard panels over the benchmark tables, used by the registered queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.operators.grid import resample_last
from tidegrid.sources.readers import read_parquet

TICKERS = {
    "1-URGENT": "Urgent",
    "2-HIGH": "High",
    "3-MEDIUM": "Medium",
    "4-NOT SPECIFIED": "Unspecified",
    "5-LOW": "Low",
}
INDICATORS = {"A": "Accepted", "N": "None", "R": "Returned"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet")


def money_sum(column: str) -> Column:
    """Sum in whole cents, as a double."""
    return F.sum(F.col(column).cast("decimal(28,2)")).cast("double")


def _orders(spark: SparkSession, sf_dir: str, key: str, series: str, grain: str, sparse: bool = False) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(
        F.col(key).alias(series), "o_orderdate", "o_orderkey", F.col("o_totalprice").alias("price"))
    return resample_last(rows, by=[series], ts="o_orderdate", value="price", grain=grain, tie_break="o_orderkey",
                         sparse=sparse)


def price_panel(spark: SparkSession, sf_dir: str, grain: str = "month") -> DataFrame:
    """Last order value per priority and period: few series, many raw rows each."""
    return _orders(spark, sf_dir, "o_orderpriority", "o_orderpriority", grain)


def wide_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last order value per customer and month: many sparse series."""
    return _orders(spark, sf_dir, "o_custkey", "o_custkey", "month", sparse=True)


def indicator_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per return flag, the revenue of the last shipping day of each month.

    Daily totals are sums of cents, so the panel does not depend on summation order.
    """
    daily = table(spark, sf_dir, "lineitem").groupBy("l_returnflag", F.to_date("l_shipdate").alias("day")).agg(
        money_sum("l_extendedprice").alias("revenue"))
    return resample_last(daily, by=["l_returnflag"], ts="day", value="revenue")


def discount_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lowest discount per supplier and month; often zero."""
    return table(spark, sf_dir, "lineitem").groupBy("l_suppkey", F.trunc("l_shipdate", "MM").alias("month")).agg(
        F.min("l_discount").alias("discount"))


def long_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return price_panel(spark, sf_dir).toDF("series_id", "period", "value")


def quarterly_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per return flag, the revenue of the last shipping day of each quarter, dated by its first month."""
    daily = table(spark, sf_dir, "lineitem").groupBy("l_returnflag", F.to_date("l_shipdate").alias("day")).agg(
        money_sum("l_extendedprice").alias("revenue"))
    quarters = resample_last(daily, by=["l_returnflag"], ts="day", value="revenue", grain="quarter")
    return quarters.toDF("series_id", "period", "value")


def long_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    return indicator_panel(spark, sf_dir).toDF("series_id", "period", "value")
