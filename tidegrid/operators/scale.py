"""Standardisation with the population deviation; a constant column becomes 0."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.operators.windows import whole


def _z(x: Column, mean: Column, std: Column) -> Column:
    return F.when(std != 0, (x - mean) / std).when(x.isNotNull(), F.lit(0.0))


def standardize(df: DataFrame, columns: dict[str, str], *, by: Sequence[str] = ()) -> DataFrame:
    """Add the z-score of each input column under its output name.

    Whole-column statistics are one aggregate that reaches the rows as a scalar subquery, so the
    transform itself is a projection. With ``by``, statistics are taken within each series.
    """
    if by:
        w = whole(by)
        return df.withColumns({out: _z(F.col(c), F.avg(c).over(w), F.stddev_pop(c).over(w))
                               for c, out in columns.items()})
    parts = [s for i, c in enumerate(columns) for s in (F.avg(c).alias(f"m{i}"), F.stddev_pop(c).alias(f"s{i}"))]
    names = [f"{k}{i}" for i in range(len(columns)) for k in "ms"]
    fitted = df.agg(*parts).select(F.struct(*names)).scalar()
    # Taking the fields from one column keeps it a single subquery.
    scored = df.withColumn("_fit", fitted)
    return scored.withColumns({out: _z(F.col(c), F.col(f"_fit.m{i}"), F.col(f"_fit.s{i}"))
                               for i, (c, out) in enumerate(columns.items())}).drop("_fit")
