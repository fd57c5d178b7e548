"""Prediction spread across the members of an ensemble."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _quantile(sorted_votes: Column, p: float) -> Column:
    """Linearly interpolated quantile of a sorted array."""
    pos = F.lit(p) * (F.size(sorted_votes) - 1)
    lo = F.floor(pos).cast("int")
    a = F.get(sorted_votes, lo)
    b = F.coalesce(F.get(sorted_votes, lo + 1), a)
    return a + (b - a) * (pos - lo)


def ensemble_band(
    df: DataFrame, votes: str, *, mean: str = "mean", std: str = "std", lower: str = "p25", upper: str = "p75"
) -> DataFrame:
    """Mean, population deviation and inter-quartile band of an array of member predictions.

    Works inside each row: votes are never exploded, so there is no shuffle.
    """
    v = F.transform(votes, lambda x: x.cast("double"))
    with_votes = df.withColumn("_sorted", F.array_sort(v))
    s = F.col("_sorted")
    n = F.size(s)
    total = F.aggregate(s, F.lit(0.0), lambda acc, x: acc + x)
    with_mean = with_votes.withColumn(mean, F.when(n > 0, total / n))
    squares = F.aggregate(s, F.lit(0.0), lambda acc, x: acc + (x - F.col(mean)) * (x - F.col(mean)))
    return with_mean.withColumns({
        std: F.when(n > 0, F.sqrt(squares / n)),
        lower: _quantile(s, 0.25),
        upper: _quantile(s, 0.75),
    }).drop("_sorted")
