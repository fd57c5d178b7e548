"""Top-k lists per target and their wide record form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def topk(
    df: DataFrame, k: int = 5, *, by: Sequence[str], feature: str = "feature", importance: str = "importance",
    out: str = "rank",
) -> DataFrame:
    """The k most important features of each target; ties go to the smaller name.

    The rank filter is pushed below the shuffle by Spark, so each task ships at most k rows per
    target.
    """
    w = Window.partitionBy(*by).orderBy(F.col(importance).desc(), F.col(feature))
    return df.withColumn(out, F.row_number().over(w)).where(F.col(out) <= k)


def topk_record(
    ranked: DataFrame, k: int = 5, *, by: Sequence[str], feature: str = "feature", importance: str = "importance",
    rank: str = "rank", pattern: str = "top{i}_{what}",
) -> DataFrame:
    """One row per target with the columns ``top1_feature, top1_importance, ...``."""
    cells = [F.max(F.when(F.col(rank) == i, F.col(what))).alias(pattern.format(i=i, what=what))
             for i in range(1, k + 1) for what in (feature, importance)]
    return ranked.groupBy(*by).agg(*cells)


def unpivot_topk(
    record: DataFrame, k: int = 5, *, by: Sequence[str], feature: str = "feature", importance: str = "importance",
    pattern: str = "top{i}_{what}",
) -> DataFrame:
    """Back from the wide record to ``(rank, feature, importance)`` rows; empty slots are left out.

    ``feature`` and ``importance`` are the words in the record's column names.
    """
    slots = F.array(*[
        F.struct(F.lit(i).alias("rank"),
                 F.col(pattern.format(i=i, what=feature)).alias("feature"),
                 F.col(pattern.format(i=i, what=importance)).alias("importance"))
        for i in range(1, k + 1)
    ])
    return record.select(*by, F.inline(slots)).where(F.col("feature").isNotNull())
