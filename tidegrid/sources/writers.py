"""Sinks. Each writes one version partition, so a repeated run replaces its own output only."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.sources.versions import VERSION, stamp_version


def overwrite_version(df: DataFrame, path: str, run_date: date, fmt: str = "csv") -> None:
    """Replace the version partition of ``run_date`` and leave the other versions alone."""
    (stamp_version(df, run_date).write.mode("overwrite").option("header", True)
     .option("partitionOverwriteMode", "dynamic").partitionBy(VERSION).format(fmt).save(path))


def append_rows(df: DataFrame, path: str, run_date: date, fmt: str = "csv") -> None:
    """Add rows to the version partition of ``run_date``."""
    (stamp_version(df, run_date).write.mode("append").option("header", True)
     .partitionBy(VERSION).format(fmt).save(path))


def _keyed(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, Column]:
    """The keys of ``df`` under other names, and the condition that a row has one of them; missing keys are equal."""
    names = [f"_key{i}" for i in range(len(keys))]
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)))
    return df.select(*[F.col(k).alias(n) for k, n in zip(keys, names)]), same


def absent_rows(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One incoming row for each key that is not stored yet; missing keys are equal to each other.

    Of several rows with one new key, the least by ``order``, then by the other columns, counts: a delivery gives the same
    rows however it is dealt. The stored keys are first reduced to those that are delivered again. With a small delivery
    that semi join is a broadcast, so a large stored table is scanned for its key columns only and never shuffled.
    """
    rest = [c for c in incoming.columns if c not in keys]
    ranked = [*order, *[c for c in rest if c not in order]]
    first = F.min(F.struct(*ranked)) if ranked else F.count(F.lit(1))
    delivered = incoming.groupBy(*keys).agg(first.alias("_row"))
    again = existing.select(*keys).join(*_keyed(delivered, keys), "left_semi").distinct()
    fresh = delivered.join(*_keyed(again, keys), "left_anti")
    return fresh.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in incoming.columns])


def append_if_absent(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Stored rows plus one incoming row for each new key: the first write of a key wins and
    revisions are ignored."""
    return existing.unionByName(absent_rows(existing, incoming, keys, order))


def write_lines(lines: DataFrame, path: str, *, order: str = "line_no", text: str = "line") -> None:
    """Write report lines as one ordered text file."""
    lines.orderBy(order).coalesce(1).select(text).write.mode("overwrite").text(path)
