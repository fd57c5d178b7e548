"""Working through a task's rows in slices of bounded text."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.session import stored

#: Characters that one step of a task works on (a longer text is a step of its own).
STEP_CHARS = 1_000_000


def steps(batches: Iterable[pd.DataFrame], chars: int = STEP_CHARS) -> Iterator[pd.DataFrame]:
    """Consecutive slices of the batches with about ``chars`` characters in the column ``text``, one row at least."""
    for rows in batches:
        if len(rows):
            before = np.cumsum([0, *map(len, rows["text"])])[:-1]
            for cut in np.split(np.arange(len(rows)), np.flatnonzero(np.diff(before // chars)) + 1):
                yield rows.iloc[cut[0]:cut[-1] + 1]


def id_and_text(df: DataFrame, id_col: str, text_col: str, **others: Column) -> DataFrame:
    """``(id string, text, ...)``: the id as text, because pandas turns whole numbers with gaps into inexact ones."""
    return df.select(F.col(id_col).cast("string").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                     *[c.alias(name) for name, c in others.items()])


def with_id(out: DataFrame, like: DataFrame, id_col: str) -> DataFrame:
    """``out`` with its text ``id`` under the name and type that ``id_col`` has in ``like``."""
    rest = [c for c in out.columns if c != "id"]
    return out.select(F.col("id").cast(like.schema[id_col].dataType).alias(id_col), *rest)


#: Rows, and bytes as written, up to which a table with one row per language or the like is sent to every task.
SMALL_ROWS, SMALL_BYTES = 10_000, 4_000_000


def small_side(df: DataFrame) -> DataFrame:
    """``df`` written out, and marked for a broadcast join if it has at most ``SMALL_ROWS`` rows in ``SMALL_BYTES`` bytes."""
    kept = stored(df)
    spark, files = df.sparkSession, kept.inputFiles()
    if not files:
        return F.broadcast(kept)
    folder = spark._jvm.org.apache.hadoop.fs.Path(files[0].rpartition("/")[0])
    size = folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()
    return F.broadcast(kept) if size <= SMALL_BYTES and kept.count() <= SMALL_ROWS else kept


def runs(batches: Iterable[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """The rows of each key, from batches in which equal keys stand together."""
    waiting: list[pd.DataFrame] = []
    for rows in batches:
        if not len(rows):
            continue
        number = (rows[keys] != rows[keys].shift()).any(axis=1).cumsum().to_numpy()
        starts = [0, *(np.flatnonzero(np.diff(number)) + 1), len(rows)]
        for a, b in zip(starts, starts[1:]):
            part = rows.iloc[a:b]
            if waiting and not (waiting[-1][keys].iloc[-1] == part[keys].iloc[0]).all():
                yield pd.concat(waiting, ignore_index=True)
                waiting = []
            waiting.append(part)
    if waiting:
        yield pd.concat(waiting, ignore_index=True)
