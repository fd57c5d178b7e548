"""Append-if-absent as a streaming sink.

A batch may be delivered again after a failure; because rows with a stored key are skipped, a
replayed batch changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from tidegrid.sources.versions import path_exists
from tidegrid.sources.writers import absent_rows


def append_if_absent_batch(
    path: str, keys: Sequence[str], fmt: str = "parquet", order: Sequence[str] = ()
) -> Callable[[DataFrame, int], None]:
    """Function for ``writeStream.foreachBatch`` that appends only rows with a new key.

    Keys delivered twice inside one batch are written once, the row that comes first by ``order`` and then by its other
    columns; missing keys are equal to each other.
    """

    def write(batch: DataFrame, _batch_id: int) -> None:
        reader = batch.sparkSession.read.schema(batch.schema).format(fmt)
        known = reader.load(path) if path_exists(batch.sparkSession, path) else batch.limit(0)
        absent_rows(known, batch, keys, order).write.mode("append").format(fmt).save(path)

    return write
