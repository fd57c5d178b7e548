"""Carries, as-of lookups and numbering along orders that are too long for one task.

The windows of the other ordered operators hold a whole series (or, without a key, the whole frame) in one task. That is right
on a calendar, and wrong for ticks. Here the rows are dealt by ranges of series and time into segments and written once
with their place. Windows stop at the end of a segment; a summary with one row per series and segment says what the earlier ones
leave for it. Only a series that began in an earlier segment gets any of that, and a segment has one such series at most, so
what joins back has no more rows than there are segments, however many series there are.

Rows that agree in all of ``by`` and ``order`` stay in one segment, in any order: name a key last to tell them apart. Missing
keys are a series and missing times come first. Columns called ``_at``, ``_segment`` or ``_in...`` are reserved.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid.session import stored

#: Rows of a segment, which one task sorts.
SEGMENT_ROWS = 5_000_000
#: Segments whose summary is broadcast if its columns have a fixed width (some 16 MB); beyond, Spark picks the join.
BROADCAST_SEGMENTS = 100_000
#: Fixed value: bits that ``monotonically_increasing_id`` gives the place in a partition.
_PLACE_BITS = 33


def cut(df: DataFrame, keys: Sequence[str], segment_rows: int | None = None) -> tuple[DataFrame, int]:
    """``df`` stored in the order of ``keys`` with ``_at`` (increasing in that order) and ``_segment``, and a bound of the segments.

    Reads ``df`` three times (rows, range bounds, rows to deal); write an expensive one first. Places are read from the
    written table, so a task that runs again cannot see other ones.
    """
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    segments = max(least, -(-df.count() // (segment_rows or SEGMENT_ROWS)))
    dealt = df.repartitionByRange(segments, *keys).sortWithinPartitions(*keys)
    placed = stored(dealt.withColumn("_at", F.monotonically_increasing_id()))
    return placed.withColumn("_segment", F.shiftright("_at", _PLACE_BITS)), segments


def _entering(summary: DataFrame, by: Sequence[str], columns: Sequence[str], *, total: bool, backward: bool = False) -> DataFrame:
    """For each segment that continues a series: the sum, or else the nearest known value, of ``columns`` in its earlier segments
    (later ones if ``backward``). ``summary`` has a row per series and segment."""
    if by:
        # A row per segment the series touches, so at most as many as there are segments.
        order = F.col("_segment").desc() if backward else F.col("_segment").asc()
        before = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        rows = summary.withColumns(
            {c: (F.sum(c) if total else F.last(c, ignorenulls=True)).over(before) for c in columns}
            | {"_in_rows": F.count("*").over(before)})
        return rows.where("_in_rows > 0").drop("_in_rows")
    # Without a series key the summary has a row per segment.
    left: dict = {c: 0 if total else None for c in columns}
    out = []
    for row in sorted(summary.collect(), key=lambda r: r["_segment"], reverse=backward):
        out.append((row["_segment"], *[left[c] for c in columns]))
        for c in columns:
            left[c] = left[c] + row[c] if total else left[c] if row[c] is None else row[c]
    schema = T.StructType([T.StructField("_segment", T.LongType()), *[summary.schema[c] for c in columns]])
    return summary.sparkSession.createDataFrame(out, schema)


def _attach(frame: DataFrame, entering: DataFrame, by: Sequence[str], segments: int) -> DataFrame:
    """The rows with what enters their segment; missing where nothing does."""
    keys = [*by, "_segment"]
    renamed = entering.withColumnsRenamed({c: f"_in_{c}" for c in keys})
    varying = (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType, T.VariantType)
    fixed = not any(isinstance(f.dataType, varying) for f in renamed.schema)
    if fixed and segments <= BROADCAST_SEGMENTS:
        renamed = F.broadcast(renamed)
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_in_{c}")) for c in keys])
    return frame.join(renamed, same, "left").drop(*[f"_in_{c}" for c in keys])


def carry(
    df: DataFrame,
    columns: Sequence[str],
    *,
    by: Sequence[str] = (),
    order: Sequence[str],
    back: bool = False,
    segment_rows: int | None = None,
) -> DataFrame:
    """Carry the last known value of each column forward within each series, of any length.

    With ``back``, what is left at the start of a series is filled from its first known value.
    """
    frame, segments = cut(df, [*by, *order], segment_rows)
    out = frame
    series = Window.partitionBy(*by, "_segment")
    ahead, behind = (series.orderBy(o).rowsBetween(Window.unboundedPreceding, 0) for o in (F.col("_at").asc(), F.col("_at").desc()))
    local = {c: F.last(c, ignorenulls=True).over(ahead) for c in columns}
    if back:
        # A frame that reaches to the end of a segment would be walked anew for each row; the reverse order is walked once.
        local |= {f"_in_next{i}": F.last(c, ignorenulls=True).over(behind) for i, c in enumerate(columns)}
    out = out.withColumns(local)
    for backward in (False, True) if back else (False,):
        nearest = F.min_by if backward else F.max_by
        inputs = [f"_in{'b' if backward else 'f'}{i}" for i in range(len(columns))]
        summary = frame.groupBy(*by, "_segment").agg(
            *[nearest(F.col(c), F.when(F.col(c).isNotNull(), F.col("_at"))).alias(i) for c, i in zip(columns, inputs)])
        out = _attach(out, _entering(summary, by, inputs, total=False, backward=backward), by, segments)
    sources = {c: [c, f"_inf{i}", *([f"_in_next{i}", f"_inb{i}"] if back else [])] for i, c in enumerate(columns)}
    return out.withColumns({c: F.coalesce(*s) for c, s in sources.items()}).select(*df.columns)


def asof(
    rows: DataFrame,
    known: DataFrame,
    *,
    by: Sequence[str] = (),
    time: str,
    value: str,
    tie_break: str | None = None,
    out: str = "carried",
    out_time: str = "carried_from",
    segment_rows: int | None = None,
) -> DataFrame:
    """Give each row the latest non-missing ``value`` of ``known`` at or before its time, and that value's time.

    Of several at one time the one with the largest ``tie_break`` counts, a column of ``known``. Both frames are stacked and
    dealt once; no range join, and neither side has to fit a task.
    """
    keys = [*by, time, "_in_row", "_in_key"]
    left = rows.withColumns({"_in_row": F.lit(True), out: F.lit(None), out_time: F.lit(None)})
    right = known.where(F.col(value).isNotNull()).select(
        *by, time, F.lit(False).alias("_in_row"), (F.col(tie_break) if tie_break else F.lit(None)).alias("_in_key"),
        F.col(value).alias(out), F.col(time).alias(out_time))
    kinds = {f.name: f.dataType for f in right.schema}
    left = left.withColumns({c: F.lit(None).cast(kinds[c]) for c in (out, out_time, "_in_key")})
    stacked = left.unionByName(right, allowMissingColumns=True)
    carried = carry(stacked, [out, out_time], by=by, order=keys[len(by):], segment_rows=segment_rows)
    return carried.where("_in_row").select(*rows.columns, out, out_time)


def row_index(
    df: DataFrame,
    *,
    by: Sequence[str] = (),
    order: Sequence[str],
    out: str = "row_idx",
    segment_rows: int | None = None,
) -> DataFrame:
    """0-based position of each row in the order of its series, or of the whole frame."""
    frame, segments = cut(df, [*by, *order], segment_rows)
    counts = frame.groupBy(*by, "_segment").agg(F.count("*").alias("_in_before"))
    if by:
        here = F.row_number().over(Window.partitionBy(*by, "_segment").orderBy("_at")) - 1
    else:
        here = F.col("_at") - F.shiftleft("_segment", _PLACE_BITS)
    placed = _attach(frame.withColumn("_in_here", here), _entering(counts, by, ["_in_before"], total=True), by, segments)
    index = F.col("_in_here") + F.coalesce("_in_before", F.lit(0))
    return placed.withColumn(out, index.cast("bigint")).select(*[c for c in df.columns if c != out], out)
