"""Packing of token streams into windows by multiway differencing.

Each task packs the documents it reads, batch by batch, without a shuffle. A document is cut into pieces; a piece as long
as a window is one. The others of a batch go through Karmarkar-Karp differencing: every piece starts as a partition of
its own into k windows, k - 1 of them empty, and the two partitions of largest imbalance are merged, the fullest window of
one with the emptiest of the other, until one partition is left. If one of its windows is too full, k rises by one.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.batches import id_and_text, with_id
from tidegrid.llm.tokens import encoder

#: Longest piece that is differenced, as a share of the window: short pieces make even windows.
PIECE_SHARE = 8
#: Windows of a batch, room left in each of them for its imbalance, and the grain of the part that needs no padding.
BATCH_WINDOWS, SLACK, GRAIN = 128, 8, 64
#: Pieces that a task hands on at once.
OUT_ROWS = 1000


def difference(sizes: list[int], k: int) -> list[list[int]]:
    """Items (by position in ``sizes``) of each of ``k`` windows of nearly equal sums."""
    heap = []
    for i, size in enumerate(sizes):
        sums = np.zeros(k, dtype=np.int64)
        sums[0] = size
        heap.append((-size, i, sums, [i] + [None] * (k - 1)))
    heapq.heapify(heap)
    serial = len(heap)
    while len(heap) > 1:
        _, _, sums, items = heapq.heappop(heap)
        spread, _, others, more = heap[0]
        merged = sums + others[::-1]
        joined = [b if a is None else a if b is None else (a, b) for a, b in zip(items, reversed(more))]
        order = np.argsort(-merged, kind="stable")
        merged = merged[order]
        heapq.heapreplace(heap, (int(merged[-1] - merged[0]), serial, merged, [joined[j] for j in order]))
        serial += 1
    return [_leaves(tree) for tree in heap[0][3]] if heap else [[] for _ in range(k)]


def _leaves(tree) -> list[int]:
    out, stack = [], [] if tree is None else [tree]
    while stack:
        node = stack.pop()
        if isinstance(node, tuple):
            stack += node
        else:
            out.append(node)
    return sorted(out)


def even_windows(sizes: list[int], window: int) -> list[list[int]]:
    """Differencing into as few windows as hold everything; the count rises while one is too full."""
    k = max(1, -(-sum(sizes) // window)) if sizes else 0
    while k:
        groups = difference(sizes, k)
        if max(sum(sizes[i] for i in g) for g in groups) <= window:
            return [g for g in groups if g]
        k += 1
    return []


def _take(pieces: list[tuple], amount: int) -> list[tuple]:
    """Remove ``amount`` tokens from the end of ``pieces``, cutting the last one reached."""
    taken = []
    while amount:
        row, start, length = pieces.pop()
        part = min(length, amount)
        if part < length:
            pieces.append((row, start, length - part))
        taken.append((row, start + length - part, part))
        amount -= part
    return taken[::-1]


def pack_batch(pieces: list[tuple], window: int, slack: int = SLACK) -> list[list[tuple]]:
    """Sequences of the ``(row, start, length)`` pieces of a batch, none longer than ``window``.

    What exceeds whole windows with some slack becomes sequences of a power of two, which need no padding; the rest
    fills nearly equal windows.
    """
    pieces, total = list(pieces), sum(p[2] for p in pieces)
    full = total // window
    spare = min(total, -(-(total - full * window + full * slack) // GRAIN) * GRAIN)
    if spare > window:  # the spare would fill a window of its own
        spare -= window * (spare // window)
    out, power = [], 1 << (window.bit_length() - 1)
    while spare:
        while power > spare:
            power //= 2
        out.append(_take(pieces, power))
        spare -= power
    sizes = [p[2] for p in pieces]
    return out + [[pieces[i] for i in group] for group in even_windows(sizes, window)]


def pack(df: DataFrame, vocabulary: str, end_id: int = 1, window: int = 2048, id_col: str = "doc_id",
         text_col: str = "text", added: str | None = None) -> DataFrame:
    """One row per piece: ``id_col, start, length, ids, doc_tokens, sequence_id, offset``.

    A document's ids are those of its whole text by the file ``vocabulary`` (and the tokens that the file ``added`` adds to it,
    see :func:`tidegrid.llm.tokens.encoder`), then ``end_id``; a missing text
    counts as empty and has that id alone. ``ids`` holds the piece's ids, four bytes each, lowest first. Every id lies in
    exactly one piece and no sequence exceeds ``window``. Sequence numbers are unique, not consecutive: task number, then
    number in the task. Missing and repeated document ids pack like any other row; other columns are not read.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(vocabulary, added)
        sequence = TaskContext.get().partitionId() << 33
        waiting: list[tuple] = []
        held: dict[int, tuple] = {}
        serial = waiting_tokens = 0

        out: dict[str, list] = {c: [] for c in ("id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")}

        def emit(sequences: list[list[tuple]]) -> None:
            nonlocal sequence
            for pieces in sequences:
                offset = 0
                for row, start, length in pieces:
                    doc, ids = held[row]
                    for values, value in zip(out.values(), (doc, start, length, ids[start:start + length].tobytes(), len(ids),
                                                            sequence, offset)):
                        values.append(value)
                    offset += length
                sequence += 1

        def emitted(least: int) -> Iterator[pd.DataFrame]:
            if len(out["id"]) >= least:
                yield pd.DataFrame(out)
                for values in out.values():
                    values.clear()

        for rows in batches:
            for doc, text in zip(rows["id"], rows["text"]):
                ids = np.append(encode(text), np.uint32(end_id))
                held[serial] = (doc, ids)
                whole = len(ids) // window * window
                if whole:
                    emit([[(serial, s, window)] for s in range(0, whole, window)])
                step = max(1, window // PIECE_SHARE)
                waiting += [(serial, s, min(step, len(ids) - s)) for s in range(whole, len(ids), step)]
                waiting_tokens += len(ids) - whole
                serial += 1
                if waiting_tokens >= BATCH_WINDOWS * window:
                    emit(pack_batch(waiting, window))
                    waiting, waiting_tokens = [], 0
                    held.clear()
                yield from emitted(OUT_ROWS)
        if waiting:
            emit(pack_batch(waiting, window))
        yield from emitted(1)

    rows = id_and_text(df, id_col, text_col)
    out = rows.mapInPandas(run, "id string, start bigint, length bigint, ids binary, doc_tokens bigint, "
                                "sequence_id bigint, offset bigint")
    return with_id(out, df, id_col)
