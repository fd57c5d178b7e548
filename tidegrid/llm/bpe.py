"""Byte-level BPE encoding of whole texts by overlapping chunks, and decoding.

Texts up to one chunk are encoded where they are read. Longer ones are cut into overlapping chunks that are
pre-tokenised in parallel. Where a pre-token begins at the same place in a chunk and in the overlap of the chunk
before, both scans agree from there on, so the text can be cut there; the pieces between such places are encoded in
parallel and their ids concatenated.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.llm.batches import id_and_text, steps, with_id
from tidegrid.llm.tokens import LOOK_AHEAD, cut_places, encoder, token_bytes

CHUNK_CHARS, OVERLAP_CHARS = 32_768, 512


def _cut(chunk: int, overlap: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for row_id, digest, copies, text in zip(rows["id"], rows["digest"], rows["copies"], rows["text"]):
                starts = range(0, len(text), chunk)
                for first in range(0, len(starts), 64):  # a very long text leaves in several batches
                    part = starts[first:first + 64]
                    yield pd.DataFrame({
                        "id": [row_id] * len(part), "digest": digest, "copies": copies,
                        "no": np.arange(first, first + len(part)), "length": len(text),
                        "text": [text[s:s + chunk + overlap] for s in part]})

    return run


def _scan(chunk: int, overlap: int):
    """Adds the places to cut in the chunk's first ``overlap`` characters and in those after its end."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            heads, tails = [], []
            for no, length, text in zip(rows["no"], rows["length"], rows["text"]):
                begin = no * chunk
                settled = len(text) if begin + len(text) == length else len(text) - LOOK_AHEAD
                starts = np.array(list(cut_places(text))[1:], dtype=np.int64)  # the chunk's own start proves nothing
                heads.append(starts[starts < overlap] + begin)
                tails.append(starts[(starts >= chunk) & (starts <= settled)] + begin)
            yield rows.assign(head=heads, tail=tails)

    return run


def _encode(path: str, keys: list[str]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids = encoder(path)
        for rows in steps(batches):
            yield rows[keys].assign(ids=[ids(t).tobytes() for t in rows["text"]])

    return run


def encode(df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
           chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS) -> DataFrame:
    """``(id_col, ids)``, one row per input row, in no fixed order; ``ids`` is binary, four bytes per id, lowest first.

    ``vocabulary`` is the path of a rank file that every executor can open. Other columns are not read, so their
    names cannot clash. A missing text counts as empty and has no ids. Ids may be missing or repeated: long texts
    are keyed by id and content digest, equal rows are encoded once and repeated. A seam inside a pre-token longer
    than the overlap joins its chunk and all later ones of that text into one piece, which is still exact.
    """
    if not LOOK_AHEAD < overlap_chars <= chunk_chars:
        raise ValueError("the overlap must exceed the look-ahead and fit into a chunk")
    rows = id_and_text(df, id_col, text_col)
    short = rows.filter(F.length("text") <= chunk_chars).mapInPandas(
        _encode(vocabulary, ["id"]), "id string, ids binary")

    long = (rows.filter(F.length("text") > chunk_chars).withColumn("digest", F.sha2("text", 256))
            .groupBy("id", "digest").agg(F.count(F.lit(1)).alias("copies"), F.first("text").alias("text")))
    chunk_schema = "id string, digest string, copies bigint, no bigint, length bigint, text string"
    chunks = long.mapInPandas(_cut(chunk_chars, overlap_chars), chunk_schema).repartition("id", "digest", "no")
    scanned = chunks.mapInPandas(_scan(chunk_chars, overlap_chars),
                                 chunk_schema + ", head array<bigint>, tail array<bigint>")
    by_text = Window.partitionBy("id", "digest").orderBy("no")
    so_far = by_text.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    begin = F.col("no") * chunk_chars
    pieces = (
        scanned
        .withColumn("seam", F.when(F.col("no") == 0, F.lit(0).cast("bigint"))
                    .otherwise(F.array_min(F.array_intersect(F.lag("tail").over(by_text), "head"))))
        .withColumn("sound", F.min(F.col("seam").isNotNull()).over(so_far))
        .withColumn("piece", F.max(F.when(F.col("sound"), F.col("no"))).over(so_far))
        .withColumn("start", F.when(F.col("sound"), F.col("seam")).otherwise(begin))
        .withColumn("stop", F.when(F.lead("sound").over(by_text), F.lead("seam").over(by_text))
                    .otherwise(F.least(begin + chunk_chars, F.col("length"))))
        .withColumn("text", F.expr(f"substring(text, cast(start - no * {chunk_chars} + 1 as int), "
                                   "cast(stop - start as int))"))
        .groupBy("id", "digest", "copies", "piece")
        .agg(F.array_sort(F.collect_list(F.struct("no", "text"))).alias("parts"))
        .select("id", "digest", "copies", "piece", F.array_join(F.col("parts.text"), "").alias("text")))
    encoded = pieces.repartition("id", "digest", "piece").mapInPandas(
        _encode(vocabulary, ["id", "digest", "copies", "piece"]),
        "id string, digest string, copies bigint, piece bigint, ids binary")
    whole = (encoded.groupBy("id", "digest", "copies")
             .agg(F.array_sort(F.collect_list(F.struct("piece", "ids"))).alias("parts"))
             .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
             .select("id", F.expr("unhex(array_join(transform(parts.ids, x -> hex(x)), ''))").alias("ids")))
    return with_id(short.unionByName(whole), df, id_col)


def decode(ids: Column | str, vocabulary: str) -> Column:
    """The raw bytes of packed ids; missing ids give missing bytes."""

    @F.pandas_udf("binary")
    def run(column: pd.Series) -> pd.Series:
        table = token_bytes(vocabulary)
        return pd.Series([None if ids is None else b"".join([table[i] for i in np.frombuffer(ids, dtype="<u4").tolist()])
                          for ids in column], dtype=object)

    return run(ids)
