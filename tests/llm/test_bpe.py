"""Chunked encoding against the tokenizer library, and exact round trips."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tidegrid.llm import bpe
from tidegrid.llm.tokens import PATTERN, cut_places, load_ranks

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TEXTS = [
    "", None, "one", "it's  we're 'x 're''ll \n\n\t tab\r\n end  ", "a" * 300, " " * 200 + "x", "1234567890" * 30,
    "naïve Ünïcode 日本語テキスト 🙂🙂   x ", "don't stop, they'll've " * 40, "....!!!! ??? " * 50,
    "word " * 100 + "b" * 90 + " tail's end" * 20, "same row", "same row",
    "ab\n\ncd \t\nx\u2003 \u2003y'" * 40, "\n\n\n\nZ" * 60, "x '" + "s" * 40 + "'t" * 60,
]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("check", pat_str=PATTERN, mergeable_ranks=load_ranks(PATH), special_tokens={})


@pytest.mark.parametrize("chunk,overlap", [(40, 10), (41, 7), (64, 33), (10_000, 512)])
def test_equals_library_and_round_trips(spark, library, chunk, overlap):
    rows = [(i if i % 5 else None, t, "x") for i, t in enumerate(TEXTS)] + [(11, TEXTS[10], "y")] * 2
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    out = bpe.encode(df, PATH, chunk_chars=chunk, overlap_chars=overlap)
    got = out.select("doc_id", "ids", bpe.decode("ids", PATH).alias("raw"))
    seen = sorted((r.doc_id is None, r.doc_id or 0, np.frombuffer(r.ids, "<u4").tolist(), bytes(r.raw))
                  for r in got.collect())
    want = sorted((i is None, i or 0, library.encode_ordinary(t or ""), (t or "").encode()) for i, t, _ in rows)
    assert seen == want


def test_empty_table_and_bad_overlap(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert bpe.encode(df, PATH).collect() == []
    with pytest.raises(ValueError):
        bpe.encode(df, PATH, chunk_chars=10, overlap_chars=11)


def test_texts_cut_at_places_encode_like_the_whole(library):
    rng = random.Random(5)
    parts = ["'s", "'", "re", " ", "  ", "\n", "\t", "\u2003", "\x1c", "\x85", "a", "É1", "!?", "日本"]
    for _ in range(3000):
        text = "".join(rng.choices(parts, k=rng.randrange(1, 25)))
        places = [*cut_places(text), len(text)]
        assert places[0] == 0
        ids = [i for a, b in zip(places, places[1:]) for i in library.encode_ordinary(text[a:b])]
        assert ids == library.encode_ordinary(text)
