"""Packing: every id once, capacity, little padding, and differencing against plain rules."""

from __future__ import annotations

import random
from collections import defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidegrid.llm import packing
from tidegrid.llm.tokens import encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")
SMALL = "/root/testdata/sf0.01/documents.parquet"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def test_difference_keeps_items_and_balances():
    rng = random.Random(3)
    for n, k in [(0, 1), (1, 4), (7, 3), (400, 16)]:
        sizes = [rng.randrange(1, 500) for _ in range(n)]
        groups = packing.difference(sizes, k)
        assert len(groups) == k and sorted(i for g in groups for i in g) == list(range(n))
        if n == 400:
            sums = [sum(sizes[i] for i in g) for g in groups]
            assert max(sums) - min(sums) < 5


def test_window_count_rises_when_too_full():
    assert len(packing.even_windows([6, 6, 6], 10)) == 3
    assert packing.even_windows([], 10) == []


@pytest.mark.parametrize("total", [1, 3, 63, 64, 2047, 2048, 2049, 5000, 131_072, 140_000])
def test_batch_is_whole_and_tight(total):
    rng, pieces, left, row = random.Random(total), [], total, 0
    while left:
        n = min(left, rng.randrange(1, 257))
        pieces.append((row, 0, n))
        left, row = left - n, row + 1
    out = packing.pack_batch(pieces, 2048)
    cover = defaultdict(list)
    for sequence in out:
        assert 0 < sum(p[2] for p in sequence) <= 2048
        for r, s, n in sequence:
            cover[r] += range(s, s + n)
    assert {r: sorted(v) for r, v in cover.items()} == {r: list(range(n)) for r, _, n in pieces}
    sums = [sum(p[2] for p in s) for s in out]
    padding = sum(0 if n & (n - 1) == 0 else 2048 - n for n in sums)
    assert padding <= 0.02 * total + 0.3 * 2048


@pytest.mark.parametrize("path", [PATH, RANKS])
def test_frame(spark, path):
    rng = random.Random(1)
    texts = [None, "", "short", "x " * 30_000] + ["word " * rng.randrange(900) + "<|endoftext|>" for _ in range(300)]
    rows = [(i if i % 7 else None, t, 0) for i, t in enumerate(texts)] + [(9, texts[9], 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, length int").repartition(3)
    out = packing.pack(df, path, added=PATH).toPandas()
    tokenizer = Tokenizer.from_file(PATH)
    want = sorted([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for t in texts + [texts[9]])
    docs, open_docs = [], defaultdict(list)
    for r in out.sort_values(["doc_id", "doc_tokens", "start"]).itertuples():
        open_docs[(r.doc_id if r.doc_id == r.doc_id else None, r.doc_tokens, r.start)].append(r)
    for (doc, total, start), found in open_docs.items():
        if start == 0:
            for r in found:
                ids = list(np.frombuffer(r.ids, "<u4"))
                while len(ids) < total:
                    more = open_docs[(doc, total, len(ids))]
                    ids += list(np.frombuffer(more[0].ids, "<u4"))
                docs.append([int(i) for i in ids])
    assert sorted(docs) == want
    assert out["length"].sum() == sum(map(len, want))
    for _, sequence in out.sort_values("offset").groupby("sequence_id"):
        assert list(sequence["offset"]) == list(np.cumsum([0, *sequence["length"]])[:-1])
        assert sequence["length"].sum() <= 2048
    assert packing.pack(df.limit(0), path).collect() == []


def test_rank_file_gives_the_ids_of_the_tokenizer_file(spark):
    rng = random.Random(9)
    parts = ["'s", "'re", "'", " ", "  ", "\n", "\t\x0b", "abc", "É", "é\u0301", "日本", "🙂", "12", "½", "!?", "<|endoftext|>",
             "\xa0", "\u2003", "\x85", "\x1c", "the quick", "\u200d"]
    by_file, by_ranks = encoder(PATH), encoder(RANKS, PATH)
    assert by_ranks("a <|endoftext|> b").tolist() == [64, 220, 50256, 275]
    texts = ["".join(rng.choices(parts, k=rng.randrange(30))) for _ in range(3000)]
    if Path(SMALL).exists():
        texts += [r.text for r in spark.read.parquet(SMALL).select("text").collect()]
    for text in texts:
        assert by_file(text).tolist() == by_ranks(text).tolist()
