"""The registered queries over whole small tables against plain versions of what they return."""

from __future__ import annotations

import hashlib
import html
import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from test_quality import brute_counts
from test_secrets import brute as brute_spans
from tokenizers import Tokenizer

import __spark_entry__ as entry_points
from tidegrid.llm import queries
from tidegrid.llm.tokens import PATTERN, load_ranks

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SMALL).exists(), reason="benchmark tables are not here")


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").collect()
    return {r.doc_id: r for r in rows}


def text_of(row):
    return row.text or ""


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def test_all_are_registered():
    names = entry_points.queries()
    assert set(queries.QUERIES) <= set(names) and "pipeline" in names
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13
    assert set(queries.ORACLES) <= set(queries.QUERIES)


def test_op1(spark, docs):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    library = tiktoken.Encoding("check", pat_str=PATTERN, mergeable_ranks=load_ranks(path), special_tokens={})
    got = {r.doc_id: tuple(r)[1:] for r in queries.op1_bpe(spark, SMALL).collect()}
    ids = {i: library.encode_ordinary(text_of(r)) for i, r in docs.items()}
    assert got == {i: (len(x), sha(np.array(x, "<u4").tobytes()), sha(text_of(docs[i]).encode())) for i, x in ids.items()}


def test_op2(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    got = {r.page_id: r for r in queries.op2_extract(spark, SMALL).collect()}
    assert set(got) == set(pages)
    for i, page in pages.items():
        article = re.search(r"<article>(.*?)</article>", page.html, re.DOTALL)[1]
        parts = (re.sub(r"\s+", " ", html.unescape(re.sub("<[^>]*>", "", x))).strip()
                 for x in re.split("</?(?:p|h1)>", article.replace("<br>", " ")))
        want = "\n".join(x for x in parts if x)
        assert (got[i].text, got[i].n_chars, got[i].url) == (want, len(want), page.url)


def test_op3(spark, docs):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: np.array([*tokenizer.encode(text_of(r), add_special_tokens=False).ids, 1], "<u4") for i, r in docs.items()}
    got = queries.op3_packing(spark, SMALL).toPandas()
    for doc, pieces in got.sort_values("start").groupby("doc_id"):
        assert (pieces["doc_tokens"] == len(ids[doc])).all()
        assert list(pieces["start"]) == list(np.cumsum([0, *pieces["length"]])[:-1])
        assert pieces["length"].sum() == len(ids[doc])
        for r in pieces.itertuples():
            assert r.ids_crc32 == zlib.crc32(ids[doc][r.start:r.start + r.length].tobytes())
    assert set(got["doc_id"]) == set(docs)
    sums = []
    for _, pieces in got.sort_values("offset").groupby("sequence_id"):
        assert list(pieces["offset"]) == list(np.cumsum([0, *pieces["length"]])[:-1])
        sums.append(int(pieces["length"].sum()))
    padding = sum(0 if n & (n - 1) == 0 else 2048 - n for n in sums)
    assert max(sums) <= 2048 and padding <= 0.02 * sum(sums)


def test_op7(spark, docs):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    library = tiktoken.Encoding("check", pat_str=PATTERN, mergeable_ranks=load_ranks(path), special_tokens={})
    got = {r.doc_id: r for r in queries.op7_recount(spark, SMALL).collect()}
    for i, row in docs.items():
        text = old = text_of(row)
        n = len(old)
        text = text[:n // 4] + text[n // 4 + 20:]
        text = text[:n // 2] + old[:40] + text[n // 2:]
        text = text[:n] + "'re done.\n" + text[n + 40:]
        assert (got[i].n_tokens_before, got[i].n_tokens) == (len(library.encode_ordinary(old)), len(library.encode_ordinary(text)))
        assert got[i].text_sha256 == sha(text.encode()) and got[i].n_chars == len(text)
    assert sum(r.encoded_chars for r in got.values()) < sum(r.n_chars for r in got.values())


def test_op8(spark, docs):
    got = {r.doc_id: r for r in queries.op8_secrets(spark, SMALL).collect()}
    for i, row in docs.items():
        spans = brute_spans(text_of(row))
        listed = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in spans)
        kinds = Counter(k for _, k, _ in spans)
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex) == (kinds[0], kinds[1], kinds[2])
        assert got[i].base_sha256 == sha(listed.encode())
        assert set(filter(None, listed.split(","))) <= set(got[i].spans.split(","))


def test_op9(spark, docs):
    got = {r.doc_id: r for r in queries.op9_quality(spark, SMALL).collect()}
    assert set(got) == set(docs)
    for i, row in docs.items():
        counts = brute_counts(text_of(row))
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts
        assert r.base_failed == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0]) and not (r.base_failed and r.kept)


def test_op10(spark, docs):
    got = {r.doc_id: r for r in queries.op10_fingerprints(spark, SMALL).collect()}
    order = sorted(docs)
    by_text = {}
    for i, following in zip(order, [*order[1:], order[0]]):
        text, other = text_of(docs[i]), text_of(docs[following])
        cut = len(text) // 4
        assert got[i].edited_sha256 == sha((text[:len(text) - cut] + other[:cut]).encode()) and got[i].n_chars == len(text)
        assert by_text.setdefault(text, got[i].fingerprint) == got[i].fingerprint
        if text == other:
            assert got[i].near_next == 1
