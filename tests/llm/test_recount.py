"""Counts under edits against encoding every edited text whole."""

from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest

from tidegrid.llm import recount
from tidegrid.llm.tokens import encoder

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PARTS = ["\u2003\n", "\x1c", "\n\n\n", "漢字", "'s", "'r", "e", "'", " ", "  ", "\n", "abc", "Éa", "12", "½", "!?", "日本", "word ", " it's", "x" * 30, " "]


def some_text(rng, n):
    return "".join(rng.choices(PARTS, k=n))


@pytest.mark.parametrize("leaf", [2, 9, 192])
def test_edited_trees_equal_whole_encoding(monkeypatch, leaf):
    monkeypatch.setattr(recount, "LEAF_CHARS", leaf)
    encode, rng, work, size = encoder(PATH), random.Random(leaf), 0, 0
    for _ in range(60):
        text = some_text(rng, rng.choice([0, 1, 5, 300]))
        tree = recount.CountTree.of(text, encode)
        for _ in range(12):
            start = rng.randrange(len(text) + 1)
            stop = min(len(text), start + rng.choice([0, 0, 1, 5, 40, 10**6 * (rng.random() < 0.05)]))
            text, done = tree.edit(text, start, stop, some_text(rng, rng.choice([0, 1, 3, 200])), encode)
            work, size = work + done, size + len(text)
            assert (tree.n_tokens, tree.n_chars) == (len(encode(text)), len(text))
            assert tree.n_tokens == sum(tree.tokens[tree.width:]) and tree.n_chars == sum(tree.chars[tree.width:])
    assert work < size or leaf == 192


def test_small_edits_of_a_long_text_encode_little():
    encode, text = encoder(PATH), "some words and 12 numbers. " * 4000
    tree = recount.CountTree.of(text, encode)
    for at in (0, 50_000, len(text)):
        text, done = tree.edit(text, at, at, "new", encode)
        assert done < 1500 and tree.n_tokens == len(encode(text))


def applied(text, edits):
    for _, start, stop, new in sorted(edits, key=lambda e: e[0]):
        start = min(max(0, start or 0), len(text))
        stop = min(max(start, stop or 0), len(text))
        text = text[:start] + (new or "") + text[stop:]
    return text


def test_frame(spark):
    rng, encode = random.Random(3), encoder(PATH)
    docs = [(i, some_text(rng, rng.randrange(200)), 0) for i in range(40)]
    docs += [(40, None, 0), (41, "", 0), (None, "no id", 0), (None, "no id", 0), (5, docs[5][1], 0), (6, "another six", 0),
             (2**60 + 1, "big id", 0), (42, "w " * 100_000, 0)]
    edits = [(rng.randrange(44), s, rng.randrange(-3, 250), rng.randrange(-3, 250), rng.choice(["", None, "x", " it's "]))
             for s in range(150)] + [(None, 0, 0, 3, "no"), (2**60 + 1, 1, 0, 3, "BIG"), (3, 900, None, None, "front")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, n_tokens int")
    log = spark.createDataFrame(edits, "doc_id bigint, seq int, start int, stop int, replacement string")
    want = []
    for doc, text, _ in docs:
        after = applied(text or "", [e[1:] for e in edits if doc is not None and e[0] == doc])
        want.append((doc is None, doc or 0, len(encode(text or "")), len(encode(after)), len(after),
                     hashlib.sha256(after.encode()).hexdigest()))
    got = [(r.doc_id is None, r.doc_id or 0, r.n_tokens_before, r.n_tokens, r.n_chars, r.text_sha256)
           for r in recount.recount(df, log, PATH).collect()]
    assert sorted(got) == sorted(want)
    assert recount.recount(df.limit(0), log, PATH).collect() == []
    assert recount.recount(df, log.limit(0), PATH).filter("n_tokens <> n_tokens_before or encoded_chars <> 0").collect() == []
