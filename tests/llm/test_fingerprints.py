"""Fingerprints: edited texts by plain Python, collision rate against the exact similarity, defined edge cases."""

from __future__ import annotations

import hashlib
import math
import random
import re
import struct
from collections import Counter
from pathlib import Path

import pytest
import xxhash
from pyspark.sql import functions as F

from tidegrid.llm import fingerprints
from tidegrid.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def jaccard(a, b):
    x, y = Counter(words(a)), Counter(words(b))
    return sum((x & y).values()) / max(1, sum((x | y).values())) if x or y else 1.0


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def edit(text, following):
    cut = len(text) // 4
    return text[:len(text) - cut] + following[:cut]


def plain_signature(text, samples):
    """Per sample the least of c / (y e^r) over the weighted words, in logarithms; seeds are Spark's hashes."""

    def draws(word, k):
        for part in (3 * k, 3 * k + 1, 3 * k + 2):
            bits = xxhash.xxh64_intdigest(struct.pack("<i", part), xxhash.xxh64_intdigest(word, 42))
            yield from ((half + 0.5) / 2**32 for half in (bits >> 32, bits & 0xFFFFFFFF))

    def value(word, weight, k):
        u1, u2, u3, u4, b, _ = draws(word, k)
        r, c = -math.log(u1 * u2), -math.log(u3 * u4)
        t = math.floor(math.log(weight) / r + b)
        return math.log(c) - r * (t - b) - r

    weights = Counter(xxhash.xxh64_digest(w.encode(), 42)[::-1] for w in words(text))
    return [min((value(w, n, k) for w, n in weights.items()), default=None) for k in range(samples)]


def test_signatures_equal_a_plain_sampler(spark):
    texts = ["", None, "a", "b a b\x0bc\tb", "é\xa0é é\xa0é " * 50, "x " * 3000 + "y"]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    for r in fingerprints.signatures(df, ["k"]).collect():
        want = plain_signature(texts[r.k] or "", fingerprints.SAMPLES)
        assert want == [None] * fingerprints.SAMPLES and r.signature == want or r.signature == pytest.approx(want, rel=1e-9)


@pytest.mark.skipif(not Path(SMALL).exists(), reason="benchmark tables are not here")
def test_registered_query_equals_a_plain_sampler(spark):
    """Every likeness of the query over its whole table, by samplers in plain Python."""
    docs = sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect())
    found = {r.doc_id: r for r in QUERIES["op10_fingerprints"](spark, SMALL).collect()}
    n = fingerprints.SAMPLES
    plain = [plain_signature(text, n) for _, text in docs]

    def alike(a, b):
        return sum(x == y for x, y in zip(a, b)) / n

    assert len(docs) == len(found)
    for i, (doc_id, text) in enumerate(docs):
        j = (i + 1) % len(docs)
        edited = plain_signature(edit(text, docs[j][1]), n)
        got = found[doc_id]
        assert (got.near_edited, got.near_next) == (alike(plain[i], edited), alike(plain[i], plain[j]))


def test_terms(spark):
    texts = ["", " \n", "a", "b a b\x0bc\tb", "é\xa0é é\xa0é"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = df.select(F.expr(fingerprints._TERMS.format(text="text")).alias("t")).collect()
    assert [sorted(x.times for x in r.t) for r in got] == [sorted(Counter(words(t)).values()) for t in texts]


def test_collision_rate_is_the_similarity(spark):
    rng = random.Random(6)
    base = rng.choices([f"w{i}" for i in range(60)], k=300)
    rows = [(i, " ".join(base[:300 - 40 * i] + rng.choices([f"w{i}" for i in range(90)], k=40 * i))) for i in range(6)]
    df = spark.createDataFrame(rows, "k int, text string")
    sig = {r.k: r.signature for r in fingerprints.signatures(df, ["k"], samples=600).collect()}
    for i in range(1, 6):
        same = sum(a == b for a, b in zip(sig[0], sig[i])) / 600
        assert same == pytest.approx(jaccard(rows[0][1], rows[i][1]), abs=0.07)


def test_edited_fingerprints(spark):
    rng = random.Random(2)
    texts = [" ".join(rng.choices(["ab", "cé", "日本", "x", "yy zz\n"], k=rng.randrange(1, 200))) for _ in range(30)]
    texts += ["", None, "one", texts[3], "  "]
    rows = [(10 * i, t, "z") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows + rows[5:6], "doc_id bigint, text string, hash string").repartition(5)
    got = {}
    for r in fingerprints.edited_fingerprints(df).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert {k: len(v) for k, v in got.items()} == {10 * i: 1 + (i == 5) for i in range(len(texts))}
    plain = [t or "" for t in texts]
    for i, t in enumerate(plain):
        r, following = got[10 * i][0], plain[(i + 1) % len(plain)]
        assert r.n_chars == len(t) and got[10 * i][-1] == r
        assert r.edited_sha256 == hashlib.sha256(edit(t, following).encode()).hexdigest()
        assert 0 <= r.near_edited <= 1 and r.near_next == sum(
            r.fingerprint[8 * k:8 * k + 8] == got[10 * ((i + 1) % len(plain))][0].fingerprint[8 * k:8 * k + 8]
            for k in range(fingerprints.SAMPLES)) / fingerprints.SAMPLES
        assert abs(r.near_edited - jaccard(t, edit(t, following))) < 0.4
    assert got[30][0].fingerprint == got[330][0].fingerprint  # equal texts
    assert got[300][0].near_next == 1.0  # two empty ones


def test_edges(spark):
    schema = "doc_id bigint, text string"
    assert fingerprints.edited_fingerprints(spark.createDataFrame([], schema)).collect() == []
    one = fingerprints.edited_fingerprints(spark.createDataFrame([(1, "abcd efgh")], schema)).collect()[0]
    assert one.near_next == 1.0 and one.edited_sha256 == hashlib.sha256(b"abcd efab").hexdigest()
    rows = [(None, "first of all words"), (5, "b c d e"), (5, "f g h i"), (None, None)]
    out = fingerprints.edited_fingerprints(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.doc_id or 0, r.n_chars) for r in out) == [(0, 0), (0, 18), (5, 7), (5, 7)]
    long = fingerprints.edited_fingerprints(spark.createDataFrame([(1, "word " * 200_000), (2, "x")], schema)).collect()
    assert {r.n_chars for r in long} == {1_000_000, 1}


def test_plan_has_no_python(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    plan = fingerprints.edited_fingerprints(df)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
