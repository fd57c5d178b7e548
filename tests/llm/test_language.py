"""Language mixtures: held-out accuracy, mixed texts, and the defined edge cases."""

from __future__ import annotations

import math
import random
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegrid.llm import language, queries

SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    if not Path(SMALL).exists():
        pytest.skip("benchmark tables are not here")
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def test_held_out_accuracy(spark, docs):
    found = queries.op6_language(spark, SMALL).join(docs.select("doc_id", "lang"), "doc_id")
    rows = found.filter("held_out and lang is not null").toPandas()
    assert len(rows) > 150 and (rows["lang"] == rows["lang_pred"]).mean() >= 0.97
    assert rows["score"].between(0, 1).all()


def test_mixture_names_both_languages(docs):
    model = language.fit(docs, F.lit(True))
    pick = {r.lang: r.text for r in docs.filter("length(text) between 2000 and 3000").groupBy("lang")
            .agg(F.max("text").alias("text")).collect()}
    shares, _ = language.mixtures([pick["de"] + " " + pick["es"], pick["fr"]], model)
    assert {model.languages[i] for i in (shares[0] > 0.2).nonzero()[0]} == {"de", "es"}
    assert model.languages[shares[1].argmax()] == "fr"


def plain_mixture(text, tables):
    """Language shares by dictionaries and loops: sets along the ranking of the full mixture, the best by penalised likelihood."""
    _, slots = language.trigrams([text])
    if not len(slots):
        return None
    p = [[table[s] for table in tables] for s in slots.tolist()]

    def run(allowed):
        share = [1 / len(allowed) if k in allowed else 0.0 for k in range(len(tables))]
        for _ in range(language.ROUNDS):
            new = [0.0] * len(tables)
            for row in p:
                total = sum(a * b for a, b in zip(share, row))
                for k in range(len(tables)):
                    new[k] += share[k] * row[k] / total / len(p)
            share = new
        return share, sum(math.log(sum(a * b for a, b in zip(share, row))) for row in p)

    order = sorted(range(len(tables)), key=lambda k: -run(range(len(tables)))[0][k])
    best = max(((sum(math.log(row[k]) for row in p), [float(j == k) for j in range(len(tables))]) for k in range(len(tables))),
               key=lambda o: o[0])
    stalled = 0
    for size in range(2, len(tables) + 1):
        share, likelihood = run(order[:size])
        value = likelihood - 0.5 * (size - 1) * math.log(len(p))
        stalled = 0 if value > best[0] else stalled + 1
        best = max(best, (value, share), key=lambda o: o[0])
        if stalled == language.PATIENCE:
            break
    return best[1]


def test_registered_query_equals_plain_version(spark):
    small = "/root/testdata/sf0.001"
    if not Path(small).exists():
        pytest.skip("benchmark tables are not here")
    rows = spark.read.parquet(f"{small}/documents.parquet").collect()
    held = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows}
    counts = defaultdict(lambda: np.full(language.SLOTS, language.SMOOTH))
    for r in rows:
        if r.text is not None and r.lang is not None and not held[r.doc_id]:
            np.add.at(counts[r.lang], language.trigrams([r.text])[1], 1)
    names = sorted(counts)
    tables = [(counts[x] / counts[x].sum()).astype(np.float64) for x in names]
    tables = [np.exp(np.log(t).astype(np.float32).astype(np.float64)) for t in tables]
    got = {r.doc_id: r for r in queries.op6_language(spark, small).collect()}
    assert set(got) == set(held)
    for r in [r for r in rows if len(r.text or "") < 1500]:
        share, found = plain_mixture(r.text or "", tables), got[r.doc_id]
        assert found.held_out == held[r.doc_id]
        if share is None:
            assert (found.lang_pred, found.score) == ("und", 0.0)
        else:
            assert found.score == pytest.approx(max(share), rel=1e-6)
            assert share[names.index(found.lang_pred)] == pytest.approx(max(share), rel=1e-6)


def test_many_languages_in_one_text(spark):
    """Six languages of their own letters: each has its sixth."""
    rng = random.Random(6)
    alphabets = ["abc", "def", "ghi", "jkl", "mno", "pqr"]
    said = {a: " ".join("".join(rng.choices(a, k=5)) for _ in range(300)) for a in alphabets}
    train = spark.createDataFrame([(i, t, a) for i, (a, t) in enumerate(said.items())], "doc_id int, text string, lang string")
    model = language.fit(train, F.lit(True))
    shares, _ = language.mixtures([" ".join(said.values()), said["ghi"], " ".join(list(said.values())[:5])], model)
    assert shares[0] == pytest.approx([1 / 6] * 6, abs=0.01)
    assert shares[1].max() > 0.999 and sorted(shares[2])[1:] == pytest.approx([0.2] * 5, abs=0.01) and shares[2].min() == 0


def test_too_many_labels(spark, monkeypatch):
    monkeypatch.setattr(language, "MOST_LANGUAGES", 2)
    df = spark.createDataFrame([(i, "aa", f"l{i}") for i in range(3)], "doc_id int, text string, lang string")
    with pytest.raises(ValueError, match="more than 2 labels"):
        language.fit(df, F.lit(True))


def test_edges(spark):
    train = spark.createDataFrame([(1, "aa bb aa", "x"), (2, "cc dd cc", "y"), (3, None, "x"), (4, "qq", None)],
                                  "doc_id int, text string, lang string")
    model = language.fit(train, F.lit(True))
    assert model.languages == ["x", "y"]
    rows = [(1, None, 1.0), (2, "", 1.0), (3, "12 %$", 1.0), (None, "aa", 1.0), (4, "aa", 1.0), (4, "aa", 1.0),
            (5, "cc " * 200_000, 1.0)]
    df = spark.createDataFrame(rows, "doc_id int, text string, score double")
    got = sorted((r.doc_id or 0, r.lang_pred, r.score) for r in language.identify(df, model).collect())
    assert got == [(0, "x", 1.0), (1, "und", 0.0), (2, "und", 0.0), (3, "und", 0.0), (4, "x", 1.0), (4, "x", 1.0),
                   (5, "y", 1.0)]
    none = language.fit(train, F.lit(False))
    assert none.languages == []
    assert {r.lang_pred for r in language.identify(df, none).collect()} == {"und"}
    assert language.identify(df.limit(0), model).collect() == []
