"""Toxicity: features against a plain version, held-out quality, copies, and the defined edge cases."""

from __future__ import annotations

import math
import random
import re
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegrid.llm import queries, toxicity

SMALL = "/root/testdata/sf0.01"
LEXICON = {"scum": 4.0, "lose*": 2.5, "bad": 1.0, "idiot": 5.0, "idi*": 2.2}


def plain_features(text):
    """Word by word, from the definitions."""
    tokens = text.split()
    words = [re.sub(r"^\W+|\W+$", "", t).lower() for t in tokens]

    def strength(w):
        found = [v for k, v in LEXICON.items() if len(w) > 1 and (k == w or k[-1] == "*" and w.startswith(k[:-1]) and len(w) >= len(k))]
        return max(found, default=0.0)

    bare = [re.sub(r"^[^\w@$]+|\W+$", "", t).lower() for t in tokens]
    disguised = [bool(not w.isalpha() and any(map(str.isalpha, w))) for w in bare]
    hidden = [re.sub(r"[\W_]+", "", w.translate(toxicity.DISGUISE)) if d else "" for w, d in zip(bare, disguised)]
    s = [max(strength(w), strength(h)) for w, h in zip(words, hidden)]
    a, b, c = toxicity.STRENGTHS
    strong, fair, weak = (sum(lo <= x < hi for x in s) for lo, hi in ((c, math.inf), (b, c), (a, b)))
    n, chars = max(1, len(tokens)), max(1, len(text))
    top = sorted((x for x in s if x >= a), reverse=True)[:3] + [0.0] * 3
    seconds = [i for i, w in enumerate(words) if w in toxicity.SECOND]
    gaps = [min((abs(i - j) for j in seconds), default=50) for i, x in enumerate(s) if x >= b]
    letters = [sum(map(str.isalpha, t)) for t in tokens]
    capitals = [sum(map(str.isupper, t)) for t in tokens]
    return [math.log1p(len(tokens)), *map(math.log1p, (strong, fair, weak)), strong / n, fair / n, weak / n, *top[:3], sum(s) / n,
            sum(g <= toxicity.NEAR for g in gaps) / n, min([50, *gaps]), len(seconds) / n, sum(capitals) / max(1, sum(letters)),
            sum(x >= 3 and x == y for x, y in zip(letters, capitals)) / n, text.count("!") / chars, text.count("?") / chars,
            sum(not ch.isalnum() for t in tokens for ch in t) / chars,
            sum(any(p == q and not p.isalnum() for p, q in zip(t, t[1:])) for t in tokens) / n, sum(disguised) / n,
            sum(d and strength(h) >= b for d, h in zip(disguised, hidden)) / n,
            sum(re.search(r"([^\W\d_])\1\1", w) is not None for w in words) / n]


def test_features_equal_plain_version():
    rng = random.Random(12)
    pool = ["you", "Scum!", "SCUM", "sc*um", "$cum", "loser", "lose", "losers!!", "bad", "1diot", "id-iot", "fine", "DU,", "nooo", "?!", "a", "é",
            "x9", "the", "Word.", "!!!", "99", "it's", "İ"]
    texts = ["", "  \n", "Scum you"] + [" ".join(rng.choices(pool, k=rng.randrange(120))) for _ in range(150)]
    got = toxicity.features(texts, toxicity.Tokens(LEXICON))
    assert got.shape == (len(texts), len(toxicity.FEATURES))
    np.testing.assert_allclose(got, [plain_features(t) for t in texts], atol=1e-12)


def rows(n=900, seed=2):
    rng = random.Random(seed)
    calm = ["river", "stone", "quiet", "morning", "letter", "window", "garden", "paper", "you", "the", "and"]
    rude = ["vermin", "lowlife", "dimwit"]
    docs, labels = [], []
    for i in range(n):
        words = rng.choices(calm, k=rng.randrange(15, 60))
        toxic = i % 5 == 0
        for _ in range(3 if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(rude))
        docs.append((i, " ".join(words), "x"))
        labels.append((i, 1, int(toxic)))
    return docs, labels


DOCS, LABELS = "doc_id bigint, text string, score string", "doc_id bigint, quality int, toxic int"


def test_learns_words_and_ignores_copies(spark):
    docs, labels = rows()
    train = F.col("doc_id") % 3 != 1
    copies = [(1000 + i, docs[0][1], "x") for i in range(120)] + [(2000 + i, docs[2][1], "x") for i in range(120)]
    odd = [(None, docs[0][1], None), (5000, None, None), (5001, "", None), (5002, "quiet " * 200_000, None), (5003, "VERMIN! dim-wit, you l0wlife", None)]
    found = []
    for more in ([], copies):
        model = toxicity.fit(spark.createDataFrame(docs + more, DOCS).repartition(4), spark.createDataFrame(
            labels + [(i, 1, int(i < 2000)) for i, *_ in more], LABELS).repartition(3), train)
        assert {"vermin", "lowlife", "dimwit"} <= set(model.lexicon) and not {"river", "you"} & set(model.lexicon)
        df = spark.createDataFrame(docs + odd, DOCS)
        found.append(sorted(((r[0] is None, r[0], r[1]) for r in toxicity.score(df, model).collect()), key=str))
    assert [f[:2] for f in found[0]] == [f[:2] for f in found[1]] and len(found[0]) == 905
    assert [f[2] for f in found[0]] == pytest.approx([f[2] for f in found[1]])
    by = {i: s for _, i, s in found[0]}
    assert all((by[i] >= 0.7) == (i % 5 == 0) for i in range(900))
    assert by[None] == by[0] and by[5003] >= 0.7 and max(by[5000], by[5001], by[5002]) < 0.3 and by[5000] == by[5001]


def test_without_labels_or_with_one_kind(spark):
    docs, labels = rows(30)
    df = spark.createDataFrame(docs, DOCS)
    for some, want in (([], 0.0), ([(i, 1, 0) for i, *_ in labels], 0.0), ([(i, 1, 1) for i, *_ in labels], 1.0), ([(None, 1, 1), (3, 1, None)], 0.0)):
        model = toxicity.fit(df, spark.createDataFrame(some, LABELS), F.lit(True))
        assert {r.score for r in toxicity.score(df, model).collect()} == {want}
    model = toxicity.fit(df.limit(0), spark.createDataFrame(labels, LABELS), F.lit(True))
    assert toxicity.score(df.limit(0), model).collect() == []


def test_registered_query(spark):
    if not Path(SMALL).exists():
        pytest.skip("benchmark tables are not here")
    found = queries.op12_toxicity(spark, SMALL)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    both = found.join(spark.read.parquet(f"{SMALL}/labels.parquet"), "doc_id").toPandas()
    assert len(found.collect()) == 1000 and both["score"].between(0, 1).all()
    assert (both["predicted"] == (both["score"] >= 0.7)).all()
    held = both[both["held_out"] & both["toxic"].notna()]
    toxic, rest = held[held["toxic"] == 1], held[held["toxic"] == 0]
    assert toxic["predicted"].mean() >= 0.75 and rest["predicted"].mean() <= 0.05
    pairs = (toxic["score"].to_numpy()[:, None] - rest["score"].to_numpy()[None, :])
    assert (pairs > 0).mean() + (pairs == 0).mean() / 2 >= 0.9
