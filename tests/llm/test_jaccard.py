"""The similarity join against comparing all pairs, and its parts against plain versions."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from tidegrid.llm import jaccard
from tidegrid.llm.components import components
from tidegrid.llm.shingles import shingle_sets


def plain_set(text, words):
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(found) < words:
        return {tuple(found)} if found else set()
    return {tuple(found[i:i + words]) for i in range(len(found) - words + 1)}


def brute(rows, words, percent):
    """(id, set size, component) of each row, by all pairs."""
    sets = [plain_set(t, words) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x in range(len(rows)):
        for y in range(x):
            common = len(sets[x] & sets[y])
            if common and 100 * common >= percent * (len(sets[x]) + len(sets[y]) - common):
                root[find(x)] = find(y)
    low = {}
    for x, (i, _) in enumerate(rows):
        low[find(x)] = min(low.get(find(x), i) if i is not None else low.get(find(x)) or 10**9, i if i is not None else 10**9)
    return sorted((i is None, i or 0, len(s), (low[find(x)] if low[find(x)] < 10**9 else None) if s else i)
                  for x, ((i, _), s) in enumerate(zip(rows, sets)))


def copies(rng, n):
    """Texts of which many are exact, near or borderline copies of others, and many share a passage."""
    vocabulary = [f"w{i}" for i in range(400)] + ["Éa", "İx", "ABC"]
    passage = " ".join(rng.choices(vocabulary, k=60))
    bases = [rng.choices(vocabulary, k=rng.randrange(3, 150)) for _ in range(n // 8)]
    out = []
    for _ in range(n):
        words = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 2, 4])):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        text = rng.choice([" ", "  ", "\n"]).join(words)
        out.append(text + " " + passage if rng.random() < 0.3 else text.upper() if rng.random() < 0.1 else text)
    return out


@pytest.mark.parametrize("words,percent,block", [(4, 85, 4096), (5, 80, 7), (1, 60, 30)])
def test_equals_all_pairs(spark, monkeypatch, words, percent, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rng = random.Random(block)
    texts = copies(rng, 240) + [None, "", " \n", "one", "one", "two words", "Two  words"]
    rows = [(i if i != 5 else None, t) for i, t in enumerate(texts)] + [(8, texts[8]), (8, "another text of five words")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, n_shingles int")
    got = jaccard.jaccard_components(df, words, percent)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    seen = sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id) for r in got.collect())
    assert seen == brute(rows, words, percent)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert jaccard.jaccard_components(df).collect() == []


def test_tree_equals_all_pairs():
    rng = np.random.default_rng(1)
    for trial in range(20):
        base = [np.unique(rng.integers(0, 1 << 63, size=rng.integers(1, 200)).astype(np.uint64)) for _ in range(6)]
        sets = []
        for _ in range(60):
            s = base[rng.integers(6)]
            s = s[rng.random(len(s)) > rng.choice([0, 0.03, 0.1])]
            sets.append(np.unique(np.concatenate([s, rng.integers(0, 1 << 63, size=rng.integers(1, 6)).astype(np.uint64)])))
        side = rng.integers(0, 2, size=60) if trial % 2 else None
        links = {(x, y) for x in range(60) for y in range(x) if jaccard.similar(sets[x], sets[y], 85)
                 and (side is None or side[x] != side[y])}
        found = jaccard.tree_links(sets, 85, side)
        assert {(max(p), min(p)) for p in found} <= links
        assert groups(60, found) == groups(60, links) and len(found) == 60 - len(set(groups(60, links)))


def groups(n, links):
    label = list(range(n))
    for x, y in links:
        label = [label[x] if v == label[y] else v for v in label]
    return [label.index(v) for v in label]


def test_shingle_sets_match_plain_sets():
    rng = random.Random(3)
    texts = copies(rng, 60) + ["", "a", "a b", "a b c d", "x " * 500]
    for words in (1, 4):
        sets = shingle_sets(texts, words)
        plain = [plain_set(t, words) for t in texts]
        assert [len(s) for s in sets] == [len(p) for p in plain]
        for x in range(0, 60, 7):
            for y in range(x):
                assert len(np.intersect1d(sets[x], sets[y])) == len(plain[x] & plain[y])


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(7, 7), (201, 200), (200, 201)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 200: 200, 201: 200}


@pytest.mark.parametrize("percent", [60, 85, 95])
def test_similar_sets_share_a_token(percent):
    rng = np.random.default_rng(percent)
    for _ in range(1500):
        n = int(rng.choice([1, 2, 3, 5, 8, 13, 20, 40, 90, 200]))
        s = np.unique(rng.integers(0, 1 << 63, size=n).astype(np.uint64))
        cut = rng.random(len(s)) > rng.random() * (1 - percent / 100)
        more = rng.integers(0, 1 << 63, size=int(rng.random() * n * (100 / percent - 1)) + 1).astype(np.uint64)
        other = np.unique(np.concatenate([s[cut], more[:rng.integers(0, len(more) + 1)]]))
        if len(other) and jaccard.similar(s, other, percent):
            edges = jaccard.size_bands(percent, max(len(s), len(other)))
            shared = set(jaccard.tie_tokens(s, percent, edges).tolist()) & set(jaccard.tie_tokens(other, percent, edges).tolist())
            assert shared, (len(s), len(other))
