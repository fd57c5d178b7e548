"""Clustering against plain rounds over all distances, the bounds' savings, and the defined edge cases."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from tidegrid.llm import centroids

SCHEMA = "vec_id bigint, embedding array<float>, cluster string"


def brute(rows, k, rounds, dims, scale=256):
    """By whole Python numbers, vector by vector."""
    kept = [(i, [math.floor(scale * float(np.float32(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    starts = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:k]
    middle = [v for _, v in starts]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(middle))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for j, own in groups.items():
            middle[j] = [sum(x) // len(own) for x in zip(*own)]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    inertia = {}
    for _, j, d in found:
        inertia[j] = inertia.get(j, 0) + d
    return sorted(((i, j, d, inertia[j], sum(inertia.values()),
                    hashlib.sha256(",".join(map(str, middle[j])).encode()).hexdigest()) for i, j, d in found), key=str)


def vectors(seed, n, dims, spread=1.0):
    rng = random.Random(seed)
    middles = [[rng.gauss(0, spread) for _ in range(dims)] for _ in range(6)]
    return [(i, [rng.gauss(m, 0.2) for m in rng.choice(middles)]) for i in range(n)]


@pytest.mark.parametrize(("k", "rounds", "dims", "spread"), [(7, 5, 4, 1.0), (12, 4, 3, 0.05), (5, 0, 2, 1.0), (300, 2, 4, 1.0)])
def test_equals_brute_force(spark, k, rounds, dims, spread):
    rows = vectors(k, 250, dims, spread)
    rows += [(None, rows[3][1]), (9, rows[9][1]), (9, rows[8][1]), (400, None), (401, rows[0][1][:-1]),
             (402, [None, *rows[0][1][1:]]), (403, [float("nan"), *rows[0][1][1:]]), (404, [float("inf"), *rows[0][1][1:]])]
    rows += [(500 + i, rows[5][1]) for i in range(130)]  # a third of all are one vector
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], SCHEMA).repartition(5)
    got = centroids.cluster(df, k, rounds, dims)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, k, rounds, dims)


def test_bounds_hold_and_save_work():
    rng = np.random.default_rng(3)
    x = (rng.normal(size=(2000, 8)) * 40 + rng.integers(-3, 4, size=(2000, 1)) * 400).astype(np.int64)
    history = [x[:20].copy()]
    state, evaluated = centroids.State.new(x, history[0]), []
    for _ in range(12):
        sums = [x[state.cluster == j].sum(axis=0) // max(1, (state.cluster == j).sum()) if (state.cluster == j).any()
                else history[-1][j] for j in range(20)]
        history.append(np.array(sums))
        evaluated.append(state.assign(history))
        d2 = ((x[:, None, :] - history[-1]) ** 2).sum(axis=2)
        assert (state.cluster == d2.argmin(axis=1)).all()
        true = np.stack([np.sqrt(((x - h[j]) ** 2).sum(axis=1)) for j in range(20) for h in [history[-1]]], axis=1)
        then = np.stack([np.sqrt(((history[-1] - h) ** 2).sum(axis=1)) for h in history])[state.seen, np.arange(20)]
        own = np.zeros_like(state.seen, dtype=bool)
        own[np.arange(len(x)), state.cluster] = True
        assert (np.where(own, true <= state.bounds + then + 1e-6, true >= state.bounds - then - 1e-6)).all()
    assert sum(evaluated[3:]) < 0.3 * 9 * x.shape[0] * 20


def test_large_components_stay_exact():
    rng = np.random.default_rng(5)
    x = rng.integers(-(1 << 26), 1 << 26, size=(50, 64))
    want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(v, c)) for c in x[:3]] for v in x]
    assert np.stack([centroids.squared(x, (x * x).sum(axis=1), c) for c in x[:3]], axis=1).tolist() == want


def test_edges(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0], "a"), (None, [0.0, 0.0], None)], SCHEMA)
    # One centroid, half-way between both.
    assert [r.distance for r in centroids.cluster(df, dimensions=2).collect()] == [128 ** 2 + 256 ** 2] * 2
    for empty in (df.limit(0), df.filter("vec_id is null")):
        got = centroids.cluster(empty, dimensions=2)
        assert got.collect() == [] and got.columns == centroids.cluster(df, dimensions=2).columns
    with pytest.raises(Exception, match="component too large"):
        centroids.cluster(spark.createDataFrame([(1, [1e30, 0.0], "a")], SCHEMA), dimensions=2).collect()
