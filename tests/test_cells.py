from __future__ import annotations

import types

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidegrid.operators import cells, forest

MONTHS, SHARED = 24, ["year", "sine"]
FEATURES = ["year", "sine", "x", "noise"]
PARAMS = forest.ForestParams(trees=6, depth=5, max_bins=16)


def rows(n=3000, seed=3):
    rng = np.random.default_rng(seed)
    for i in range(n):
        month, x, noise = i % MONTHS, float(rng.integers(0, 40)), float(rng.random())
        year, sine = 2000 + month // 12, float(np.sin(month))
        yield i, month, year, sine, x, noise, 5 * sine + (x if x > 20 else -x) + (10 if year > 2000 and x < 5 else 0) + float(rng.normal())


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(list(rows()), "i int, month int, year int, sine double, x double, noise double, y double").cache()


@pytest.fixture(scope="module")
def bundle(frame):
    return forest.fit_forests(frame, FEATURES, ["y"], PARAMS, keys=["i"], shared=("month", SHARED))


def test_models_are_forests_of_mllib_and_predict_as_they_do(frame, bundle):
    model = bundle.models["y"]
    assert len(model.trees) == 6 and model.numFeatures == 4 and max(t.depth for t in model.trees) == 5
    plain = forest.ForestBundle(bundle.features, bundle.scaler, bundle.models)
    both = forest.predict(forest.predict(frame, bundle, "y"), plain, "y", "mllib")
    assert both.where("prediction <> mllib").isEmpty() and both.count() == 3000
    assert "ArrowEvalPython" in forest.predict(frame, bundle, "y")._jdf.queryExecution().toString()
    votes = forest.member_votes(both, bundle, "y").collect()
    assert all(np.mean(r["votes"]) == pytest.approx(r["prediction"]) for r in votes)
    assert sum(r["importance"] for r in forest.feature_importance(bundle, frame, "y").collect()) == pytest.approx(1)


def test_fits_on_cells_are_as_good_as_those_on_rows(frame, bundle):
    by_rows = forest.fit_forests(frame, FEATURES, ["y"], PARAMS, keys=["i"])
    scores = [forest.r2_score(forest.predict(frame, b, "y"), "y", "prediction").first()["r2"] for b in (bundle, by_rows)]
    assert scores[0] > scores[1] - 0.02 and scores[0] > 0.9
    scaled = [[b.scaler.stages[1].mean.toArray(), b.scaler.stages[1].std.toArray(), b.scaler.stages[2].getScalingVec().toArray()] for b in (bundle, by_rows)]
    np.testing.assert_allclose(scaled[0], scaled[1], rtol=1e-9)


def test_every_row_is_drawn_about_once_a_tree(frame, bundle, tmp_path):
    bundle.models["y"].save(str(tmp_path / "m"))
    nodes = [r["nodeData"] for r in frame.sparkSession.read.parquet(str(tmp_path / "m" / "data")).collect()]
    drawn = [n["rawCount"] for n in nodes if n["id"] == 0]
    assert len(drawn) == 6 and len(set(drawn)) > 1 and all(abs(n - 3000) < 5 * np.sqrt(3000) for n in drawn)
    assert min(n["rawCount"] for n in nodes) >= PARAMS.min_leaf


def test_fits_on_cells_do_not_depend_on_the_layout(spark, frame, bundle):
    want = forest.predict(frame, bundle, "y").orderBy("i").select("prediction").collect()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in (3, 17):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            dealt = frame.repartition(n, "noise").sortWithinPartitions("noise")
            again = forest.fit_forests(dealt, FEATURES, ["y"], PARAMS, keys=["i"], shared=("month", SHARED))
            assert forest.predict(frame, again, "y").orderBy("i").select("prediction").collect() == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_rows_that_agree_cost_one_entry(spark):
    """Forests of many rows go through cells: each distinct row once, whatever the number of its copies."""
    few = [(m, 2000 + m // 12, float(np.sin(m)), x, float(m + x)) for m in range(4) for x in (0.0, 1.0)]
    df = spark.createDataFrame(few * 500, "month int, year int, sine double, x double, y double")
    groups = cells.layout(1, [], np.empty((0, 0)), [np.array([0.5])])
    entries = cells.entry_rows(df, None, np.empty(0), ["x"], ["y"], groups, lambda f, x: x).collect()
    assert len(entries) == 8 and sum(r["_rows"] for r in entries) == 4000
    found = forest.fit_forests(df, ["year", "sine", "x"], ["y"], PARAMS, keys=["month"], shared=("month", SHARED))
    assert forest.r2_score(forest.predict(df, found, "y"), "y", "prediction").first()["r2"] > 0.999


def test_shared_features_must_be_functions_of_the_key(frame):
    with pytest.raises(ValueError, match="not functions of month"):
        forest.fit_forests(frame, FEATURES, ["y"], PARAMS, keys=["i"], shared=("month", ["year", "x"]))


@pytest.mark.parametrize("column", ["x", "sine", "y"])
def test_missing_values_are_errors(frame, column):
    gaps = frame.withColumn(column, F.when(F.col("month" if column == "sine" else "i") != 7, F.col(column)))
    with pytest.raises(ValueError, match="missing"):
        forest.fit_forests(gaps, FEATURES, ["y"], PARAMS, keys=["i"], shared=("month", SHARED))


def test_keys_of_too_many_values_are_not_used(frame, monkeypatch):
    monkeypatch.setattr(forest, "KEYS_AT_MOST", 23)
    found = forest.fit_forests(frame, FEATURES, ["y"], PARAMS, keys=["i"], shared=("month", SHARED))
    assert found.shared is None and len(found.models["y"].trees) == 6


def test_trees_are_those_of_a_search_over_all_splits(spark, monkeypatch):
    rng = np.random.default_rng(5)
    shared = np.array([[0.0, 3.0], [1.0, 1.0], [1.0, 2.0]])
    plan = cells.layout(3, [0, 2], shared, [np.array([0.5]), np.array([1.0, 2.0]), np.array([1.5, 2.5])])
    codes = np.array([[i, j] for i in range(3) for j in range(3)])
    packed = plan.packed(list(codes.T))[0]
    at = np.sort(rng.integers(0, 9, 300))
    table = pa.table({"_cell0": packed[at], "_y0": (codes[at] @ [3.0, -1.0]) ** 2 + rng.normal(size=300), "_rows": rng.integers(1, 4, 300)})
    entries = spark.createDataFrame(table).coalesce(1).sortWithinPartitions("_cell0").cache()
    table = entries.toArrow()
    got = cells.Growth(3, 3, 2, 9).grow(entries, plan, "_y0", 1.5)

    monkeypatch.setattr(cells, "TaskContext", types.SimpleNamespace(get=lambda: types.SimpleNamespace(partitionId=lambda: 0)))
    data = cells.Entries(iter(table.to_batches()), plan, "_y0", 0.0)
    of_entry = codes[np.searchsorted(packed, table["_cell0"].to_numpy())]
    of, bins = plan.bins()
    bin_of = np.stack([bins[f][of_entry[:, of[f]]] for f in range(3)], axis=1)
    for t, (tree, sums) in enumerate(got):
        w, y = data.drawn(9, t), table["_y0"].to_numpy()
        places = [(0, np.ones(len(y), dtype=bool), 0)]
        while places:
            node, here, level = places.pop()
            np.testing.assert_allclose(sums[:, node], [w[here].sum(), (w * y)[here].sum(), (w * y * y)[here].sum()], rtol=1e-9)
            best = (0.0, -1, 0)
            for f in range(3):
                for c in range(len(plan.cuts[f])):
                    sides = [here & (bin_of[:, f] <= c), here & (bin_of[:, f] > c)]
                    if all(w[s].sum() >= 2 for s in sides):
                        gain = (sum((w * y)[s].sum() ** 2 / w[s].sum() for s in sides) - (w * y)[here].sum() ** 2 / w[here].sum()) / w[here].sum()
                        best = max(best, (gain * (1 + 1e-7), f, c), key=lambda b: b[0]) if gain > best[0] else best
            if level == 3 or best[1] < 0:
                assert tree.feature[node] == -1
                continue
            assert (tree.feature[node], tree.cut[node]) == best[1:] and tree.gain[node] == pytest.approx(best[0], rel=1e-6)
            right = bin_of[:, tree.feature[node]] > tree.cut[node]
            places += [(tree.left[node], here & ~right, level + 1), (tree.right[node], here & right, level + 1)]


@pytest.mark.parametrize("rows", [1, 2, 16, 17, 400])
def test_bootstrap_draws_are_poisson(rows):
    n, made = 400_000, np.random.Generator(np.random.SFC64(rows))
    times = cells.Bootstrap(np.full(n, rows)).drawn(made)
    top = rows + int(3 * np.sqrt(rows)) + 1
    shares = np.exp(np.cumsum(np.log(rows / np.arange(1.0, top))) - rows)
    np.testing.assert_allclose(np.bincount(times.astype(int), minlength=top)[1:top] / n, shares, atol=5 * np.sqrt(shares.max() / n))
    assert times.mean() == pytest.approx(rows, abs=5 * np.sqrt(rows / n)) and times.var() == pytest.approx(rows, rel=0.02)


def test_bits_that_do_not_decide_a_draw_are_refined():
    for mean, (shares, draws) in enumerate(zip(cells.SHARES, cells.DRAWS), 1):
        undecided = draws == cells.OPEN
        assert 0 < undecided.sum() < 128 and shares[-1] == pytest.approx(1)
        sure = np.bincount(draws[~undecided], minlength=128)[:128] / 65536
        exact = np.diff(shares, prepend=0.0)
        assert (sure <= exact + 1e-12).all() and (exact - sure).sum() == pytest.approx(undecided.sum() / 65536)


def test_bins_set_frequent_values_apart():
    few = cells.cut_points(np.array([1.0, 2.0, 4.0]), np.array([5, 1, 9]), 16)
    assert few.tolist() == [1.5, 3.0]
    values, counts = np.arange(1000.0), np.ones(1000, dtype=int)
    counts[500] = 50_000
    ends = cells.cut_points(values, counts, 16)
    assert len(ends) <= 15 and {499.5, 500.5} <= set(ends)
    inside = np.diff(np.concatenate([[-0.5], ends, [999.5]]))
    assert inside.max() < 150 and len(ends) >= 10
    ties = cells.cut_points(values, np.where(np.arange(1000) % 20 == 0, 1000, 1), 16)
    assert 1 <= len(ties) <= 15
    next_to = np.array([1.0, np.nextafter(1.0, 2.0)])
    assert (np.searchsorted(cells.cut_points(next_to, np.array([1, 1]), 2), next_to) == [0, 1]).all()


def test_a_large_cell_is_dealt_to_several_partitions(spark):
    entries = spark.range(8000).select(F.when(F.col("id") < 6000, 1).otherwise(F.col("id")).alias("_cell0"),
                                       F.col("id").cast("double").alias("_y0"), F.lit(1).cast("long").alias("_rows"))
    sizes = cells.dealt(entries, ["_cell0"], ["_y0"], 4, 8000).rdd.glom().map(len).collect()
    assert len(sizes) == 4 and sum(sizes) == 8000 and max(sizes) < 4000
    parts = cells.dealt(entries, ["_cell0"], ["_y0"], 4, 8000).withColumn("p", F.spark_partition_id())
    assert parts.where("_cell0 > 1").groupBy("_cell0").agg(F.countDistinct("p").alias("n")).where("n > 1").isEmpty()


def test_wide_cells_take_several_words():
    rng = np.random.default_rng(1)
    cuts = [np.sort(rng.random(63)) for _ in range(12)]
    plan = cells.layout(13, [0], np.arange(5.0)[:, None], [np.arange(4.0), *cuts])
    codes = [rng.integers(0, g.size, 50) for g in plan.groups]
    assert len(plan.words) == 2
    assert all((a == b).all() for a, b in zip(plan.codes(plan.packed(codes)), codes))


def test_entries_are_dealt_to_few_partitions():
    params = forest.ForestParams()
    assert [params.entry_partitions(n) for n in (0, 75_000, 75_001, 5_600_000, 18_000_001)] == [1, 1, 2, 12, 13]
