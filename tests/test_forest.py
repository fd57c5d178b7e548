from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegrid.operators import folds, forest

FEATURES, TARGETS = ["x", "noise", "flat"], ["up", "down"]
PARAMS = forest.ForestParams(trees=8, depth=4)


@pytest.fixture(scope="module")
def frame(spark):
    rng = random.Random(1)
    rows = [(i, float(i % 17), rng.random(), 1.0, float(i % 17) * 2 + rng.random(), -float(i % 17)) for i in range(120)]
    df = spark.createDataFrame(rows, "i int, x double, noise double, flat double, up double, down double")
    return folds.series_folds(df, 5, by=[], time="i").cache()


@pytest.fixture(scope="module")
def bundle(frame):
    return forest.fit_forests(frame, FEATURES, TARGETS, PARAMS, keys=["i"])


def test_scaler_uses_the_population_deviation(frame, bundle):
    vectors = np.array([r[0].toArray() for r in forest.scaled(frame, bundle.scaler).orderBy("i").select(forest.SCALED).collect()])
    x = np.array([r["x"] for r in frame.orderBy("i").collect()])
    np.testing.assert_allclose(vectors[:, 0], (x - x.mean()) / x.std())
    assert (vectors[:, 2] == 0).all()


def test_mean_of_votes_is_the_prediction(frame, bundle):
    for t in TARGETS:
        votes = forest.member_votes(forest.predict(frame, bundle, t), bundle, t)
        for r in votes.collect():
            assert len(r["votes"]) == 8 and np.mean(r["votes"]) == pytest.approx(r["prediction"])
        band = forest.forest_band(frame, bundle, t)
        assert band.where((F.col("p25") > F.col("p75")) | (F.col("std") < 0)).isEmpty()


def test_forests_do_not_depend_on_the_layout(spark, frame, bundle):
    want = forest.predict(frame, bundle, "up").orderBy("i").select("prediction").collect()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in (4, 32):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            dealt = frame.repartition(n, "noise").sortWithinPartitions("noise")
            again = forest.fit_forests(dealt, FEATURES, TARGETS, PARAMS, keys=["i"])
            assert forest.predict(frame, again, "up").orderBy("i").select("prediction").collect() == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_plan_of_votes_does_not_grow_with_the_trees(spark, frame, bundle):
    more = forest.fit_forests(frame, FEATURES, ["up"], forest.ForestParams(trees=40, depth=4), keys=["i"])
    plans = [len(forest.member_votes(frame, b, "up")._jdf.queryExecution().analyzed().toString().splitlines()) for b in (bundle, more)]
    assert plans[0] == plans[1]
    votes = forest.member_votes(frame, more, "up")
    assert "from_json" not in votes._jdf.queryExecution().optimizedPlan().toString()
    for r in votes.limit(30).collect():
        row = forest.scaled(spark.createDataFrame([r.asDict()], frame.schema), more.scaler).first()
        assert r["votes"] == [t.predict(row[forest.SCALED]) for t in more.models["up"].trees]


def test_partitions_follow_the_rows():
    params = forest.ForestParams(partition_rows=100, least_partitions=3)
    assert [params.partitions(n) for n in (0, 10, 300, 301, 10_000)] == [3, 3, 3, 4, 100]


def test_large_frames_ship_the_sums_of_few_partitions():
    params = forest.ForestParams()
    assert [params.partitions(n) for n in (0, 400, 75_000, 75_001, 950_000, 3_000_001, 5_700_000)] == [1, 1, 1, 2, 12, 13, 23]


def test_rows_are_dealt_in_the_order_of_the_features(frame):
    read = forest.ForestParams(least_partitions=3).dealt(frame, ["i"], FEATURES)
    parts = read.rdd.glom().map(lambda rows: [(r["x"], r["noise"], r["flat"], r["i"]) for r in rows]).collect()
    assert len(parts) == 3 and all(p == sorted(p) for p in parts)
    assert sorted(r[-1] for p in parts for r in p) == list(range(120))


def test_scoring_folds_moves_nothing_but_sums(frame, bundle):
    scores = forest.fold_scores(forest.out_of_fold(frame, bundle.scaler, ["up"], "fold", 5, PARAMS, keys=["i"]), "fold")
    plan = scores._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "InMemoryTableScan" not in plan


def test_importances(frame, bundle):
    rows = forest.feature_importance(bundle, frame, "up").collect()
    assert [r["rank"] for r in rows] == [1, 2, 3] and rows[0]["feature"] == "x" and sum(r["importance"] for r in rows) == pytest.approx(1)
    assert [r["importance"] for r in rows] == sorted((r["importance"] for r in rows), reverse=True)


def test_validation(frame, bundle):
    predicted = forest.out_of_fold(frame, bundle.scaler, TARGETS, "fold", 5, PARAMS, keys=["i"])
    assert predicted.count() == 240
    scores = forest.fold_scores(predicted, "fold").collect()
    assert sorted((r["target"], r["fold"]) for r in scores) == sorted((t, i) for t in TARGETS for i in range(5))
    metrics = {(r["target"], r["metric"]): r["value"] for r in forest.model_metrics(frame, bundle, "fold", keys=["i"]).collect()}
    up = [r["r2"] for r in scores if r["target"] == "up"]
    assert metrics[("up", "cv_mean")] == pytest.approx(np.mean(up)) and metrics[("up", "cv_std")] == pytest.approx(np.std(up))
    assert metrics[("down", "r2")] > 0.8 and len(metrics) == 6


def test_expanding_validation_looks_back_only(frame, bundle):
    predicted = forest.out_of_fold(frame, bundle.scaler, ["up"], "fold", 5, PARAMS, keys=["i"], expanding=True)
    assert {r["fold"] for r in predicted.select("fold").distinct().collect()} == {1, 2, 3, 4}
    # The later folds do not matter to the earlier ones.
    early = frame.where("fold < 3")
    a, b = (forest.out_of_fold(df, bundle.scaler, ["up"], "fold", n, PARAMS, keys=["i"], expanding=True)
            .where("fold = 2").orderBy("label", "prediction").collect() for df, n in ((frame, 5), (early, 3)))
    assert a == b and len(a) == 24


def test_save_and_load(frame, bundle, tmp_path):
    bundle.save(str(tmp_path / "m"))
    again = forest.ForestBundle.load(str(tmp_path / "m"), TARGETS)
    assert again.features == tuple(FEATURES)
    a, b = (forest.predict(frame, x, "up").orderBy("i").select("prediction").collect() for x in (bundle, again))
    assert a == b
