from __future__ import annotations

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidegrid.operators import encode, ensemble, folds, profile, quantiles, rank, scale, select

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]


def _columns(spark, columns: dict[str, list]):
    n = max(map(len, columns.values()))
    rows = list(zip(*[(v + [None] * n)[:n] for v in columns.values()]))
    return spark.createDataFrame(rows, ", ".join(f"`{c}` double" for c in columns)).repartition(4)


@pytest.mark.parametrize("accuracy", [2, 50, 20_000])
def test_quantiles_match_brute_force(spark, monkeypatch, accuracy):
    monkeypatch.setattr(quantiles, "ACCURACY", accuracy)
    rng = random.Random(7)
    columns = {
        "normal": [rng.gauss(0, 1) for _ in range(3000)],
        "hot": [5.0] * 2000 + [rng.random() * 10 for _ in range(1000)],
        "few": [float(rng.randrange(4)) for _ in range(999)],
        "heavy": [10 ** rng.uniform(-12, 12) for _ in range(2000)],
        "single": [3.25],
        "constant": [2.0] * 40,
        "pair": [1.0, 2.0],
        "extreme": [-1.7e308, 1.7e308, 0.0, 1.0, -1.0, 5e-324],
    }
    got = quantiles.column_quantiles(_columns(spark, columns), list(columns), PROBS)
    for c, values in columns.items():
        if c == "extreme":
            ordered = sorted(values)
            assert got[c][0] == ordered[0] and got[c][-1] == ordered[-1]
            assert got[c][3] == (ordered[2] + ordered[3]) / 2
        else:
            np.testing.assert_allclose(got[c], np.percentile(values, [p * 100 for p in PROBS]), rtol=1e-12, err_msg=c)


def test_quantiles_narrow_until_a_task_can_sort(spark, monkeypatch):
    """With few rows allowed to a sort, ranges close in over more scans, through ties and uneven densities."""
    monkeypatch.setattr(quantiles, "SORTED_ROWS", 12)
    monkeypatch.setattr(quantiles, "ACCURACY", 40)
    rng = random.Random(17)
    columns = {
        "even": [rng.random() for _ in range(4000)],
        "heavy": [10 ** rng.uniform(-300, 300) for _ in range(4000)],
        "ties": [float(rng.randrange(3)) for _ in range(2500)] + [1 + rng.random() * 1e-9 for _ in range(1500)],
        "edge": [0.0] * 1999 + [1.0 + i for i in range(2001)],
    }
    picked, plain = [], quantiles._sorted_ranks
    monkeypatch.setattr(quantiles, "_sorted_ranks", lambda df, c, ranges: (picked.extend(ranges), plain(df, c, ranges))[1])
    got = quantiles.column_quantiles(_columns(spark, columns), list(columns), PROBS)
    assert picked and all(r.inside <= 12 for r in picked) and any(r.apart for r in picked)
    for c, values in columns.items():
        np.testing.assert_allclose(got[c], np.percentile(values, [p * 100 for p in PROBS]), rtol=1e-12, err_msg=c)


def test_quantiles_survive_a_wrong_sketch(spark, monkeypatch):
    """Brackets that miss their ranks are widened and counted again."""
    values = [float(i) for i in range(500)]
    df = _columns(spark, {"v": values})
    edges = quantiles.Edges(500, 0.0, 499.0, {0.25: (300.0, 310.0), 0.5: (0.0, 3.0), 0.75: (374.0, 375.0)})
    got = quantiles.quantiles_from_edges(df, {"v": edges}, [0.25, 0.5, 0.75])
    np.testing.assert_allclose(got["v"], np.percentile(values, [25, 50, 75]))


@pytest.mark.parametrize("kind", ["loguniform", "heavy", "constant"])
def test_quantiles_scan_three_times(spark, monkeypatch, kind):
    rows = spark.range(60_000).select(F.when(F.lit(kind == "constant"), F.lit(4.0)).when(
        F.lit(kind == "heavy"), F.pow(F.rand(1), -3.0)).otherwise(F.exp(F.rand(2) * 50 - 25)).alias("v"))
    rows = rows.persist()
    scans = []
    for name in ("_count", "_sorted_ranks"):
        plain = getattr(quantiles, name)
        monkeypatch.setattr(quantiles, name, lambda df, columns, brackets, plain=plain: (
            scans.append(1) if brackets else None, plain(df, columns, brackets))[1])
    got = quantiles.column_quantiles(rows, ["v"], [0.25, 0.5, 0.75])
    assert 1 + len(scans) <= 3
    np.testing.assert_allclose(got["v"], np.percentile([r.v for r in rows.collect()], [25, 50, 75]), rtol=1e-12)
    rows.unpersist()


def test_quantiles_with_infinities_and_empty_columns(spark):
    columns = {"a": [-math.inf, 1.0, 2.0, math.inf, math.inf], "empty": [], "inf": [math.inf, -math.inf]}
    got = quantiles.column_quantiles(_columns(spark, columns), list(columns), [0.0, 0.25, 0.5, 1.0])
    assert got["a"] == [-math.inf, 1.0, 2.0, math.inf]
    assert got["empty"] == [None] * 4
    assert got["inf"][0] == -math.inf and got["inf"][3] == math.inf


def test_describe_matches_pandas(spark):
    rng = random.Random(3)
    data = {"x": [rng.gauss(10, 3) for _ in range(101)], "y": [float(i % 7) for i in range(60)]}
    df = _columns(spark, data).withColumn("label", F.lit("text"))
    want = pd.DataFrame({c: pd.Series(v) for c, v in data.items()}).describe()
    got = {(r["stat"], r["column_name"]): r["value"] for r in profile.describe(df).collect()}
    assert len(got) == 16
    for (stat, col), v in got.items():
        assert v == pytest.approx(want.loc[stat, col], rel=1e-12)
    wide = profile.describe_wide(profile.describe(df), ["x", "y"]).collect()
    assert [r["stat"] for r in wide] == list(profile.STATISTICS)


def test_profiles_and_gate(spark):
    df = spark.createDataFrame([(1.0, None), (math.inf, None), (None, 2.0)], "a double, b double")
    assert {tuple(r) for r in profile.missing_profile(df, ["a", "b"]).collect()} == {("a", 1), ("b", 2)}
    assert {tuple(r) for r in profile.inf_profile(df, ["a", "b"]).collect()} == {("a", 1)}
    assert tuple(profile.quality_gate(df, ["a", "b"]).first()) == (3, 3, 1, False)
    with pytest.raises(ValueError):
        profile.require_clean(df, ["a", "b"])
    assert profile.require_clean(df.dropna(), ["a", "b"]) == 0
    with pytest.raises(ValueError, match="nope"):
        profile.require_columns(df, ["a", "nope"])


def test_coverage_shows_absent_series(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", None)], "s string, v double")
    wanted = spark.createDataFrame([("a",), ("b",), ("z",)], "s string")
    got = {r["s"]: (r["n_obs"], r["n_grid"], r["is_empty"]) for r in
           profile.series_coverage(df, wanted, series="s", value="v").collect()}
    assert got == {"a": (1, 2, False), "b": (0, 1, True), "z": (0, 0, True)}


def test_r2(spark):
    rows = [("fit", 1.0, 1.1), ("fit", 2.0, 1.9), ("fit", 4.0, 4.2), ("flat", 3.0, 3.0), ("flat", 3.0, 3.0),
            ("off", 3.0, 3.0), ("off", 3.0, 4.0)]
    df = spark.createDataFrame(rows, "g string, y double, p double")
    got = {r["g"]: r["r2"] for r in profile.r2_score(df, "y", "p", by=["g"]).collect()}
    y, p = np.array([1.0, 2.0, 4.0]), np.array([1.1, 1.9, 4.2])
    assert got["fit"] == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    assert (got["flat"], got["off"]) == (1.0, 0.0)


def test_standardize(spark):
    x = [1.0, 2.0, 4.0, 9.0]
    df = spark.createDataFrame([(v, 5.0, "ab"[i % 2]) for i, v in enumerate(x)], "x double, c double, g string")
    rows = scale.standardize(df, {"x": "z", "c": "zc"}).orderBy("x").collect()
    np.testing.assert_allclose([r["z"] for r in rows], (np.array(x) - np.mean(x)) / np.std(x))
    assert [r["zc"] for r in rows] == [0.0] * 4
    grouped = scale.standardize(df, {"x": "z"}, by=["g"]).orderBy("x").collect()
    np.testing.assert_allclose([r["z"] for r in grouped], [-1, -1, 1, 1])


def test_encodings(spark):
    df = spark.sql("SELECT explode(sequence(date'2023-01-01', date'2024-12-01', interval 1 month)) AS period")
    out = encode.cyclic_month(encode.onehot_quarter(encode.onehot_month(encode.calendar_parts(df, "period"))))
    for r in out.collect():
        assert sum(r[c] for c in encode.MONTH_FLAGS.values()) == 1 == r[f"Month_{r['period'].month:02d}"]
        assert sum(r[c] for c in encode.QUARTER_FLAGS.values()) == 1 == r[f"Quarter_{(r['period'].month + 2) // 3}"]
        assert r["Month_Sin"] == pytest.approx(math.sin(math.pi * r["period"].month / 6), abs=1e-15)
        assert r["Month_Sin"] ** 2 + r["Month_Cos"] ** 2 == pytest.approx(1)


@pytest.mark.parametrize("n, sizes", [(50, [10] * 5), (53, [11, 11, 11, 10, 10]), (3, [1, 1, 1])])
def test_fold_sizes(spark, n, sizes):
    df = spark.range(n).select(F.lit("a").alias("s"), F.col("id").alias("month"))
    rows = folds.series_folds(df, 5, by=["s"]).orderBy("month").collect()
    assert [r["fold"] for r in rows] == [i for i, size in enumerate(sizes) for _ in range(size)]


def test_calendar_folds_keep_a_period_together(spark):
    df = spark.range(200).select((F.col("id") % 10).alias("s"), F.floor(F.col("id") / 10).alias("month"))
    per_month = folds.calendar_folds(df, 5).groupBy("month").agg(F.countDistinct("fold").alias("n"), F.max("fold").alias("f"))
    assert [(r["n"], r["f"]) for r in per_month.orderBy("month").collect()] == [(1, i // 4) for i in range(20)]


@pytest.mark.parametrize("n", [1, 2, 5, 64])
def test_ensemble_band(spark, n):
    rng = random.Random(n)
    votes = [rng.gauss(0, 2) for _ in range(n)]
    r = ensemble.ensemble_band(spark.createDataFrame([(votes,)], "v array<double>"), "v").first()
    np.testing.assert_allclose([r["mean"], r["std"], r["p25"], r["p75"]],
                               [np.mean(votes), np.std(votes), np.percentile(votes, 25), np.percentile(votes, 75)], atol=1e-12)


def test_topk_record_and_back(spark):
    rows = [("t", f, v) for f, v in (("d", 1.0), ("a", 3.0), ("c", 2.0), ("b", 3.0))] + [("u", "x", 9.0)]
    ranked = rank.topk(spark.createDataFrame(rows, "target string, feature string, importance double"), 3, by=["target"])
    want = {("t", 1, "a", 3.0), ("t", 2, "b", 3.0), ("t", 3, "c", 2.0), ("u", 1, "x", 9.0)}
    assert {(r["target"], r["rank"], r["feature"], r["importance"]) for r in ranked.collect()} == want
    record = rank.topk_record(ranked, 3, by=["target"])
    assert record.columns == ["target"] + [f"top{i}_{w}" for i in (1, 2, 3) for w in ("feature", "importance")]
    back = rank.unpivot_topk(record, 3, by=["target"])
    assert {(r["target"], r["rank"], r["feature"], r["importance"]) for r in back.collect()} == want


def test_selection(panel):
    df = panel({"a": {"2024-01": 1.0, "2024-03": 2.0}, "b": {"2024-02": 3.0}})
    assert [tuple(r)[0::2] for r in select.drop_last_period(df, by=["series_id"]).collect()] == [("a", 1.0)]
    assert {(r["series_id"], r["value"]) for r in select.latest_row(df, by=["series_id"]).collect()} == {("a", 2.0), ("b", 3.0)}
    indexed = select.add_row_index(df, by=["series_id"])
    assert {(r["series_id"], r["value"], r["row_idx"]) for r in indexed.collect()} == {("a", 1.0, 0), ("a", 2.0, 1), ("b", 3.0, 0)}
    assert select.move_to_front(df, "value").columns == ["value", "series_id", "month"]
    assert select.matching_columns(df.withColumn("X_YOY", F.lit(1)), "YOY", "MOM") == ["X_YOY"]
