"""Forest regression per target on MLlib: fit, predict, spread, validation and importances."""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import ElementwiseProduct, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.operators import cells
from tidegrid.operators.ensemble import ensemble_band
from tidegrid.operators.grid import stack_long
from tidegrid.operators.profile import r2_score
from tidegrid.session import discard, scratch_path, stored

RAW, SCALED = "_raw_features", "_features"
#: A key that shared features hang on has this many values at most; bins of other features are cut from a sample of about
#: ``SAMPLE`` rows, LEAST_SAMPLE at least (MLlib takes 10,000).
KEYS_AT_MOST, SAMPLE, LEAST_SAMPLE = 4096, 100_000, 10_000
#: Rows that a task predicts at a time.
PREDICTED = 1 << 20


@dataclass(frozen=True)
class ForestParams:
    """Ensemble settings. MLlib has no minimum split size; a node splits when both children keep
    ``min_leaf`` rows.

    MLlib draws the bootstrap partition by partition, so the number of partitions a fit sees is part of the model. It follows
    from the rows alone, one for each ``partition_rows`` and ``least_partitions`` at least: the same seed and rows give the
    same forest on any cluster, and a fit has as many tasks as its rows need. Every partition ships the sums of all nodes, so
    large frames have few for their rows; up to ``spread`` of them, one for each ``spread_rows``, keep smaller fits parallel."""

    trees: int = 100
    depth: int = 10
    min_leaf: int = 2
    max_bins: int = 64
    seed: int = 42
    partition_rows: int = 250_000
    least_partitions: int = 1
    spread: int = 12
    spread_rows: int = 75_000
    entry_rows: int = 1_500_000

    def entry_partitions(self, entries: int) -> int:
        """Partitions of the entries of cells: large, as each ships the sums of all nodes; a task holds one, about 200 bytes an
        entry."""
        return max(1, -(-entries // self.entry_rows), min(self.spread, -(-entries // self.spread_rows)))

    def partitions(self, rows: int) -> int:
        return max(self.least_partitions, -(-rows // self.partition_rows), min(self.spread, -(-rows // self.spread_rows)))

    def dealt(self, df: DataFrame, keys: Sequence[str], features: Sequence[str] = ()) -> DataFrame:
        """``df`` in the fixed partitions and order that fits read; ``keys`` tell its rows apart. In the order of ``features``,
        neighbours reach the same nodes and bins, whose sums are then at hand."""
        order = [*features, *(k for k in keys if k not in features)]
        return df.repartition(self.partitions(df.count()), *keys).sortWithinPartitions(*order)

    def regressor(self, label: str) -> RandomForestRegressor:
        return RandomForestRegressor(
            featuresCol=SCALED, labelCol=label, predictionCol="prediction",
            numTrees=self.trees, maxDepth=self.depth, minInstancesPerNode=self.min_leaf,
            maxBins=self.max_bins, featureSubsetStrategy="all", seed=self.seed,
        )


def fit_scaler(df: DataFrame, features: Sequence[str]) -> PipelineModel:
    """Assemble and standardise with the population deviation.

    MLlib scales with the sample deviation, so the vectors are stretched by sqrt(n / (n - 1)).
    """
    return _scaler(df, features, df.count())


def _scaler(df: DataFrame, features: Sequence[str], n: int) -> PipelineModel:
    assembled = VectorAssembler(inputCols=list(features), outputCol=RAW, handleInvalid="error")
    stretch = math.sqrt(n / (n - 1)) if n > 1 else 0.0
    return Pipeline(stages=[
        assembled,
        StandardScaler(inputCol=RAW, outputCol="_sample_scaled", withMean=True, withStd=True),
        ElementwiseProduct(inputCol="_sample_scaled", outputCol=SCALED,
                           scalingVec=Vectors.dense([stretch] * len(features))),
    ]).fit(df)


def scaled(df: DataFrame, scaler: PipelineModel) -> DataFrame:
    return scaler.transform(df).drop(RAW, "_sample_scaled")


@dataclass(frozen=True)
class ForestBundle:
    """One scaler and one forest per target, fitted on the same features. ``shared`` names a key and the features that it
    decides, as in :func:`fit_forests`."""

    features: tuple[str, ...]
    scaler: PipelineModel
    models: Mapping[str, RandomForestRegressionModel]
    params: ForestParams = field(default_factory=ForestParams)
    shared: tuple[str, tuple[str, ...]] | None = None

    def save(self, path: str) -> None:
        self.scaler.write().overwrite().save(f"{path}/scaler")
        for target, model in self.models.items():
            model.write().overwrite().save(f"{path}/{target}")

    @classmethod
    def load(cls, path: str, targets: Sequence[str]) -> ForestBundle:
        scaler = PipelineModel.load(f"{path}/scaler")
        models = {t: RandomForestRegressionModel.load(f"{path}/{t}") for t in targets}
        return cls(tuple(scaler.stages[0].getInputCols()), scaler, models)


def _fit_all(tasks: Sequence[tuple[str, DataFrame]], params: ForestParams, parallelism: int) -> list:
    """Fit ``(target, frame)`` pairs; several fits share the cluster, as in MLlib's own validators."""

    @inheritable_thread_target(tasks[0][1].sparkSession)
    def fit(task: tuple[str, DataFrame]) -> RandomForestRegressionModel:
        target, frame = task
        return params.regressor(target).fit(frame)

    with ThreadPool(max(1, min(parallelism, len(tasks)))) as pool:
        return pool.map(fit, tasks)


def fit_forests(
    df: DataFrame, features: Sequence[str], targets: Sequence[str], params: ForestParams = ForestParams(),
    parallelism: int = 8, *, keys: Sequence[str], shared: tuple[str, Sequence[str]] | None = None,
) -> ForestBundle:
    """Fit one forest per target. ``df`` must be a stable frame (a table or a checkpoint) whose rows ``keys`` tell apart: it
    is dealt once as the parameters say. The dealt rows are held until the scaled ones are, and those for the fits.

    ``shared`` is for frames of very many rows: a key column and the features that are functions of it, such as those of the
    calendar. The forests are then fitted on cells (see :mod:`tidegrid.operators.cells`), and rows that agree in the bins of all features
    are predicted once in a task. A key of more than ``KEYS_AT_MOST`` values is not used."""
    if shared and (table := _by_key(df, shared, [f for f in features if f not in shared[1]])) is not None:
        return _fit_cells(df, features, targets, params, keys, (shared[0], tuple(shared[1])), table)
    dealt = params.dealt(df.select(*keys, *[c for c in (*features, *targets) if c not in keys]), keys,
                         features).persist()
    try:
        scaler = fit_scaler(dealt, features)
        frame = scaled(dealt, scaler).select(SCALED, *targets).persist()
        frame.count()
    finally:
        dealt.unpersist()
    try:
        models = _fit_all([(t, frame) for t in targets], params, parallelism)
    finally:
        frame.unpersist()
    return ForestBundle(tuple(features), scaler, dict(zip(targets, models)), params)


def _by_key(df: DataFrame, shared: tuple[str, Sequence[str]], own: Sequence[str] = ()) -> pd.DataFrame | None:
    """Of every value of the key, by its hash (``_key``, ascending): rows, the shared features, and count, mean and variance of
    the ``own`` ones; nothing if there are too many. (Of two values with one hash, the features must agree too.)"""
    key, columns = shared
    found = df.groupBy(F.xxhash64(key).alias("_key"), *[F.col(c).cast("double").alias(f"_s{i}") for i, c in enumerate(columns)]).agg(
        F.count("*").alias("_rows"), *[f(F.col(c).cast("double")).alias(f"_{name}{i}") for i, c in enumerate(own)
                                       for name, f in (("n", F.count), ("mean", F.avg), ("var", F.var_pop))]).limit(KEYS_AT_MOST + 1).collect()
    if not 0 < len(found) <= KEYS_AT_MOST:
        return None
    table = pd.DataFrame([r.asDict() for r in found]).sort_values("_key", ignore_index=True)
    if table["_key"].duplicated().any():
        raise ValueError(f"{', '.join(columns)}: not functions of {key}")
    if (bad := [c for i, c in enumerate(columns) if not np.isfinite(table[f"_s{i}"].astype(float)).all()]) or (
            bad := [c for i, c in enumerate(own) if (table[f"_n{i}"] < table["_rows"]).any() or not np.isfinite(table[f"_mean{i}"]).all()]):
        raise ValueError(f"missing or infinite values in {', '.join(bad)}")
    return table


def _scaler_of(spark, table: pd.DataFrame, features: Sequence[str], shared: Sequence[str]) -> PipelineModel:
    """What :func:`fit_scaler` gives, from the moments by key: fitted on two rows of the same mean and deviation."""
    rows, n = table["_rows"].to_numpy(dtype=float), int(table["_rows"].sum())
    ends, own = [], [f for f in features if f not in shared]
    for f in features:
        of, inside = (f"_s{shared.index(f)}", 0.0) if f in shared else (f"_mean{own.index(f)}", table[f"_var{own.index(f)}"])
        means = table[of].to_numpy(dtype=float)
        mean = means[0] if np.ptp(means) == 0 else float(rows @ means / n)
        squares = float(np.sum(rows * (inside + (means - mean) ** 2)))
        off = math.sqrt(squares / max(n - 1, 1) / 2)
        ends.append((mean - off, mean + off))
    two = spark.createDataFrame([tuple(map(float, r)) for r in zip(*ends)], ", ".join(f"`{f}` double" for f in features))
    return _scaler(two, features, n)


def _rescaled(scaler: PipelineModel):
    """What :func:`scaled` makes of values of one feature, by its place."""
    mean, std = scaler.stages[1].mean.toArray(), scaler.stages[1].std.toArray()
    stretch = scaler.stages[2].getScalingVec().toArray()
    scale = np.divide(1.0, std, out=np.zeros_like(std), where=std != 0)
    return lambda f, x: (x - mean[f]) * scale[f] * stretch[f]


def _shared_values(table: pd.DataFrame, features: Sequence[str], shared: Sequence[str], rescale) -> np.ndarray:
    return np.stack([rescale(features.index(c), table[f"_s{i}"].to_numpy(dtype=float)) for i, c in enumerate(shared)], axis=1)


def _sample(df: DataFrame, own: Sequence[str], by: Sequence[str], rows: int) -> pd.DataFrame:
    """Values of the ``own`` features and how often they occur, in rows chosen by a hash of ``by``: the same on any layout."""
    share = max(1, rows // SAMPLE)
    while True:
        chosen = df.where(F.pmod(F.xxhash64(*by), F.lit(share)) == 0) if share > 1 else df
        found = chosen.select(*[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(own)]).groupBy(
            *[f"_x{i}" for i in range(len(own))]).agg(F.count("*").alias("_rows")).collect()
        if share == 1 or sum(r["_rows"] for r in found) >= LEAST_SAMPLE:
            return pd.DataFrame([tuple(r) for r in found], columns=[*own, "_rows"])
        share = max(1, share // 10)


def _cuts(values: np.ndarray, rows: np.ndarray, bins: int) -> np.ndarray:
    distinct, at = np.unique(values, return_inverse=True)
    return cells.cut_points(distinct, np.bincount(at, rows), bins)


def _fit_cells(df: DataFrame, features: Sequence[str], targets: Sequence[str], params: ForestParams, keys: Sequence[str],
               shared: tuple[str, tuple[str, ...]], table: pd.DataFrame) -> ForestBundle:
    spark, features = df.sparkSession, list(features)
    key, columns = shared
    own = [f for f in features if f not in columns]
    of_labels = df.agg(*[f(F.col(t).cast("double")) for f in (F.count, F.avg) for t in targets]).first()
    known, means = of_labels[:len(targets)], of_labels[len(targets):]
    rows = int(table["_rows"].sum())
    if bad := [t for t, n, mean in zip(targets, known, means) if n < rows or math.isnan(mean)]:
        raise ValueError(f"missing labels in {', '.join(bad)}")
    # Labels are counted from near their mean, so that sums of squares lose little in rounding; three digits are the same on any layout.
    shifts = [float(f"{mean:.3g}") if math.isfinite(mean) else 0.0 for mean in means]
    scaler = _scaler_of(spark, table, features, columns)
    rescale = _rescaled(scaler)
    values = _shared_values(table, features, columns, rescale)
    sample = _sample(df, own, list(dict.fromkeys([*keys, *targets])), rows) if own else None
    cuts = [_cuts(values[:, columns.index(f)], table["_rows"], params.max_bins) if f in columns else
            _cuts(rescale(i, sample[f].to_numpy()), sample["_rows"], params.max_bins) for i, f in enumerate(features)]
    plan = cells.layout(len(features), [features.index(c) for c in columns], values, cuts)
    names = [f"_y{i}" for i in range(len(targets))]
    labelled = df.select(key, *own, *[F.col(t).alias(n) for t, n in zip(targets, names)])
    entries = stored(cells.entry_rows(labelled, F.xxhash64(key), table["_key"].to_numpy(), own, names, plan, rescale))
    count = entries.count()
    held = cells.dealt(entries, [f"_cell{i}" for i in range(len(plan.words))], names, params.entry_partitions(count), count).persist()
    try:
        growth = cells.Growth(params.trees, params.depth, params.min_leaf, params.seed)
        grown = {t: growth.grow(held, plan, n, shift) for t, n, shift in zip(targets, names, shifts)}
    finally:
        held.unpersist()
    discard(entries)
    models = {t: _as_model(spark, params, t, len(features), cuts, trees) for t, trees in grown.items()}
    return ForestBundle(tuple(features), scaler, models, params, shared)


def _as_model(spark, params: ForestParams, target: str, features: int, cuts: Sequence[np.ndarray],
              trees: Sequence[tuple[cells.Tree, np.ndarray]]) -> RandomForestRegressionModel:
    """The trees as a forest of MLlib: a forest of roots, saved, gets their nodes and is loaded."""
    roots = spark.createDataFrame([(Vectors.dense([0.0] * features), 0.0)] * 2, [SCALED, target]).coalesce(1)
    path = scratch_path(spark, "forest")
    params.regressor(target).fit(roots).write().save(path)
    columns: dict[str, list] = {c: [] for c in ("tree", "id", "value", "impurity", "stats", "rows", "gain", "left", "right", "feature", "at")}
    for i, (tree, sums) in enumerate(trees):
        weight, total, square = sums
        mean = np.divide(total, weight, out=np.zeros_like(total), where=weight > 0)
        spread = np.maximum(np.divide(square, weight, out=np.zeros_like(total), where=weight > 0) - mean * mean, 0.0)
        nodes = len(tree.feature)
        for name, found in (("tree", [i] * nodes), ("id", range(nodes)), ("value", mean.tolist()), ("impurity", spread.tolist()),
                            ("stats", sums.T.tolist()), ("rows", weight.astype(np.int64).tolist()), ("gain", tree.gain),
                            ("left", tree.left), ("right", tree.right), ("feature", tree.feature),
                            ("at", [[float(cuts[f][c])] if f >= 0 else [] for f, c in zip(tree.feature, tree.cut)])):
            columns[name] += found
    kinds = {"value": "double", "impurity": "double", "gain": "double", "stats": "array<double>", "at": "array<double>", "rows": "long"}
    nodes = spark.createDataFrame(pa.table({k: pa.array(v, {"double": pa.float64(), "array<double>": pa.list_(pa.float64()),
                                                            "long": pa.int64()}.get(kinds.get(k), pa.int32())) for k, v in columns.items()}))
    split = F.struct(F.col("feature").alias("featureIndex"), F.col("at").alias("leftCategoriesOrThreshold"), F.lit(-1).alias("numCategories"))
    nodes.select(F.col("tree").alias("treeID"), F.struct(
        "id", F.col("value").alias("prediction"), "impurity", F.col("stats").alias("impurityStats"), F.col("rows").alias("rawCount"),
        "gain", F.col("left").alias("leftChild"), F.col("right").alias("rightChild"), split.alias("split")).alias("nodeData"),
    ).write.mode("overwrite").parquet(f"{path}/data")
    return RandomForestRegressionModel.load(path)


def _trees_of(model: RandomForestRegressionModel, features: int) -> tuple[list[np.ndarray], list[tuple[cells.Tree, np.ndarray, int]]]:
    """The thresholds of each feature, and each tree with the predictions of its nodes and its depth."""
    step = re.compile(r"If \(feature (\d+) <= (\S+)\)|(Else)|Predict: (\S+)")
    read = []
    for text in re.split(r"^  Tree \d+ .*$", model.toDebugString, flags=re.MULTILINE)[1:]:
        tree, at, value, depth = cells.Tree(), [0.0], [0.0], 0
        path: list[int] = []  # splits whose right side is to come
        node = 0
        for feature, threshold, other, predicted in step.findall(text):
            if feature:
                path.append(node)
                node, _ = tree.split(node, int(feature), 0, 0.0)
                at[path[-1]] = float(threshold)
                at += [0.0, 0.0]
                value += [0.0, 0.0]
            elif other:
                node = tree.right[path.pop()]
            else:
                value[node] = float(predicted)
        read.append((tree, np.asarray(at), np.asarray(value)))
    cuts = [np.unique(np.concatenate([at[np.asarray(t.feature) == f] for t, at, _ in read])) for f in range(features)]
    out = []
    for tree, at, value in read:
        depth = [0] * len(value)
        for node, f in enumerate(tree.feature):
            if f >= 0:
                tree.cut[node] = int(np.searchsorted(cuts[f], at[node]))
                depth[tree.left[node]] = depth[tree.right[node]] = depth[node] + 1
        out.append((tree, value, max(depth)))
    return cuts, out


def _predict_cells(df: DataFrame, bundle: ForestBundle, target: str, out: str, table: pd.DataFrame) -> DataFrame:
    """What the model predicts: in a task, rows in the same bins of its thresholds are led through the trees once."""
    key, columns = bundle.shared
    features = list(bundle.features)
    own = [f for f in features if f not in columns]
    rescale, (cuts, trees) = _rescaled(bundle.scaler), _trees_of(bundle.models[target], len(features))
    plan = cells.layout(len(features), [features.index(c) for c in columns], _shared_values(table, features, columns, rescale), cuts)
    known = table["_key"].to_numpy()

    def answer(parts: list[tuple[pd.Series, ...]]) -> pd.Series:
        hashes, *found = (np.concatenate([s.to_numpy() for s in of]) for of in zip(*parts))
        if any(np.isnan(x).any() for x in found):
            raise ValueError(f"missing values in {', '.join(own)}")
        codes = [np.searchsorted(known, hashes)]
        codes += [np.searchsorted(cuts[features.index(f)], rescale(features.index(f), x)) for f, x in zip(own, found)]
        cell = None
        for word in plan.packed(codes):
            here = pd.factorize(word)[0]
            cell = here if cell is None else pd.factorize(cell * (here.max() + 1) + here)[0]
        first = np.zeros(cell.max() + 1, dtype=np.int64)
        first[cell[::-1]] = np.arange(len(cell))[::-1]
        planes, of_feature = np.concatenate([c[first] for c in codes]), plan.bins()
        total = np.zeros(len(first))
        for tree, value, depth in trees:
            router = cells.Router(tree, *of_feature, len(first))
            for lo in range(0, len(first), cells.CHUNK):
                hi = min(lo + cells.CHUNK, len(first))
                total[lo:hi] += value.take(router.place(planes, lo, hi, depth))
        return pd.Series((total / len(trees))[cell])

    @F.pandas_udf("double")
    def predicted(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += len(batch[0])
            if rows >= PREDICTED:
                yield answer(held)
                held, rows = [], 0
        if rows:
            yield answer(held)

    return df.withColumn(out, predicted(F.xxhash64(key), *[F.col(f).cast("double") for f in own]))


def predict(df: DataFrame, bundle: ForestBundle, target: str, out: str = "prediction") -> DataFrame:
    if bundle.shared and (table := _by_key(df, bundle.shared)) is not None:
        return _predict_cells(df, bundle, target, out, table)
    return bundle.models[target].setPredictionCol(out).transform(scaled(df, bundle.scaler)).drop(SCALED)


def leaf_values(model: RandomForestRegressionModel) -> list[list[float]]:
    """Predictions of the leaves of each tree, in the order that the model numbers them (left to right)."""
    trees = re.split(r"^  Tree \d+ .*$", model.toDebugString, flags=re.MULTILINE)[1:]
    return [[float(v) for v in re.findall(r"Predict: (\S+)", tree)] for tree in trees]


def member_votes(df: DataFrame, bundle: ForestBundle, target: str, out: str = "votes") -> DataFrame:
    """Predictions of the single trees as an array.

    One transform gives the leaf that a row reaches in each tree; a table of leaf values, a constant of the plan, turns them
    into votes. The plan is the same for any number of trees.
    """
    model = bundle.models[target]
    values = F.from_json(F.lit(json.dumps(leaf_values(model))), "array<array<double>>")
    placed = model.transform(scaled(df, bundle.scaler), {model.leafCol: "_leaf", model.predictionCol: "_mean"})
    votes = F.zip_with(values, vector_to_array("_leaf"), lambda tree, leaf: F.get(tree, leaf.cast("int")))
    return placed.withColumn(out, votes).drop(SCALED, "_leaf", "_mean")


def forest_band(df: DataFrame, bundle: ForestBundle, target: str) -> DataFrame:
    """Mean, deviation and inter-quartile band over the trees for each row."""
    return ensemble_band(member_votes(df, bundle, target), "votes").drop("votes")


def out_of_fold(
    df: DataFrame, scaler: PipelineModel, targets: Sequence[str], fold: str, k: int = 5,
    params: ForestParams = ForestParams(), parallelism: int = 8, *, keys: Sequence[str], expanding: bool = False,
) -> DataFrame:
    """Predict each fold with forests fitted on the other folds, or with ``expanding`` on the earlier ones only.

    Gives ``(target, fold, label, prediction)`` rows for every target; ``expanding`` has none for fold 0, which nothing
    precedes. Rows are dealt and scaled once: held for the fits, and written by fold for the predictions, so that each
    model reads its own fold and nothing is dealt again.
    """
    frame = scaled(params.dealt(df, keys, scaler.stages[0].getInputCols()), scaler).select(SCALED, fold, *targets).persist()
    pairs = [(t, i) for t in targets for i in range(int(expanding), k)]
    try:
        whole = stored(frame, by=[fold])
        others = [F.col(fold) < i if expanding else F.col(fold) != i for _, i in pairs]
        models = _fit_all([(t, frame.where(rows)) for (t, _), rows in zip(pairs, others)], params, parallelism)
    finally:
        frame.unpersist()
    return stack_long([
        model.transform(whole.where(F.col(fold) == i)).select(
            F.lit(t).alias("target"), fold, F.col(t).alias("label"), "prediction")
        for (t, i), model in zip(pairs, models)
    ])


def fold_scores(predicted: DataFrame, fold: str) -> DataFrame:
    """R2 of each target and fold."""
    return r2_score(predicted, "label", "prediction", by=["target", fold])


def cv_scores(scores: DataFrame) -> DataFrame:
    """Mean and population deviation of the fold scores of each target."""
    return scores.groupBy("target").agg(F.avg("r2").alias("fold_mean"), F.stddev_pop("r2").alias("fold_std"))


def feature_importance(bundle: ForestBundle, df: DataFrame, target: str) -> DataFrame:
    """``(rank, feature, importance)``: normalised impurity decrease of each feature, largest first, ties by name."""
    weights = bundle.models[target].featureImportances.toArray()
    rows = sorted(((f, float(w)) for f, w in zip(bundle.features, weights)), key=lambda r: (-r[1], r[0]))
    ranked = [(i, *r) for i, r in enumerate(rows, 1)]
    return df.sparkSession.createDataFrame(ranked, "rank int, feature string, importance double").orderBy("rank")


def _metric_rows(scores: DataFrame, metrics: Mapping[str, str]) -> DataFrame:
    cells = [F.struct(F.lit(name).alias("metric"), F.col(c).alias("value")) for name, c in metrics.items()]
    return scores.select("target", F.inline(F.array(*cells)))


def model_metrics(
    df: DataFrame, bundle: ForestBundle, fold: str, k: int = 5, parallelism: int = 8, *, keys: Sequence[str],
    expanding: bool = False,
) -> DataFrame:
    """``(target, metric, value)`` rows: in-sample R2 and the mean and deviation of the fold scores."""
    fitted = stack_long([
        predict(df, bundle, t).select(F.lit(t).alias("target"), F.col(t).alias("label"), "prediction")
        for t in bundle.models
    ])
    predicted = out_of_fold(df, bundle.scaler, list(bundle.models), fold, k, bundle.params, parallelism, keys=keys,
                            expanding=expanding)
    folds = fold_scores(predicted, fold)
    return stack_long([
        _metric_rows(r2_score(fitted, "label", "prediction", by=["target"]), {"r2": "r2"}),
        _metric_rows(cv_scores(folds), {"cv_mean": "fold_mean", "cv_std": "fold_std"}),
    ])
