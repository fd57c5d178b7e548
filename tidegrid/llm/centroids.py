"""Centroid clustering of whole-number vectors, exact, with ns-bounds.

The state of a vector is its cluster, an upper bound of the distance to that centroid and a lower bound of the distance
to each other one, every bound with the round in which it was evaluated. All rounds' centroids are kept. A bound is
loosened by the norm of the centroid's total displacement since its round (the norm of the sum of its moves), which is
never more than the sum of their norms. Centroids whose lower bound does not exceed the upper one are evaluated again,
exactly, in whole numbers. Vectors never move between tasks: each round reads the state and writes the next one, and only
what vectors that changed their cluster add or take away is summed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid.session import discard, stored

#: Whole numbers below which the squared distance of two vectors of 64 components fits 64 bits.
LARGEST = 1 << 27
#: Relative and absolute slack of bounds, far above the error of their floating sums.
LOOSE = 1e-9
#: Rows that a step of a task works on.
STEP_ROWS = 4096


def whole_vectors(df: DataFrame, id_col: str, vector_col: str, dimensions: int, scale: int) -> DataFrame:
    """``(id, vector array<bigint>)``: ``floor(scale * x)`` of vectors with ``dimensions`` finite components; others go."""
    v = F.col(vector_col)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))

    def whole(x: Column) -> Column:
        value = F.floor(F.lit(scale).cast("double") * x.cast("double"))
        return F.when(F.abs(x.cast("double")) * scale >= LARGEST, F.raise_error(F.lit("component too large"))).otherwise(value)

    kept = df.filter((F.size(v) == dimensions) & fine)
    return kept.select(F.col(id_col).alias("id"), F.transform(v, whole).cast("array<bigint>").alias("vector"))


def first_centroids(rows: DataFrame, k: int, prefix: str) -> np.ndarray:
    """The vectors of the ``k`` least ``sha256(prefix || id)``; of rows with one id, by their components."""
    hashed = rows.filter("id is not null").select(F.sha2(F.concat(F.lit(prefix), F.col("id").cast("string")), 256).alias("h"),
                                                  "vector")
    found = hashed.orderBy("h", "vector").limit(k).collect()
    return np.array([r["vector"] for r in found], dtype=np.int64)


def squared(x: np.ndarray, norms: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``x`` (of squared norms ``norms``) to ``c``."""
    top = int(max(np.abs(x).max(initial=0), np.abs(c).max(initial=0)))
    if 4 * top * top * len(c) < 1 << 53:  # every intermediate sum is a whole number that a double holds
        return norms - 2 * (x.astype(np.float64) @ c.astype(np.float64)).astype(np.int64) + int((c * c).sum())
    gap = x - c
    return (gap * gap).sum(axis=1)


def _down(d2: np.ndarray) -> np.ndarray:
    return np.nextafter(np.sqrt(d2.astype(np.float64)).astype(np.float32), np.float32(0)) * np.float32(1 - 1e-6)


def _up(d2: np.ndarray) -> np.ndarray:
    return np.nextafter(np.sqrt(d2.astype(np.float64)).astype(np.float32), np.float32(np.inf)) * np.float32(1 + 1e-6)


class State:
    """Vectors of a step with their clusters and bounds; ``bounds[i, cluster[i]]`` is the upper one."""

    def __init__(self, x: np.ndarray, cluster: np.ndarray, bounds: np.ndarray, seen: np.ndarray):
        self.x, self.cluster, self.bounds, self.seen = x, cluster, bounds, seen
        self.norms = (x * x).sum(axis=1)

    @classmethod
    def new(cls, x: np.ndarray, centroids: np.ndarray) -> State:
        state = cls(x, np.zeros(len(x), dtype=np.int64), np.empty((len(x), len(centroids)), np.float32),
                    np.zeros((len(x), len(centroids)), np.uint8))
        d2 = np.stack([squared(x, state.norms, c) for c in centroids], axis=1)
        state.cluster = d2.argmin(axis=1)  # the smallest number of equal ones
        state.bounds[:] = _down(d2)
        rows = np.arange(len(x))
        state.bounds[rows, state.cluster] = _up(d2[rows, state.cluster])
        return state

    def to_own(self, centroids: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Exact squared distances of ``rows`` to their own centroids."""
        own = self.cluster[rows]
        d2 = np.empty(len(rows), dtype=np.int64)
        for j in np.unique(own):
            some = np.flatnonzero(own == j)
            d2[some] = squared(self.x[rows[some]], self.norms[rows[some]], centroids[j])
        return d2

    def assign(self, history: list[np.ndarray]) -> int:
        """Assign every vector to the nearest centroid of the last of ``history``; gives how many distances were evaluated."""
        now, centroids = len(history) - 1, history[-1]
        moved = np.stack([np.sqrt(((centroids - c).astype(np.float64) ** 2).sum(axis=1)) for c in history])
        moved = moved * (1 + LOOSE) + LOOSE * (moved > 0)
        k, rows = len(centroids), np.arange(len(self.x))
        drift = moved[self.seen, np.arange(k)]
        low = self.bounds - drift
        low[rows, self.cluster] = np.inf
        high = self.bounds[rows, self.cluster] + drift[rows, self.cluster]
        doubtful = np.flatnonzero((low <= high[:, None]).any(axis=1))
        if not len(doubtful):
            return 0
        best, to = self.to_own(centroids, doubtful), self.cluster[doubtful].copy()
        self.bounds[doubtful, to] = _up(best)
        self.seen[doubtful, to] = now
        failing = low[doubtful] <= self.bounds[doubtful, to].astype(np.float64)[:, None]
        evaluated = len(doubtful) + int(failing.sum())
        for j in np.flatnonzero(failing.any(axis=0)):
            some = np.flatnonzero(failing[:, j])
            at = doubtful[some]
            d2 = squared(self.x[at], self.norms[at], centroids[j])
            self.bounds[at, j], self.seen[at, j] = _down(d2), now
            closer = (d2 < best[some]) | ((d2 == best[some]) & (j < to[some]))
            won = some[closer]
            # What was nearest so far was evaluated in this round too: its upper bound becomes a lower one.
            self.bounds[doubtful[won], to[won]] = _down(best[won])
            best[won], to[won] = d2[closer], j
            self.bounds[doubtful[won], j] = _up(best[won])
        self.cluster[doubtful] = to
        return evaluated


def _packed(x: np.ndarray) -> list[bytes]:
    small = len(x) and np.abs(x).max() < 1 << 15
    return [row.tobytes() for row in x.astype("<i2" if small else "<i4")]


def _unpacked(column: pa.Array, dimensions: int) -> np.ndarray:
    out = [np.frombuffer(b.as_buffer(), dtype=f"<i{len(b.as_buffer()) // dimensions}") for b in column]
    return np.array(out, dtype=np.int64).reshape(len(out), dimensions)


def _matrix(column: pa.Array, dtype: str, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(b.as_py() for b in column), dtype=dtype).reshape(len(column), width).copy()


def _state_batch(ids: pa.Array, state: State, was: np.ndarray, distance: np.ndarray | None) -> pa.RecordBatch:
    columns = {
        "id": ids, "vector": pa.array(_packed(state.x), pa.binary()), "cluster": pa.array(state.cluster, pa.int32()),
        "was": pa.array(was, pa.int32()), "bounds": pa.array([r.tobytes() for r in state.bounds], pa.binary()),
        "seen": pa.array([r.tobytes() for r in state.seen], pa.binary()),
        "distance": pa.nulls(len(ids), pa.int64()) if distance is None else pa.array(distance, pa.int64()),
    }
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, STEP_ROWS):
            yield batch.slice(start, STEP_ROWS)


def _sums(state: DataFrame, dimensions: int) -> list:
    """``(cluster, place, total)`` of what vectors with a new cluster bring (and, where they had one, take): at most one row
    for each component of each cluster; place -1 has the number of vectors."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in _steps(batches):
            x = np.column_stack([np.ones(batch.num_rows, dtype=np.int64), _unpacked(batch["vector"], dimensions)])
            for name, sign in (("cluster", 1), ("was", -1)):
                of = np.asarray(batch[name])
                for j in np.unique(of[of >= 0]).tolist():
                    total[j] = total.get(j, 0) + sign * x[of == j].sum(axis=0)
        for j, sums in total.items():
            n = dimensions + 1
            yield pa.RecordBatch.from_arrays([pa.array([j] * n, pa.int32()), pa.array(range(-1, dimensions), pa.int32()),
                                              pa.array(sums, pa.int64())], names=["cluster", "place", "total"])

    changed = state.filter("cluster <> was").select("vector", "cluster", "was")
    found = changed.mapInArrow(add, "cluster int, place int, total bigint")
    return found.groupBy("cluster", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()


def cluster(df: DataFrame, k: int = 40, rounds: int = 5, dimensions: int = 64, scale: int = 256, prefix: str = "2:",
            id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(id_col, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` of each vector that counts.

    Vectors of another length, missing ones and those with a missing or non-finite component do not count and have no row.
    Components become ``floor(scale * x)``; one of 2**27 or more is an error, since distances would not fit a long. Rows
    without id are clustered but start no centroid; repeated rows are rows like others and may start equal centroids, the
    later of which stay empty where they are. With fewer than ``k`` vectors that have an id there are as many centroids;
    without any, the result is empty. ``rounds`` is at most 250. Other columns are not read. ``k`` rows, and ``k`` times
    ``dimensions`` sums a round, reach the driver.
    """
    if not 0 <= rounds <= 250:
        raise ValueError("rounds must be 0 to 250")
    rows = whole_vectors(df, id_col, vector_col, dimensions, scale)
    history = [first_centroids(rows, k, prefix)]
    id_type = df.schema[id_col].dataType
    out_type = T.StructType([T.StructField(id_col, id_type)])
    if not len(history[0]):
        return rows.sparkSession.createDataFrame([], T.StructType([
            *out_type, T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType()),
            T.StructField("cluster_inertia", T.LongType()), T.StructField("inertia", T.LongType()),
            T.StructField("centroid_sha256", T.StringType())]))
    k = len(history[0])
    schema = T.StructType([
        T.StructField("id", id_type), T.StructField("vector", T.BinaryType()), T.StructField("cluster", T.IntegerType()),
        T.StructField("was", T.IntegerType()), T.StructField("bounds", T.BinaryType()), T.StructField("seen", T.BinaryType()),
        T.StructField("distance", T.LongType())])

    def begin(batches: Iterator[pa.RecordBatch], centroids: np.ndarray, last: bool) -> Iterator[pa.RecordBatch]:
        for batch in _steps(batches):
            x = batch["vector"].flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(batch.num_rows, dimensions)
            state = State.new(x, centroids)
            every = np.arange(len(x))
            yield _state_batch(batch["id"], state, np.full(len(x), -1), state.to_own(centroids, every) if last else None)

    def go_on(batches: Iterator[pa.RecordBatch], past: list[np.ndarray], last: bool) -> Iterator[pa.RecordBatch]:
        for batch in _steps(batches):
            was = np.asarray(batch["cluster"]).astype(np.int64)
            state = State(_unpacked(batch["vector"], dimensions), was.copy(), _matrix(batch["bounds"], "<f4", k),
                          _matrix(batch["seen"], "u1", k))
            state.assign(past)
            every = np.arange(len(was))
            yield _state_batch(batch["id"], state, was, state.to_own(past[-1], every) if last else None)

    sums = [[0] * (dimensions + 1) for _ in range(k)]
    state = stored(rows.mapInArrow(lambda b, c=history[0]: begin(b, c, not rounds), schema))
    for t in range(1, rounds + 1):
        for r in _sums(state, dimensions):
            sums[r["cluster"]][r["place"] + 1] += int(r["total"])
        history.append(np.array([[s // n[0] for s in n[1:]] if n[0] else old for n, old in zip(sums, history[-1].tolist())],
                                dtype=np.int64))
        before, state = state, stored(state.mapInArrow(lambda b, h=list(history), t=t: go_on(b, h, t == rounds), schema))
        discard(before)
    inertia = {r["cluster"]: r["n"] for r in state.groupBy("cluster").agg(F.sum("distance").alias("n")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in history[-1].tolist()]
    by_cluster = F.create_map(*[x for j in inertia for x in (F.lit(j), F.struct(
        F.lit(inertia[j]).cast("bigint").alias("cluster_inertia"), F.lit(sum(inertia.values())).cast("bigint").alias("inertia"),
        F.lit(digests[j]).alias("centroid_sha256")))])
    return state.select(F.col("id").alias(id_col), "cluster", "distance", by_cluster[F.col("cluster")].alias("of")).select(
        id_col, "cluster", "distance", "of.*")
