"""Regression forests fitted on cells: the trees of MLlib's method on frames with too many rows for its passes.

A tree sees a row only through the bins of its features, so rows with equal bins are one cell. Features that are functions of
one column (a calendar's, of the month) are one code in a cell, and their sums follow from the sums by code. Equal labels
of a cell are one entry with a count. Every row is in one entry; a bootstrap gives an entry as many copies as its count of
rows draws (Poisson, as in MLlib), and a node is split where the variance falls most, as there.

Spark deals the entries, sums nodes by tree in the order of the partitions and hands the splits back, one job for a level of
all trees. The draws depend on the parameters and the dealt entries alone, so a fit is the same on any cluster.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Cells that are placed in a tree at a time, and nodes whose sums are one record.
CHUNK, BLOCK = 1 << 17, 64
#: Sums of up to so many Poisson(1) draws come from a table by 16 random bits, which is open where these do not decide.
SMALL, OPEN = 16, 255


def _poisson_tables() -> tuple[np.ndarray, np.ndarray]:
    """For each mean from 1 to ``SMALL``, the shares of draws up to 0, 1, 2, ..., and the draws by 16 bits."""
    mean, k = np.arange(1.0, SMALL + 1)[:, None], np.arange(1.0, 128)
    shares = np.cumsum(np.concatenate([np.exp(-mean), np.exp(-mean) * np.cumprod(mean / k, axis=1)], axis=1), axis=1)
    ends = np.arange(65537) / 65536
    at = np.stack([np.searchsorted(row, ends, side="right") for row in shares])
    return shares, np.where(at[:, :-1] == at[:, 1:], at[:, :-1], OPEN).astype(np.uint8)


SHARES, DRAWS = _poisson_tables()


class Bootstrap:
    """How often entries of ``counts`` rows are drawn: the sum of a Poisson(1) draw for each row."""

    def __init__(self, counts: np.ndarray):
        self.large, self.start = np.flatnonzero(counts > SMALL), (np.minimum(counts, SMALL) - 1) << 16
        self.counts = counts[self.large]

    def drawn(self, made: np.random.Generator) -> np.ndarray:
        bits = made.bit_generator.random_raw(len(self.start) // 4 + 1).view(np.uint16)[:len(self.start)]
        times = DRAWS.reshape(-1).take(self.start + bits)
        unsure = np.flatnonzero(times == OPEN)
        exact, table = (bits[unsure] + made.random(len(unsure))) / 65536, self.start[unsure] >> 16
        for mean in np.unique(table):
            times[unsure[table == mean]] = np.searchsorted(SHARES[mean], exact[table == mean], side="right")
        out = times.astype(np.float64)
        out[self.large] = made.poisson(self.counts)
        return out


@dataclass(frozen=True)
class Group:
    """Features that one code of a cell decides: for each, its place and the bin of every code."""

    size: int
    members: tuple[tuple[int, np.ndarray], ...]


@dataclass(frozen=True)
class Layout:
    """How features become cells. The shared group comes first, if there is one; each other group is one feature. ``cuts`` has
    the upper ends of the bins of every feature, ``words`` the groups of each packed whole number."""

    groups: tuple[Group, ...]
    cuts: tuple[np.ndarray, ...]
    words: tuple[tuple[int, ...], ...]

    @property
    def width(self) -> int:
        return sum(g.size for g in self.groups)

    def packed(self, codes: Sequence[np.ndarray]) -> list[np.ndarray]:
        """Cells as one whole number for each of ``words``, from the code of each group."""
        out = []
        for word in self.words:
            cell = np.zeros(len(codes[0]), dtype=np.int64)
            for g in word:
                cell = cell * self.groups[g].size + codes[g]
            out.append(cell)
        return out

    def codes(self, cells: Sequence[np.ndarray]) -> np.ndarray:
        """The code of each group, a row for each, from the numbers of :meth:`packed`."""
        found = np.empty((len(self.groups), len(cells[0])), dtype=np.int64)
        for word, cell in zip(self.words, cells):
            rest = cell.copy()
            for g in reversed(word):
                np.divmod(rest, self.groups[g].size, out=(rest, found[g]))
        return found

    def bins(self) -> tuple[np.ndarray, np.ndarray]:
        """Of each feature, its group and the bin of every code of it."""
        of, table = np.zeros(len(self.cuts), dtype=np.int64), np.zeros((len(self.cuts), max(g.size for g in self.groups)), dtype=np.int64)
        for i, g in enumerate(self.groups):
            for f, found in g.members:
                of[f], table[f, :g.size] = i, found
        return of, table


def layout(features: int, shared: Sequence[int], values: np.ndarray, cuts: Sequence[np.ndarray]) -> Layout:
    """``values`` has a row of the ``shared`` features for each code; every other feature is a group of its own."""
    groups = []
    if len(shared):
        members = tuple((f, np.searchsorted(cuts[f], values[:, i])) for i, f in enumerate(shared))
        groups.append(Group(max(1, len(values)), members))
    groups += [Group(len(cuts[f]) + 1, ((f, np.arange(len(cuts[f]) + 1)),)) for f in range(features) if f not in shared]
    words: list[list[int]] = [[]]
    room = 1 << 62
    for g, group in enumerate(groups):
        if room < group.size:
            words.append([])
            room = 1 << 62
        words[-1].append(g)
        room //= group.size
    return Layout(tuple(groups), tuple(cuts), tuple(map(tuple, words)))


def cut_points(values: np.ndarray, counts: np.ndarray, bins: int) -> np.ndarray:
    """Ends of at most ``bins`` bins of a feature, halfway between neighbours among its distinct ``values`` (ascending).

    Few values have a bin each. Of more, those with more rows than a mean bin have their own; the others share the rest in
    equal parts of the rows.
    """
    if len(values) > bins:
        heavy, rest, room = np.zeros(len(values), dtype=bool), counts.sum(), bins
        while room > 0 and (more := ~heavy & (counts * room > rest)).any():
            heavy |= more
            rest, room = counts[~heavy].sum(), bins - 2 * heavy.sum()
        if room <= 0:  # more ties than bins can set apart
            heavy[:], rest, room = False, counts.sum(), bins
        light = np.where(heavy, 0, counts)
        part = np.minimum((np.cumsum(light) - light / 2) * room // max(rest, 1), room - 1)
        ends = np.flatnonzero(heavy[1:] | heavy[:-1] | (part[1:] != part[:-1]))
    else:
        ends = np.arange(len(values) - 1)
    lo, hi = values[ends], values[ends + 1]
    return np.where((middle := lo / 2 + hi / 2) < hi, middle, lo)


@dataclass
class Tree:
    """Nodes by number, children after their parents; ``feature`` is -1 in leaves. Rows go right whose bin is above ``cut``."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [-1])
    right: list[int] = field(default_factory=lambda: [-1])
    gain: list[float] = field(default_factory=lambda: [-1.0])
    open: list[int] = field(default_factory=lambda: [0])

    def split(self, node: int, feature: int, cut: int, gain: float) -> tuple[int, int]:
        pair = len(self.feature), len(self.feature) + 1
        self.feature[node], self.cut[node], self.gain[node], (self.left[node], self.right[node]) = feature, cut, gain, pair
        for of, empty in ((self.feature, -1), (self.cut, 0), (self.left, -1), (self.right, -1), (self.gain, -1.0)):
            of += [empty, empty]
        return pair


class Router:
    """Leads cells to their nodes: one lookup a level, by node and code of the group that the node asks for."""

    def __init__(self, tree: Tree, of: np.ndarray, table: np.ndarray, rows: int):
        feature = np.asarray(tree.feature)
        asked, stay = np.maximum(feature, 0), np.arange(len(feature))[:, None]
        right = table[asked] > np.asarray(tree.cut)[:, None]
        self.next = np.where(feature[:, None] < 0, stay, np.where(right, np.asarray(tree.right)[:, None], np.asarray(tree.left)[:, None])).reshape(-1)
        self.plane, self.span = of[asked] * rows, table.shape[1]

    def place(self, planes: np.ndarray, lo: int, hi: int, levels: int) -> np.ndarray:
        """Nodes of the cells from ``lo`` to ``hi`` after ``levels`` splits; ``planes`` has all codes, group by group."""
        node, here = np.zeros(hi - lo, dtype=np.int64), np.arange(lo, hi)
        for _ in range(levels):
            at = self.plane.take(node)
            at += here
            node *= self.span
            node += planes.take(at)
            node = self.next.take(node)
        return node


class Entries:
    """The dealt entries of one partition, sorted by cell: codes by cell, labels and counts by entry."""

    def __init__(self, batches: Iterator[pa.RecordBatch], plan: Layout, label: str, shift: float):
        self.plan, self.part = plan, TaskContext.get().partitionId()
        found = list(batches)
        self.rows = sum(b.num_rows for b in found)
        if not self.rows:
            return
        read = pa.Table.from_batches(found)
        words = [read[f"_cell{i}"].to_numpy() for i in range(len(plan.words))]
        starts = np.concatenate([[True], np.logical_or.reduce([w[1:] != w[:-1] for w in words])])
        self.starts = np.flatnonzero(starts)
        self.cells = len(self.starts)
        words = [w[self.starts] for w in words]
        self.label = read[label].to_numpy() - shift
        self.bootstrap = Bootstrap(read["_rows"].to_numpy())
        del found, read, starts  # the Arrow buffers, before as much is made
        self.codes = plan.codes(words).reshape(-1)

    def drawn(self, seed: int, tree: int) -> np.ndarray:
        return self.bootstrap.drawn(np.random.Generator(np.random.SFC64([seed % (1 << 64), tree, self.part])))

    def by_cell(self, each: np.ndarray) -> np.ndarray:
        return np.add.reduceat(each, self.starts)

    def chunks(self) -> Iterator[tuple[int, int]]:
        return ((lo, min(lo + CHUNK, self.cells)) for lo in range(0, self.cells, CHUNK))


SUMS = "tree int, block int, part int, size int, at binary, sums binary"


def _record(tree: int, block: int, part: int, sums: np.ndarray) -> pa.RecordBatch:
    """Sums of a tree and block as one row; of mostly zeros (little data for the nodes), the others and their places."""
    flat, at = sums.reshape(len(sums), -1), np.empty(0, dtype=np.int32)
    some = np.flatnonzero(flat[0])
    if 2 * len(some) < flat.shape[1]:
        flat, at = flat[:, some], some.astype(np.int32)
    return pa.RecordBatch.from_pydict({
        **{k: pa.array([v], pa.int32()) for k, v in (("tree", tree), ("block", block), ("part", part), ("size", sums.size))},
        "at": pa.array([at.tobytes()], pa.binary()), "sums": pa.array([flat.tobytes()], pa.binary())})


def _level_sums(trees: Sequence[Tree], level: int, plan: Layout, label: str, shift: float, seed: int):
    """Weights and weighted labels of the open nodes of every tree, by group and code."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = Entries(batches, plan, label, shift)
        if not data.rows:
            return
        of, table = plan.bins()
        for t, tree in enumerate(trees):
            if not tree.open:
                continue
            router, among = Router(tree, of, table, data.cells), np.full(len(tree.feature), len(tree.open))
            among[tree.open] = np.arange(len(tree.open))
            times = data.drawn(seed, t)
            weight, total = data.by_cell(times), data.by_cell(times * data.label)
            found = [np.zeros((2, (len(tree.open) + 1) * g.size)) for g in plan.groups]
            for lo, hi in data.chunks():
                node = among.take(router.place(data.codes, lo, hi, level))
                for i, g in enumerate(plan.groups):
                    at = node * g.size
                    at += data.codes[i * data.cells + lo:i * data.cells + hi]
                    for k, of_cell in enumerate((weight, total)):
                        found[i][k] += np.bincount(at, of_cell[lo:hi], found[i].shape[1])
            whole = np.concatenate([x.reshape(2, -1, g.size) for x, g in zip(found, plan.groups)], axis=2)[:, :-1]
            for lo in range(0, len(tree.open), BLOCK):
                yield _record(t, lo // BLOCK, data.part, whole[:, lo:lo + BLOCK])

    return sums


def _summed(batches: Iterator[pa.RecordBatch], kinds: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """Sums of each tree and block over the partitions, in their order, from records that are sorted by all three; a row for
    each of ``kinds`` sums."""
    columns = ("tree", "block", "size")
    records = chain.from_iterable(zip(*[b[c].to_pylist() for c in columns], b["at"], b["sums"]) for b in batches)
    for (tree, block, size), found in groupby(records, key=lambda r: r[:3]):
        total = np.zeros((kinds, size // kinds))
        for *_, at, sums in found:
            at, here = np.frombuffer(at.as_buffer(), dtype=np.int32), np.frombuffer(sums.as_buffer()).reshape(kinds, -1)
            if here.shape == total.shape:
                total += here
            else:
                total[:, at] += here
        yield tree, block, total


def best_splits(weight: np.ndarray, total: np.ndarray, plan: Layout, min_leaf: float) -> tuple[np.ndarray, ...]:
    """Feature (-1: none), bin, gain and weights to both sides of the best split of each node.

    ``weight`` and ``total`` have a row for each node. Splits whose gains differ by rounding alone are ties, which the first
    feature and the least bin win. A gain that rounding can make is none.
    """
    n = len(weight)
    feature, cut, best, lefts, rights = np.full(n, -1), np.zeros(n, dtype=np.int64), np.zeros(n), np.zeros(n), np.zeros(n)
    start, each = 0, np.arange(n)
    ordered = []
    for g in plan.groups:
        ordered += [(f, slice(start, start + g.size), bins) for f, bins in g.members]
        start += g.size
    with np.errstate(divide="ignore", invalid="ignore"):
        for f, of, bins in sorted(ordered, key=lambda x: x[0]):
            order = np.argsort(bins, kind="stable")
            first = np.flatnonzero(np.diff(bins[order], prepend=-1))
            if len(first) < 2:
                continue
            w = np.cumsum(np.add.reduceat(weight[:, of][:, order], first, axis=1), axis=1)
            s = np.cumsum(np.add.reduceat(total[:, of][:, order], first, axis=1), axis=1)
            (w, all_w), (s, all_s) = ((x[:, :-1], x[:, -1:]) for x in (w, s))
            whole = all_s * all_s / all_w
            gain = s * s / w + (all_s - s) ** 2 / (all_w - w) - whole
            gain[~((w >= min_leaf) & (all_w - w >= min_leaf) & (w > 0) & (all_w > w) & (gain > 1e-12 * whole) & (gain < math.inf))] = -1.0
            at = np.argmax(gain >= gain.max(axis=1, keepdims=True) * (1 - 1e-10), axis=1)
            gain = gain[each, at] / all_w[:, 0]
            won = gain > best * (1 + 1e-9)
            feature[won], cut[won], best[won] = f, bins[order][first][at[won]], gain[won]
            lefts[won], rights[won] = w[each, at][won], (all_w[:, 0] - w[each, at])[won]
    return feature, cut, best, lefts, rights


SPLITS = "tree int, block int, feature array<int>, cut array<int>, gain array<double>, lefts array<double>, rights array<double>"


def _splits(plan: Layout, min_leaf: float):
    def splits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tree, block, sums in _summed(batches, 2):
            weight, total = sums.reshape(2, -1, plan.width)
            found = best_splits(weight, total, plan, min_leaf)
            kinds = (pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.float64())
            names = ("feature", "cut", "gain", "lefts", "rights")
            yield pa.RecordBatch.from_pydict(
                {"tree": pa.array([tree], pa.int32()), "block": pa.array([block], pa.int32())}
                | {k: pa.array([x.tolist()], pa.list_(kind)) for k, x, kind in zip(names, found, kinds)})

    return splits


def _leaf_sums(trees: Sequence[Tree], depth: int, plan: Layout, label: str, shift: float, seed: int):
    """Weights, weighted labels and weighted squares of the leaves of every tree."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = Entries(batches, plan, label, shift)
        if not data.rows:
            return
        of, table = plan.bins()
        for t, tree in enumerate(trees):
            router, times = Router(tree, of, table, data.cells), data.drawn(seed, t)
            each = [times, times * data.label, times * data.label * data.label]
            node = np.concatenate([router.place(data.codes, lo, hi, depth) for lo, hi in data.chunks()])
            yield _record(t, 0, data.part, np.stack([np.bincount(node, data.by_cell(x), len(tree.feature)) for x in each]))

    return sums


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for tree, _, sums in _summed(batches, 3):
        yield pa.RecordBatch.from_pydict({"tree": pa.array([tree], pa.int32()), "sums": pa.array([sums.tobytes()], pa.binary())})


@dataclass(frozen=True)
class Growth:
    """What decides the trees besides the entries."""

    trees: int
    depth: int
    min_leaf: int
    seed: int
    tasks: int = 48

    def _dealt(self, sums: DataFrame) -> DataFrame:
        return sums.repartition(min(self.trees, self.tasks), "tree").sortWithinPartitions("tree", "block", "part")

    def grow(self, entries: DataFrame, plan: Layout, label: str, shift: float) -> list[tuple[Tree, np.ndarray]]:
        """Trees over ``entries`` (held, as :func:`dealt` gives them), and for each the sums of its nodes: weight, label, square."""
        trees = [Tree() for _ in range(self.trees)]
        for level in range(self.depth):
            if not any(t.open for t in trees):
                break
            sums = entries.mapInArrow(_level_sums(trees, level, plan, label, shift, self.seed), SUMS)
            rows = self._dealt(sums).mapInArrow(_splits(plan, max(self.min_leaf, 0)), SPLITS).collect()
            for t, found in groupby(sorted(rows, key=lambda r: (r.tree, r.block)), key=lambda r: r.tree):
                tree, children = trees[t], []
                splits = chain.from_iterable(zip(r.feature, r.cut, r.gain, r.lefts, r.rights) for r in found)
                for node, (feature, cut, gain, *weights) in zip(tree.open, splits):
                    if feature >= 0:
                        pair = tree.split(node, feature, cut, gain)
                        children += [c for c, w in zip(pair, weights) if w >= 2 * self.min_leaf]
                tree.open = children
        sums = self._dealt(entries.mapInArrow(_leaf_sums(trees, self.depth, plan, label, shift, self.seed), SUMS))
        leaves = {r.tree: np.frombuffer(r.sums).reshape(3, -1).copy() for r in sums.mapInArrow(_whole, "tree int, sums binary").collect()}
        for t, tree in enumerate(trees):
            for node in range(len(tree.feature) - 1, -1, -1):
                if tree.feature[node] >= 0:
                    leaves[t][:, node] = leaves[t][:, tree.left[node]] + leaves[t][:, tree.right[node]]
            weight, total, square = leaves[t]
            leaves[t] = np.stack([weight, total + shift * weight, square + 2 * shift * total + shift * shift * weight])
        return [(tree, leaves[t]) for t, tree in enumerate(trees)]


def entry_rows(df: DataFrame, key: Column | None, codes: np.ndarray, features: Sequence[str], labels: Sequence[str],
               plan: Layout, rescale) -> DataFrame:
    """One row for each cell and labels, with its number of rows. ``key`` is the hash of the shared group, one of the sorted
    ``codes``; ``features`` are those with a group of their own, in its order, and ``rescale`` what trees compare of each."""
    keyed = key is not None
    own = [g.members[0][0] for g in plan.groups[int(keyed):]]
    words = [f"_cell{i}" for i in range(len(plan.words))]

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [np.searchsorted(codes, b["_key"].to_numpy())] if keyed else []
            found += [np.searchsorted(plan.cuts[f], rescale(f, b[f"_x{f}"].to_numpy(zero_copy_only=False))) for f in own]
            yield pa.RecordBatch.from_arrays([*map(pa.array, plan.packed(found)), *[b[c] for c in labels]], [*words, *labels])

    columns = [key.alias("_key")] if keyed else []
    columns += [F.col(c).cast("double").alias(f"_x{f}") for f, c in zip(own, features)]
    binned = df.select(*columns, *[F.col(c).cast("double").alias(c) for c in labels]).mapInArrow(
        cells, ", ".join([*[f"{w} long" for w in words], *[f"`{c}` double" for c in labels]]))
    return binned.groupBy(*words, *labels).agg(F.count("*").alias("_rows"))


def dealt(entries: DataFrame, words: Sequence[str], labels: Sequence[str], parts: int, rows: int) -> DataFrame:
    """Entries in ``parts`` partitions of about equal size, sorted by cell, a cell in one of them unless it has a good part of
    all entries: such a cell is dealt by its labels."""
    most = max(1, rows // (4 * parts))
    large = entries.groupBy(*words).count().where(F.col("count") > most).drop("count").withColumn("_large", F.lit(True))
    salt = F.when(F.col("_large"), F.pmod(F.xxhash64(*labels), F.lit(4 * parts))).otherwise(-1)
    marked = entries.join(F.broadcast(large), list(words), "left").withColumn("_salt", salt).drop("_large")
    return marked.repartition(parts, *words, "_salt").sortWithinPartitions(*words, *labels).drop("_salt")
