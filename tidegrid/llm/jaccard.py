"""Similarity join of documents by word shingles: signature trees inside exact candidate clusters.

1. Documents with equal shingle sets are one class.
2. Similar sets differ in few shingles. Hash values cut the universe into parts, more of them than two similar sets can
   differ in, so such sets agree on some whole part. A class emits a signature for its largest parts, as many as a similar
   set cannot all spoil; classes that share one are tied, and the connected components of the ties are clusters that no
   link crosses. A part holds several shingles, so a passage that many documents share seldom ties them.
3. Each cluster gets the sets of its classes once and is joined with itself by a signature tree: nodes hold the union of
   their sets' bitmaps and their size range, pairs of nodes are descended together, and pairs whose largest possible
   overlap is too small are dropped. Pairs of sets that remain are compared exactly. Sets already linked to each other
   through others need no comparison, so a large group of copies costs little more than its number.

Clusters larger than a block are split into blocks; every pair of blocks is joined by a task of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.llm.batches import id_and_text, runs, small_side, steps, with_id
from tidegrid.llm.components import components
from tidegrid.llm.shingles import mix, shingle_sets
from tidegrid.session import stored

#: Width of a size band, in steps of the largest size ratio of similar sets, and parts per possible difference.
BAND_STEPS, PART_FACTOR = 4, 1.25
#: Classes that one task joins with each other at most, and children of a tree node.
BLOCK, FANOUT = 4096, 8
_HALF = np.uint64((1 << 63) - 1)


# ---- one cluster --------------------------------------------------------------------------------------------------


class _Level:
    """Bitmaps, size ranges and bitmap losses of the nodes of one tree level."""

    def __init__(self, bits: np.ndarray, low: np.ndarray, high: np.ndarray, lost: np.ndarray):
        self.bits, self.low, self.high, self.lost = bits, low, high, lost

    def parents(self) -> _Level:
        at = np.arange(0, len(self.low), FANOUT)
        return _Level(np.bitwise_or.reduceat(self.bits, at), np.minimum.reduceat(self.low, at),
                      np.maximum.reduceat(self.high, at), np.maximum.reduceat(self.lost, at))


def _leaves(sets: list[np.ndarray]) -> _Level:
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    width = 1 << max(8, min(15, int(2 * sizes.max()).bit_length()))
    bits = np.zeros((len(sets), width // 64), dtype=np.uint64)
    for row, s in zip(bits, sets):
        at = s & np.uint64(width - 1)
        np.bitwise_or.at(row, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
    return _Level(bits, sizes, sizes, sizes - np.bitwise_count(bits).sum(axis=1, dtype=np.int64))


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether the Jaccard similarity of two sorted sets is at least ``percent`` / 100."""
    if len(a) > len(b):
        a, b = b, a
    if 100 * len(a) < percent * len(b):
        return False
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    common = int(np.count_nonzero(b[at] == a))
    return 100 * common >= percent * (len(a) + len(b) - common)


def tree_links(sets: list[np.ndarray], percent: int, side: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that connect all sets which similar pairs connect: a spanning forest of the similarity graph.

    With ``side`` (0 or 1 per set), only pairs from different sides are looked at.
    """
    count = len(sets)
    order = np.array(sorted(range(count), key=lambda i: (int(sets[i][0]), len(sets[i]), i)), dtype=np.int64)
    sorted_sets = [sets[i] for i in order]
    sides = None if side is None else side[order]
    label = np.arange(count)
    levels = [_leaves(sorted_sets)]
    while len(levels[-1].low) > 1:
        levels.append(levels[-1].parents())
    found: list[tuple[int, int]] = []
    stack = [(len(levels) - 1, 0, 0)]
    while stack:
        depth, a, b = stack.pop()
        if depth == 0:
            if a != b and label[a] != label[b] and (sides is None or sides[a] != sides[b]) and similar(
                    sorted_sets[a], sorted_sets[b], percent):
                found.append((int(order[a]), int(order[b])))
                label[label == label[b]] = label[a]
            continue
        span = FANOUT ** depth
        own = np.concatenate([label[a * span:(a + 1) * span], label[b * span:(b + 1) * span]])
        if own.min() == own.max():
            continue
        level = levels[depth - 1]
        x, y = (slice(n * FANOUT, min((n + 1) * FANOUT, len(level.low))) for n in (a, b))
        common = np.bitwise_count(level.bits[x][:, None] & level.bits[y][None]).sum(axis=2, dtype=np.int64)
        most = np.minimum(np.minimum(level.high[x], common.T + level.lost[x]).T,
                          np.minimum(level.high[y], common + level.lost[y]))
        fits = (100 + percent) * most >= percent * (level.low[x][:, None] + level.low[y][None])
        pairs = [(depth - 1, x.start + int(i), y.start + int(j)) for i, j in zip(*np.nonzero(fits)) if a != b or i <= j]
        # Pairs of a node with itself come off the stack first: uniform subtrees then spare their pairs with others.
        stack += sorted(pairs, key=lambda p: p[1] == p[2])
    return found


# ---- passes over the texts ----------------------------------------------------------------------------------------


def _set_key(s: np.ndarray) -> tuple[int, int]:
    """Two 63-bit sums that stand for a set."""
    a, b = mix(s ^ np.uint64(0x5851F42D4C957F2D)), mix(s + np.uint64(0x14057B7EF767814F))
    return int(a.sum(dtype=np.uint64) & _HALF), int(b.sum(dtype=np.uint64) & _HALF)


def size_bands(percent: int, largest: int) -> np.ndarray:
    """First sizes of the bands; sets in bands that do not touch are not similar."""
    ratio, edges = (100 / percent) ** BAND_STEPS, [1]
    while edges[-1] <= largest:
        edges.append(max(edges[-1] + 1, int(edges[-1] * ratio)))
    return np.array(edges, dtype=np.int64)


def _part_signatures(s: np.ndarray, band: int, parts: int) -> np.ndarray:
    """A signature for each part that the set has shingles in, largest parts first."""
    part = (s >> np.uint64(33)) % np.uint64(parts)
    order = np.argsort(part, kind="stable")
    part, mixed = part[order], mix(s[order] + np.uint64(band * 0xD6E8FEB86659FD93 % (1 << 64)))
    first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
    signature = mix(np.add.reduceat(mixed, first))
    size = np.diff(np.concatenate([first, [len(s)]]))
    return signature[np.lexsort((signature, -size))]


def tie_tokens(s: np.ndarray, percent: int, edges: np.ndarray) -> np.ndarray:
    """Tokens of which two similar sets always share one.

    Sets of sizes p <= q with similarity t or more differ in at most (p + q)(1 - t)/(1 + t) shingles, each of which spoils
    one part. So of the signatures of a set, in an order common to all sets, as many and one more hold one that the
    other set has too. A pair meets in the band of its smaller set: a set takes part in its own band, and in the one below
    if that has sets small enough. A set with too few parts emits all of them; two such sets meet by the plain prefix
    filter over their shingles.
    """
    n = len(s)
    own = int(np.searchsorted(edges, n, side="right")) - 1
    roles = [(own, (n + 100 * n // percent) * (100 - percent) // (100 + percent))]
    if own and n * percent <= 100 * int(edges[own] - 1):
        roles.append((own - 1, 2 * n * (100 - percent) // (100 + percent)))
    out, few = [], False
    for band, differ in roles:
        top = int(edges[band + 1])
        most = (top + 100 * top // percent) * (100 - percent) // (100 + percent)
        signatures = _part_signatures(s, band, int(PART_FACTOR * (most + 1)) + 1)
        few |= len(signatures) <= differ
        out.append(signatures[:differ + 1])
    if few:
        out.append(mix(s[:n - (percent * n + 99) // 100 + 1]))
    return np.concatenate(out)


def _describe(words: int):
    """Size and key of the shingle set of every text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in steps(batches):
            sets = shingle_sets(list(rows["text"]), words)
            keys = [_set_key(s) for s in sets]
            yield rows[["id", "digest"]].assign(n=[len(s) for s in sets], a=[k[0] for k in keys], b=[k[1] for k in keys])

    return run


def _tokens(words: int, percent: int):
    """``(token, a)`` for every set, once per set and task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[tuple[int, int]] = set()
        edges = size_bands(percent, 1 << 20)
        for rows in steps(batches):
            out = []
            for s in shingle_sets(list(rows["text"]), words):
                key = _set_key(s)
                if len(s) and key not in seen:
                    seen.add(key)
                    if len(s) >= edges[-1]:
                        edges = size_bands(percent, len(s))
                    out.append((key[0], tie_tokens(s, percent, edges).view(np.int64)))
            if out:
                yield pd.DataFrame({"token": np.concatenate([t for _, t in out]),
                                    "a": np.repeat([a for a, _ in out], [len(t) for _, t in out])})

    return run


def _sets(words: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in steps(batches):
            yield rows[["root", "blocks", "a", "b"]].assign(
                shingles=[s.tobytes() for s in shingle_sets(list(rows["text"]), words)])

    return run


def _join_clusters(percent: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in runs(batches, ["root", "i", "j"]):
            if len(rows) > 1:
                i, j = rows["i"].iloc[0], rows["j"].iloc[0]
                sets = [np.frombuffer(s, dtype=np.uint64) for s in rows["shingles"]]
                links = tree_links(sets, percent, None if i == j else (rows["own"] == j).to_numpy().astype(np.int64))
                if links:
                    x, y = (rows.iloc[list(ends)] for ends in zip(*links))
                    yield pd.DataFrame({"xa": x["a"].to_numpy(), "xb": x["b"].to_numpy(),
                                        "ya": y["a"].to_numpy(), "yb": y["b"].to_numpy()})

    return run


def _node(a: str, b: str) -> Column:
    """The two halves of a set key as one number of up to 126 bits."""
    return (F.col(a).cast("decimal(19,0)") * F.lit(Decimal(1 << 63)) + F.col(b)).cast("decimal(38,0)")


def jaccard_components(df: DataFrame, words: int = 4, percent: int = 85, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """``(id_col, n_shingles, component_id)``, one row per input row.

    Two rows link when the Jaccard similarity of their sets of ``words``-word shingles is at least ``percent`` / 100;
    ``component_id`` is the smallest id that links reach. A text without words (or a missing one) has no shingles, links
    with nothing and is its own component. Missing ids count as greater than all others; repeated ids and rows are rows
    like others. Other columns are not read.
    """
    rows = (id_and_text(df, id_col, text_col).withColumn("digest", F.md5("text")))
    described = stored(rows.mapInPandas(_describe(words), "id string, digest string, n bigint, a bigint, b bigint"))
    described = with_id(described.withColumn("node", F.when(F.col("n") > 0, _node("a", "b"))), df, id_col)
    classes = stored(described.filter("n > 0").groupBy("node", "a", "b")
                     .agg(F.min(id_col).alias("low"), F.min("digest").alias("digest")))

    # Half a key is enough to name a class here: classes that share it are tied to each other, no more.
    by_token = Window.partitionBy("token")
    ties = (rows.select("text").mapInPandas(_tokens(words, percent), "token bigint, a bigint")
            .select("a", F.min("a").over(by_token).alias("b"), F.max("a").over(by_token).alias("last"))
            .filter("b <> last").select("a", "b"))
    clusters = components(ties).withColumnRenamed("node", "a")
    same_half = classes.groupBy("a").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("a", F.col("a").alias("root"))
    clusters = stored(clusters.unionByName(same_half.join(clusters, "a", "anti")))
    large = (clusters.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks")).filter("blocks > 1"))
    members = (clusters.join(small_side(large), "root", "left").join(classes, "a")
               .select("root", F.coalesce("blocks", F.lit(1).cast("bigint")).alias("blocks"), "a", "b", "digest"))
    texts = rows.groupBy("digest").agg(F.first("text").alias("text"))
    sets = members.join(texts, "digest").mapInPandas(
        _sets(words), "root bigint, blocks bigint, a bigint, b bigint, shingles binary")
    pairs = (sets.withColumn("own", F.pmod(F.xxhash64("a", "b"), F.col("blocks")))
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
             .select("root", F.least("own", "other").alias("i"),
                     F.greatest("own", "other").alias("j"), "own", "a", "b", "shingles"))
    keys = ["root", "i", "j"]
    links = (pairs.repartition(*keys).sortWithinPartitions(*keys)
             .mapInPandas(_join_clusters(percent), "xa bigint, xb bigint, ya bigint, yb bigint")
             .select(_node("xa", "xb").alias("a"), _node("ya", "yb").alias("b")))
    roots = stored(components(links))

    rooted = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    found = rooted.join(lowest, "root").select("node", "component_id")
    return described.join(found, "node", "left").select(
        id_col, F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col(id_col)).alias("component_id"))
