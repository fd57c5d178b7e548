"""Toxicity scores by gradient-boosted trees over dense features of a text, calibrated by isotonic regression.

A lexicon is learnt first: words and beginnings of words that toxic training texts have more often than others, as a
cautious logarithm of the odds ratio. The features of a text are the densities of lexicon words by strength, how near they stand to
a second person, and rates of capitals, punctuation and disguised words. For the trees, a text's features come from the
lexicon of the other half of the training texts, so that no text is judged by words learnt from itself; a quarter of the
training texts is kept from the trees and calibrates their scores.

Copies of a text count once, everywhere. All labelled rows are learnt from; counts meet by Spark, the trees are MLlib's.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.batches import id_and_text, steps, with_id
from tidegrid.session import stored

#: Lengths of the beginnings of words that may be entries of a lexicon.
BEGINNINGS = range(3, 8)
#: An entry stands in so many toxic texts, and in this share of them. A text of n words has at most 6 n keys, so as many as
#: 6 n / ``LEAST_SHARE`` keys pass, n being the mean, however many texts there are.
LEAST_TEXTS, LEAST_SHARE = 3, 0.004
#: Deviations by which the logarithm of an odds ratio is lowered, and the strengths that count as weak, fair and strong.
CAUTION, STRENGTHS = 1.64, (0.7, 2.0, 3.5)
#: Words between a lexicon word and a second person that count as near.
NEAR = 4
#: Settings of the trees; bins of scores that isotonic regression sees.
TREES, DEPTH, STEP, BINS = 24, 4, 0.2, 1000
#: Words that a task remembers, and characters whose features it makes in one step.
REMEMBERED, FEATURE_CHARS = 200_000, 2_000_000

# Second persons, and letters that signs stand for in disguised words.
SECOND = frozenset("you your yours yourself u ur du dich dir dein deine deiner euch tu te toi ton ta tes vous votre vos ti usted "
                   "ustedes vuestro".split())
DISGUISE = str.maketrans("@4013$57!|", "aaoiesstil")
_EDGES = re.compile(r"^\W+|\W+$")
#: The same, but for the signs that words begin with when they are disguised.
_BARE = re.compile(r"^[^\w@$]+|\W+$")
_SIGNS = re.compile(r"[\W_]+")
_LONG = re.compile(r"([^\W\d_])\1\1")

FEATURES = (
    "words", "strong", "fair", "weak", "strong_share", "fair_share", "weak_share", "best", "second_best", "third_best",
    "mean_strength", "near_second", "nearest_second", "second_share", "capital_share", "shouted_share", "exclamation_rate",
    "question_rate", "punctuation_rate", "doubled_sign_share", "disguised_share", "disguised_hits", "drawn_out_share")

Lexicon = dict[str, float]


class Model(NamedTuple):
    """The lexicon of all training texts, the trees and the calibration; without trees every score is ``base``."""

    lexicon: Lexicon
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    base: float


def plain(token: str) -> str:
    """A token in lower case, without signs at its ends."""
    return _EDGES.sub("", token).lower()


def undisguised(token: str) -> str | None:
    """What a word with signs or digits among its letters may stand for."""
    word = _BARE.sub("", token).lower()
    if word.isalpha() or not any(c.isalpha() for c in word):
        return None
    return _SIGNS.sub("", word.translate(DISGUISE))


def keys_of(word: str) -> list[str]:
    """The entries that a word can match: itself, and its beginnings (with ``*``)."""
    return [word, *[f"{word[:n]}*" for n in BEGINNINGS if n < len(word)]]


# ---- the lexicon ----------------------------------------------------------------------------------------------------


def _count_keys(train: DataFrame, known: frozenset[str] | None) -> DataFrame:
    """``(key, fold, n)``: texts of ``train`` with a key (of ``known``, if given) in each fold; tasks add up their own."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, Counter] = {}
        matched: dict[str, list[str]] = {}

        def flush() -> Iterator[pd.DataFrame]:
            for fold, counts in ((f, c) for f, c in held.items() if c):
                yield pd.DataFrame({"key": list(counts), "fold": fold, "n": list(counts.values())})
            held.clear()

        for rows in steps(batches):
            for text, fold in zip(rows["text"], rows["fold"]):
                found = set()
                for token in set(text.split()):
                    keys = matched.get(token)
                    if keys is None:
                        word = plain(token)
                        keys = keys_of(word) if len(word) > 1 else []
                        if known is not None:
                            keys = [k for k in keys if k in known]
                        if len(matched) >= REMEMBERED:
                            matched.clear()
                        matched[token] = keys
                    found.update(keys)
                held.setdefault(fold, Counter()).update(found)
            if sum(map(len, held.values())) > REMEMBERED:
                yield from flush()
        yield from flush()

    return train.select("text", "fold").mapInPandas(count, "key string, fold int, n bigint").groupBy("key", "fold").agg(
        F.sum("n").alias("n"))


def strengths(toxic: dict[str, int], others: dict[str, int], n_toxic: int, n_others: int) -> Lexicon:
    """Cautious logarithms of odds ratios of the keys of ``toxic``, as far as they reach the least strength."""
    out = {}
    for key, a in toxic.items():
        b = others.get(key, 0)
        odds = [(x + 0.5) / (n - x + 0.5) for x, n in ((a, n_toxic), (b, n_others))]
        spread = sum(1 / (x + 0.5) + 1 / (n - x + 0.5) for x, n in ((a, n_toxic), (b, n_others)))
        value = math.log(odds[0] / odds[1]) - CAUTION * math.sqrt(spread)
        if value >= STRENGTHS[0]:
            out[key] = value
    return out


def lexicons(train: DataFrame) -> list[Lexicon]:
    """Of the texts of fold 0, of fold 1 and of all, from ``train (text, fold, label)``.

    First the toxic texts alone are counted, then of the others only the keys that came through."""
    sizes = {(r["label"], r["fold"]): r["n"] for r in train.groupBy("label", "fold").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic = sum(n for (label, _), n in sizes.items() if label)
    found = _count_keys(train.filter("label = 1"), None)
    least = max(LEAST_TEXTS, math.ceil(LEAST_SHARE * n_toxic))
    wide = found.groupBy("key").pivot("fold", [0, 1]).agg(F.sum("n")).fillna(0).filter(F.col("0") + F.col("1") >= least)
    toxic = {r["key"]: (r["0"], r["1"]) for r in wide.toLocalIterator()}
    others: dict[str, list[int]] = {}
    for r in _count_keys(train.filter("label = 0"), frozenset(toxic)).toLocalIterator():
        others.setdefault(r["key"], [0, 0])[r["fold"]] = r["n"]
    out = []
    for folds in ((0,), (1,), (0, 1)):
        out.append(strengths(
            {k: n for k, v in toxic.items() if (n := sum(v[f] for f in folds)) >= LEAST_TEXTS},
            {k: sum(v[f] for f in folds) for k, v in others.items()},
            sum(sizes.get((1, f), 0) for f in folds), sum(sizes.get((0, f), 0) for f in folds)))
    return out


# ---- features -------------------------------------------------------------------------------------------------------

#: What is known of a token: strength, second person, letters, capitals, shouted, exclamation and question marks, signs,
#: doubled signs, disguised, strength as an undisguised word, drawn out.
_KNOWN = 12


class Tokens:
    """Remembers what the tokens of a task are, as rows of ``table``."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        #: First letters of the entries: most words have others.
        self.heads = {k[:4] for k in lexicon} | {k[:3] for k in lexicon if len(k) < 4 or k[3] == "*"}
        self.rows: dict[str, int] = {}
        self.table = np.empty((REMEMBERED, _KNOWN))

    def _strength(self, word: str) -> float:
        if len(word) < 2 or word[:4] not in self.heads and word[:3] not in self.heads:
            return 0.0
        return max(self.lexicon.get(k, 0.0) for k in keys_of(word))

    def of(self, tokens: np.ndarray) -> np.ndarray:
        """What is known of different tokens."""
        if len(tokens) > REMEMBERED:
            return np.concatenate([self.of(tokens[i:i + REMEMBERED]) for i in range(0, len(tokens), REMEMBERED)])
        rows = self.rows
        if len(rows) + len(tokens) > REMEMBERED:
            rows.clear()
        new = [t for t in tokens if t not in rows]
        if new:
            start = len(rows)
            self.table[start:start + len(new)] = [self._judge(t) for t in new]
            rows.update(zip(new, range(start, start + len(new))))
        return self.table[[rows[t] for t in tokens]]

    def _judge(self, token: str) -> tuple:
        lower, end, hidden = token.lower(), "", None
        if token.isalpha() and lower.isalpha():
            word, letters = lower, len(token)
        elif token[-1] in ".,;:!?" and token[:-1].isalpha() and lower[:-1].isalpha():
            word, letters, end = lower[:-1], len(token) - 1, token[-1]
        else:
            word, letters, hidden = plain(token), sum(map(str.isalpha, token)), undisguised(token)
        capitals = 0 if token == lower else int(token[0].isupper()) if token[1:] == lower[1:] else sum(map(str.isupper, token))
        known = (self._strength(word), word in SECOND, letters, capitals, letters >= 3 and capitals == letters)
        drawn_out = _LONG.search(word) is not None
        if len(word) == len(token) - len(end) and word.isalpha():
            return *known, end == "!", end == "?", end != "", False, False, 0.0, drawn_out
        signs = len(token) - sum(map(str.isalnum, token))
        doubled = signs > 1 and any(a == b and not a.isalnum() for a, b in zip(token, token[1:]))
        return (*known, token.count("!"), token.count("?"), signs, doubled, hidden is not None,
                self._strength(hidden) if hidden else 0.0, drawn_out)


def features(texts: list[str], tokens: Tokens) -> np.ndarray:
    """A row of ``FEATURES`` for each text."""
    split = [t.split() for t in texts]
    sizes = np.array([len(s) for s in split], dtype=np.int64)
    codes, different = pd.factorize(np.array([w for s in split for w in s], dtype=object))
    table = tokens.of(different)[codes].reshape(len(codes), _KNOWN)
    docs, n = np.repeat(np.arange(len(texts)), sizes), len(texts)

    def total(values: np.ndarray) -> np.ndarray:
        return np.bincount(docs, values, n)

    strength = np.maximum(table[:, 0], table[:, 10])
    words, chars = np.maximum(sizes, 1), np.maximum([len(t) for t in texts], 1)
    tiers = [strength >= s for s in STRENGTHS]
    weak, fair, strong = (total(t) for t in (tiers[0] & ~tiers[1], tiers[1] & ~tiers[2], tiers[2]))
    top = np.zeros((n, 3))
    hits = np.flatnonzero(tiers[0])
    order = hits[np.lexsort((-strength[hits], docs[hits]))]
    if len(order):
        rank = np.arange(len(order)) - np.searchsorted(docs[order], docs[order])
        first = rank < 3
        top[docs[order[first]], rank[first]] = strength[order[first]]
    near, nearest = np.zeros(n), np.full(n, 50.0)
    second, fairly = np.flatnonzero(table[:, 1] > 0), np.flatnonzero(tiers[1])
    if len(second) and len(fairly):
        after = np.searchsorted(second, fairly)
        gap = np.minimum(*(np.where(docs[second[side]] == docs[fairly], np.abs(second[side] - fairly), 50)
                           for side in (np.minimum(after, len(second) - 1), np.maximum(after - 1, 0))))
        np.minimum.at(nearest, docs[fairly], np.minimum(gap, 50))
        near = np.bincount(docs[fairly], gap <= NEAR, n)
    letters = np.maximum(total(table[:, 2]), 1)
    columns = [
        np.log1p(sizes), np.log1p(strong), np.log1p(fair), np.log1p(weak), strong / words, fair / words, weak / words,
        *top.T, total(strength) / words, near / words, nearest, total(table[:, 1]) / words, total(table[:, 3]) / letters,
        total(table[:, 4]) / words, total(table[:, 5]) / chars, total(table[:, 6]) / chars, total(table[:, 7]) / chars,
        total(table[:, 8]) / words, total(table[:, 9]) / words, total(table[:, 9] * (table[:, 10] >= STRENGTHS[1])) / words,
        total(table[:, 11]) / words]
    return np.stack(columns, axis=1)


def with_features(rows: DataFrame, known: list[Lexicon], choice: str | None = None) -> DataFrame:
    """``rows`` without ``text`` and with the array ``features``, by the lexicon of number ``choice`` (the first, if none)."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    # As small as the lexicon: see LEAST_SHARE.
    shared = rows.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens = [Tokens(lexicon) for lexicon in shared.value]
        for part in steps(batches, FEATURE_CHARS):
            for number, own in part.groupby(choice) if choice else [(0, part)]:
                yield own.drop(columns="text").assign(features=list(features(list(own["text"]), tokens[number])))

    return rows.mapInPandas(run, f"{schema}, features array<double>")


# ---- the model ------------------------------------------------------------------------------------------------------


def training_texts(docs: DataFrame, labels: DataFrame, training: Column, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """``(text, label, fold, part)``: the different texts of labelled rows where ``training`` holds, once each. A text is toxic
    if at least half of its rows are; an id with several labels has the greatest.

    Texts are known by 128 bits of hashes. Labels find them by narrow rows, and the texts move once, one of each task's copies.
    """
    one = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(
        F.col(id_col).alias("_id")).agg(F.max(F.col(label_col).cast("int")).alias("_label"))
    rows = docs.filter(training & F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("_id"), F.col(text_col).alias("text"), F.xxhash64(F.col(text_col)).alias("key"),
        F.xxhash64(F.lit(1), F.col(text_col)).alias("check"))
    judged = rows.select("_id", "key", "check").join(one.hint("merge"), "_id").groupBy("key", "check").agg(
        F.avg("_label").alias("share"))
    texts = rows.groupBy("key", "check").agg(F.first("text").alias("text"))
    return texts.join(judged.hint("merge"), ["key", "check"]).select(
        "text", (F.col("share") >= 0.5).cast("int").alias("label"), F.pmod("key", F.lit(2)).cast("int").alias("fold"),
        F.pmod(F.shiftright("key", 8), F.lit(4)).cast("int").alias("part"))


def fit(docs: DataFrame, labels: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic") -> Model:
    """Learn from the rows of ``docs`` where ``training`` holds and ``labels`` has a label of their id.

    Without toxic or without other texts there are no trees, and every score is the share of toxic ones (0 without texts).
    The lexicon, and at most ``BINS`` + 1 points of the calibration, reach the driver.
    """
    train = stored(training_texts(docs, labels, training, id_col, text_col, label_col))
    known = lexicons(train)
    vectors = stored(with_features(train.withColumn("other", 1 - F.col("fold")), known[:2], "other").select(
        array_to_vector("features").alias("features"), F.col("label").cast("double"), "part"))
    learnt, kept = vectors.filter("part > 0"), vectors.filter("part = 0")
    sizes = {(r["held"], r["label"]): r["n"] for r in vectors.groupBy((F.col("part") == 0).alias("held"), "label").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    toxic, rest = (sum(sizes.get((h, label), 0) for h in (True, False)) for label in (1.0, 0.0))
    if not (sizes.get((False, 1.0)) and sizes.get((False, 0.0))):
        return Model(known[2], None, None, toxic / max(1, toxic + rest))
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=7, minInstancesPerNode=3).fit(learnt)
    # Few texts calibrate better all together than a quarter of them without a toxic one.
    judged = trees.transform(kept if sizes.get((True, 1.0)) and sizes.get((True, 0.0)) else vectors)
    points = judged.groupBy(_bin(judged).alias("bin")).agg(F.avg("label").alias("label"), F.count(F.lit(1)).cast("double").alias("n"))
    isotonic = IsotonicRegression(featuresCol="bin", labelCol="label", weightCol="n", predictionCol="score").fit(points)
    return Model(known[2], trees, isotonic, toxic / (toxic + rest))


def _bin(judged: DataFrame) -> Column:
    return F.floor(vector_to_array(judged["probability"])[1] * BINS).cast("double")


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, score)``, one row per input row, without a shuffle: how likely a text is labelled toxic, from 0 to 1.

    A missing text counts as empty and is scored like any other; repeated rows and missing ids are rows like others. Only
    the two named columns are read.
    """
    rows = id_and_text(df, id_col, text_col)
    if model.trees is None:
        return with_id(rows.select("id", F.lit(model.base).alias("score")), df, id_col)
    made = with_features(rows, [model.lexicon]).select("id", array_to_vector("features").alias("features"))
    judged = model.trees.transform(made)
    found = model.calibration.transform(judged.withColumn("bin", _bin(judged)))
    return with_id(found.select("id", F.least(F.greatest("score", F.lit(0.0)), F.lit(1.0)).alias("score")), df, id_col)
