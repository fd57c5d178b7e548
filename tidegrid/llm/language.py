"""Language identification by mixtures of character n-gram models.

Every language has a multinomial over hashed character trigrams, counted on all labelled rows. A document is a mixture of
languages: expectation-maximisation estimates the proportions, and the set of languages is the one of greatest
likelihood less a penalty per language (half the logarithm of the number of n-grams, as the Bayesian criterion has it).
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.llm.batches import steps

#: Hash slots of the trigrams, pseudo-count of a slot, rounds of estimation.
SLOTS, SMOOTH, ROUNDS = 1 << 15, 0.5, 8
#: Larger language sets are tried until so many in a row have not been better.
PATIENCE = 2
#: Languages that a model may have; more labels than that are an error, since ``SLOTS`` numbers of each are collected.
MOST_LANGUAGES = 500
#: Languages a task counts before it hands the counts on.
HELD_LANGUAGES = 32
UNKNOWN = "und"


class Model(NamedTuple):
    """``log_p[l, slot]`` of each language, in the order of ``languages``."""

    languages: list[str]
    log_p: np.ndarray


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    out = np.zeros(sys.maxunicode + 1, dtype=bool)
    out[[c for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c))[0] == "L"]] = True
    return out


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Document number and slot of every trigram of the lower-cased texts, non-letters folded into single spaces."""
    lowered = [f"\n{t.lower()}\n" for t in texts]
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    docs = np.repeat(np.arange(len(texts)), [len(t) for t in lowered])
    letter = _letters()[codes]
    keep = letter.copy()
    keep[1:] |= letter[:-1] | (docs[1:] != docs[:-1])  # one space after a word, and one to begin with
    if len(keep):
        keep[0] = True
    codes, docs = np.where(letter, codes, 0)[keep], docs[keep]
    if len(codes) < 3:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    mixed = codes.astype(np.uint64)
    slot = (mixed[:-2] * np.uint64(0x9E3779B97F4A7C15) + mixed[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F)
            + mixed[2:] * np.uint64(0x165667B19E3779F9))
    slot = (slot ^ (slot >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(49)
    same = docs[:-2] == docs[2:]
    return docs[:-2][same], slot[same].astype(np.int64)


def fit(df: DataFrame, training: Column, text_col: str = "text", label_col: str = "lang") -> Model:
    """Count the trigrams of all rows where ``training`` holds and the label is there.

    Tasks add up their own rows; what meets is a count per language and slot, at most ``SLOTS`` per language, and no
    more is collected (of at most ``MOST_LANGUAGES`` labels; more are an error). Rows without text or label are not learnt from; no rows at all give a model without languages.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, np.ndarray] = {}

        def flush() -> Iterator[pd.DataFrame]:
            for label, counts in held.items():
                yield pd.DataFrame({"label": label, "slot": np.flatnonzero(counts), "n": counts[counts > 0]})
            held.clear()

        for rows in batches:
            for label, own in rows.groupby("label"):
                if label not in held and len(held) >= HELD_LANGUAGES:
                    yield from flush()
                counts = held.setdefault(label, np.zeros(SLOTS, dtype=np.int64))
                for part in steps([own]):
                    counts += np.bincount(trigrams(list(part["text"]))[1], minlength=SLOTS)
        yield from flush()

    rows = (df.filter(training & F.col(label_col).isNotNull() & F.col(text_col).isNotNull())
            .select(F.col(label_col).cast("string").alias("label"), F.col(text_col).alias("text")))
    if rows.select("label").distinct().limit(MOST_LANGUAGES + 1).count() > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} labels")
    counts = (rows.mapInPandas(count, "label string, slot bigint, n bigint")
              .groupBy("label", "slot").agg(F.sum("n").alias("n")).toPandas())
    languages = sorted(counts["label"].unique())
    table = np.full((len(languages), SLOTS), SMOOTH)
    table[counts["label"].map({x: i for i, x in enumerate(languages)}).to_numpy(dtype=np.int64),
          counts["slot"].to_numpy(dtype=np.int64)] += counts["n"].to_numpy(dtype=np.float64)
    return Model(languages, np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32))


def _estimate(p: np.ndarray, weight: np.ndarray, first: np.ndarray, row: np.ndarray, allowed: np.ndarray,
              total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions of the ``allowed`` languages of each document, and the log-likelihood of the mixture."""
    share = allowed / allowed.sum(axis=1, keepdims=True)
    for _ in range(ROUNDS):
        joint = p * share[row]
        joint *= (weight / joint.sum(axis=1))[:, None]
        share = np.add.reduceat(joint, first, axis=0) / total[:, None]
    mix = np.log((p * share[row]).sum(axis=1))
    return share, np.add.reduceat(mix * weight, first)


def mixtures(texts: list[str], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Proportions per text and language under the best language set, and the trigram count (0: nothing to go by)."""
    n_langs, shares = len(model.languages), np.zeros((len(texts), len(model.languages)))
    sizes = np.zeros(len(texts))
    docs, slots = trigrams(texts)
    if not len(docs) or not n_langs:
        return shares, sizes
    keys, counts = np.unique(docs * SLOTS + slots, return_counts=True)
    docs, slots = keys // SLOTS, keys % SLOTS
    present, first, row = np.unique(docs, return_index=True, return_inverse=True)
    weight = counts.astype(np.float64)
    total = np.add.reduceat(weight, first)
    log_p = model.log_p[:, slots].T.astype(np.float64)
    top = log_p.max(axis=1)  # likelihoods relative to the likeliest language of the trigram
    p, base = np.exp(log_p - top[:, None]), np.add.reduceat(top * weight, first)

    single = np.add.reduceat(log_p * weight[:, None], first, axis=0)
    best = np.argmax(single, axis=1)
    score = single[np.arange(len(present)), best]
    chosen = np.zeros((len(present), n_langs))
    chosen[np.arange(len(present)), best] = 1.0
    if n_langs > 1:
        full, _ = _estimate(p, weight, first, row, np.ones((len(present), n_langs)), total)
        ranked = np.argsort(-full, axis=1, kind="stable")
        open_docs, stalled = np.arange(len(present)), np.zeros(len(present), dtype=np.int64)
        for size in range(2, n_langs + 1):
            if not len(open_docs):
                break
            mine = np.isin(row, open_docs)
            own = np.searchsorted(open_docs, row[mine])
            allowed = np.zeros((len(open_docs), n_langs))
            np.put_along_axis(allowed, ranked[open_docs, :size], 1.0, axis=1)
            start = np.searchsorted(own, np.arange(len(open_docs)))
            share, likelihood = _estimate(p[mine], weight[mine], start, own, allowed, total[open_docs])
            penalised = likelihood + base[open_docs] - 0.5 * (size - 1) * np.log(total[open_docs])
            better = penalised > score[open_docs]
            chosen[open_docs[better]], score[open_docs] = share[better], np.maximum(score[open_docs], penalised)
            stalled[open_docs] = np.where(better, 0, stalled[open_docs] + 1)
            open_docs = open_docs[stalled[open_docs] < PATIENCE]
    shares[present], sizes[present] = chosen, total
    return shares, sizes


def predictor(spark: SparkSession, model: Model) -> Callable[[Column | str], Column]:
    """Function from a text column to ``struct<lang_pred, score, languages>``, see :func:`identify`."""
    shared = spark.sparkContext.broadcast(model)  # at most SLOTS numbers per language

    @F.pandas_udf("lang_pred string, score double, languages map<string,double>")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for batch in batches:
            yield pd.concat([_predict(part["text"], known) for part in steps([pd.DataFrame({"text": batch})])]
                            or [_predict(batch, known)])

    return lambda text: predict(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))


def _predict(texts: pd.Series, model: Model) -> pd.DataFrame:
    shares, sizes = mixtures(list(texts), model)
    some = bool(model.languages)
    best = shares.argmax(axis=1) if some else np.zeros(len(texts), dtype=np.int64)
    return pd.DataFrame({
        "lang_pred": [model.languages[b] if found else UNKNOWN for b, found in zip(best, sizes > 0)],
        "score": np.minimum(1.0, shares.max(axis=1)) if some else np.zeros(len(texts)),
        "languages": [{model.languages[i]: float(s[i]) for i in np.flatnonzero(s > 0)} for s in shares],
    }, index=texts.index)


def identify(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, lang_pred, score, languages)``, one row per input row, without a shuffle.

    ``languages`` maps the chosen languages to their proportions; the prediction is the largest (ties: the first by
    name) and ``score`` its proportion. A missing text, one without letters, or an empty model give ``und``, 0 and an
    empty map. Only the two named columns are read.
    """
    found = predictor(df.sparkSession, model)(text_col)
    return df.select(F.col(id_col), found.alias("found")).select(id_col, "found.*")
