"""Every stage of the corpus pipeline against a plain version of its decision."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_jaccard import plain_set
from test_quality import brute_kept

import corpus_pipeline as pipeline
from tidegrid.llm import language, packing, quality, secrets
from tidegrid.llm.tokens import encoder

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = {"en": "the of and to in that is was for on with as his they be at one have this from".split(),
         "de": "der die und den von zu das mit sich des auf für ist im dem nicht ein eine als auch".split()}


def corpus():
    rng, rows = random.Random(12), []
    for i in range(90):
        lang = "en" if i % 3 else "de"
        rows.append([i, " ".join(rng.choices(WORDS[lang], k=rng.randrange(60, 140))), lang])
    for i, j in [(90, 3), (91, 3), (92, 7), (93, 8)]:  # copies, exact and with one word changed
        words = rows[j][1].split()
        words[len(words) // 2] = words[len(words) // 2] if i == 90 else "changed"
        rows.append([i, " ".join(words), rows[j][2]])
    rows += [[100, None, "en"], [101, "", None], [102, "12 $$ 34", "en"], [103, "the of and", "en"],
             [104, "the of and " * 60, "en"], [105, " ".join("".join(rng.choices("#$%QXZ@7", k=9)) for _ in range(80)), "en"],
             [None, rows[5][1] + " without id", "en"]]
    rows[10][1] += " password = abcdefghijkl0123 and 0123456789abcdef0123"
    out = [(i, t, lang, f"s{k % 3}", len(t or "")) for k, (i, t, lang) in enumerate(rows)]
    return out + [out[20]]


@pytest.fixture(scope="module")
def stages(spark):
    """The rows before and after each stage."""
    docs = spark.createDataFrame([(*r, "extra") for r in corpus()], SCHEMA + ", row_id string").repartition(4)
    out = []
    for name, stage in pipeline.STAGES:
        after = pipeline.stored(stage(spark, docs, ""))
        out.append((name, [tuple(r)[:5] for r in docs.collect()], after))
        docs = after
    return out


def key(row):
    return tuple((v is None, v or 0) if not isinstance(v, str) else (False, v) for v in row)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=key)


def test_columns(stages):
    assert [n for n, _, _ in stages] == ["language", "quality", "near_copies", "secrets", "packing"]
    for _, _, after in stages[:-1]:
        assert after.columns == pipeline.COLUMNS


def plain_mixture(text, tables, rounds):
    """Best language set by dictionaries and loops."""
    _, slots = language.trigrams([text])
    if not len(slots):
        return None
    p = [[table[s] for table in tables] for s in slots.tolist()]

    def run(allowed):
        share = [1 / len(allowed) if k in allowed else 0.0 for k in range(len(tables))]
        for _ in range(rounds):
            new = [0.0] * len(tables)
            for row in p:
                total = sum(a * b for a, b in zip(share, row))
                for k in range(len(tables)):
                    new[k] += share[k] * row[k] / total / len(p)
            share = new
        return share, sum(np.log(sum(a * b for a, b in zip(share, row))) for row in p)

    full, _ = run(range(len(tables)))
    order = sorted(range(len(tables)), key=lambda k: -full[k])
    options = []
    for k in range(len(tables)):
        options.append((sum(np.log(row[k]) for row in p), 1, [float(j == k) for j in range(len(tables))]))
    for size in range(2, len(tables) + 1):
        share, likelihood = run(order[:size])
        options.append((likelihood - 0.5 * (size - 1) * np.log(len(p)), size, share))
    return max(options, key=lambda o: o[0])[2]


def test_language_stage(stages):
    _, before, after = stages[0]
    counts = defaultdict(lambda: np.full(language.SLOTS, language.SMOOTH))
    for _, text, lang, _, _ in before:
        if text is not None and lang is not None:
            np.add.at(counts[lang], language.trigrams([text])[1], 1)
    tables = [(counts[lang] / counts[lang].sum()) for lang in sorted(counts)]
    kept = []
    for row in before:
        share = plain_mixture(row[1] or "", tables, language.ROUNDS)
        if share and max(share) >= pipeline.MIN_SCORE:
            kept.append(row)
    assert rows_of(after) == sorted(kept, key=key)
    assert {100, 101, 102}.isdisjoint(r[0] for r in kept)


def test_quality_stage(spark, stages):
    _, before, after = stages[1]
    kept = [row for row, stays in zip(before, brute_kept(spark, [(r[1], r[2]) for r in before])) if stays]
    assert rows_of(after) == sorted(kept, key=key)
    ids = {r[0] for r in kept}
    assert {103, 104, 105}.isdisjoint(ids) and {10, 90, 91, 92, 93, None} <= ids and len(kept) == len(before) - 3


def test_near_copy_stage(stages):
    _, before, after = stages[2]
    sets = [plain_set(r[1], 5) for r in before]
    label = list(range(len(before)))
    for x in range(len(before)):
        for y in range(x):
            common = len(sets[x] & sets[y])
            if 100 * common >= 80 * (len(sets[x]) + len(sets[y]) - common):
                label = [label[y] if v == label[x] else v for v in label]
    groups = defaultdict(list)
    for row, group in zip(before, label):
        groups[group].append(row)
    kept = [min(g, key=lambda r: (r[0] is None, r[0] or 0)) for g in groups.values()]
    assert rows_of(after) == sorted(kept, key=key)
    assert len(kept) < len(before) - 3 and {90, 91, 92, 93}.isdisjoint(r[0] for r in kept)


def test_secret_and_packing_stages(stages):
    _, before, after = stages[3]
    masked = rows_of(after)
    assert [r[0] for r in masked] == [r[0] for r in sorted(before, key=key)]
    for old, new in zip(sorted(before, key=key), masked):
        assert not [s for s in secrets.find_spans(new[1]) if s[1] < 3] and new[4] == len(new[1])
        assert new[1] == old[1] or "[SECRET]" in new[1]
    assert sum("[SECRET]" in r[1] for r in masked) == 1
    pieces = stages[4][2].toPandas()
    encode = encoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert sorted(pieces.groupby(pieces["doc_id"].fillna(-1))["length"].sum()) == sorted(
        len(encode(r[1])) + 1 for r in masked)
    assert pieces.groupby("sequence_id")["length"].sum().max() <= 2048 and hasattr(packing, "pack")


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in pipeline.STAGES:
        docs = pipeline.stored(stage(spark, docs, ""))
        assert docs.count() == 0


def test_stages_send_small_batches_to_the_workers(spark):
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    docs = spark.range(0, 3000, 1, 1).selectExpr("id AS doc_id", "repeat('word ', 1000) AS text")
    before = spark.conf.get(setting)

    def sizes(batches):
        for rows in batches:
            yield rows[["doc_id"]].head(1).assign(chars=rows["text"].str.len().sum())

    try:
        spark.conf.unset(setting)
        packed = pipeline.packing_stage(spark, docs, "")
        seen = [r["chars"] for r in docs.mapInPandas(sizes, "doc_id long, chars long").collect()]
        assert sum(seen) == 15_000_000 and max(seen) < 2 * pipeline.BATCH_BYTES
        whole = packed.groupBy("doc_id").agg(F.sum("length").alias("n"), F.first("doc_tokens").alias("of"))
        assert whole.count() == 3000 and whole.where("n != of").isEmpty()
        for _, stage in pipeline.STAGES:
            assert hasattr(stage, "__wrapped__")
    finally:
        spark.conf.set(setting, before)
