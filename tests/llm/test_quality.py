"""Plain rules and the n-gram model against brute force over small texts."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import pytest

from tidegrid.llm import quality


def brute_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    marked = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(marked))


def random_text(rng, n):
    return "".join(rng.choices(["a", "bb", "cé", " ", " ", "\n", "\x0b", "\xa0", "#", "a b a ", "\x1c", "<>"], k=n))


def test_plain_counts_equal_brute_force():
    rng = random.Random(2)
    texts = ["", " ", "x", "a b a b a b a", "\n\na\n a\na"] + [random_text(rng, rng.randrange(60)) for _ in range(400)]
    got = [tuple(r) for r in quality.plain_counts(texts).itertuples(index=False)]
    assert got == [brute_counts(t) for t in texts]


class BruteModel:
    """Modified Kneser-Ney by dictionaries, straight from its definition."""

    def __init__(self, texts):
        count = Counter()
        for t in texts:
            padded = quality.START + t
            count.update(padded[i:i + 4] for i in range(len(t)))
        self.levels = {4: count}
        for k in (3, 2, 1):
            self.levels[k] = Counter(g[1:] for g in self.levels[k + 1])
        self.cuts, self.around = {}, {}
        for k, level in self.levels.items():
            of = Counter(level.values())
            cuts = []
            for j in (1, 2, 3):
                have = of[1] and of[j]
                d = j - (j + 1) * of[1] / (of[1] + 2 * of[2]) * of[j + 1] / of[j] if have else j / 2
                cuts.append(min(max(d, 0.05), j - 0.05))
            self.cuts[k] = cuts
            around = defaultdict(lambda: [0, 0.0])
            for g, n in level.items():
                around[g[:-1]][0] += n
                around[g[:-1]][1] += cuts[min(n, 3) - 1]
            self.around[k] = around

    def p(self, gram):
        k = len(gram)
        if k == 0:
            return 1 / quality.SYMBOLS
        below, n = self.p(gram[1:]), self.levels[k][gram]
        if gram[:-1] not in self.around[k]:
            return below
        total, freed = self.around[k][gram[:-1]]
        return ((n - self.cuts[k][min(n, 3) - 1] if n else 0) + freed * below) / total


@pytest.fixture
def texts():
    rng = random.Random(4)
    return [("".join(rng.choices("abcde \né", weights=[9, 7, 5, 3, 2, 6, 1, 1], k=rng.randrange(5, 400)))) for _ in range(60)]


def folds(spark, rows):
    """The fold of each ``(text, language)``."""
    df = spark.createDataFrame([(0, t, lang) for t, lang in rows], "doc_id bigint, text string, lang string")
    found = quality.with_fold(quality.with_language(df, "doc_id", "text", "lang")).collect()
    return {(r.text, r.lang): r.fold for r in found}


def brute_scores(spark, rows):
    """``(log_ppl, words, word_ppl)`` of each ``(text, language)``, by the texts of the other fold of its language."""
    fold = folds(spark, rows)
    pairs = sorted(fold)
    models = {(lang, f): BruteModel([t for t, x in pairs if x == lang and fold[t, x] != f]) for _, lang in pairs for f in "01"}
    out = {}
    for text, lang in pairs:
        padded = quality.START + text
        costs = [-math.log(models[lang, fold[text, lang]].p(padded[j:j + 4])) for j in range(len(text))]
        words, early = [], 0.0
        for m in re.finditer(r"[^\x20\x09-\x0D]+", text):
            cost = sum(costs[m.start():m.end() + 1])
            if any(c.isalnum() for c in m.group()):
                words.append(cost + early)
                early = 0.0
            elif words:
                words[-1] += cost
            else:
                early += cost
        kept = sorted(words)[:len(words) - len(words) // 10]
        out[text, lang] = (sum(costs) / len(text) if text else None, len(words), sum(kept) / len(kept) if kept else None)
    return out


def brute_kept(spark, rows, below=3.0, above=5.0):
    """Whether each ``(text, language)`` is kept, by loops over the whole definition."""
    rows = [(t or "", quality.UNKNOWN if lang is None else lang) for t, lang in rows]
    scores = brute_scores(spark, rows)
    failed = {}
    for text, lang in scores:
        n_words, _, _, _, repeated = brute_counts(text)
        failed[text, lang] = n_words < 50 or 100 * repeated > 50 * n_words

    def quantile(values, share):
        bins = sorted(math.floor(v * quality.GRAIN) for v in values)
        return next(b for k, b in enumerate(bins) if (k + 1) / len(bins) >= share) / quality.GRAIN

    kept = {}
    for lang in {x for _, x in scores}:
        good = [(t, n, w) for (t, x), (_, n, w) in scores.items() if x == lang and not failed[t, x] and n]
        if not good:
            continue
        middle = quantile([w for *_, w in good], 0.5)
        far = {t: (w - middle) * math.sqrt(n / (n + quality.SHORT_WORDS)) for t, n, w in good}
        q1, q3 = (quantile(far.values(), q) for q in (0.25, 0.75))
        gap = max(q3 - q1, quality.LEAST_GAP)
        kept |= {(t, lang): q1 - below * gap <= d <= q3 + above * gap + 1 / quality.GRAIN for t, d in far.items()}
    return [kept.get(row, False) for row in rows]


@pytest.mark.parametrize("held", [4_000_000, 0])
def test_scores_and_verdicts_equal_brute_force(spark, texts, monkeypatch, held):
    monkeypatch.setattr(quality, "BLOCK_CHARS", 1500)
    monkeypatch.setattr(quality, "HELD_GRAMS", held)
    rng = random.Random(14)
    long = [" ".join("".join(rng.choices("abcdeé", k=rng.randrange(1, 6))) for _ in range(rng.randrange(55, 120))) for _ in range(40)]
    odd = [" ".join("".join(rng.choices("uvwxyzUVWXYZ0123", k=30)) for _ in range(60)) for _ in range(2)]
    rows = [(i, t, "x" if i % 3 else None) for i, t in enumerate([*texts, *long, *odd, "", "** ** a **", "**", None])]
    rows += [(1000 + i, long[2], rows[62][2]) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(5)
    got = {r.doc_id: (r.log_ppl, r.word_ppl, r.kept) for r in quality.assess(df).collect()}
    plain = [(t or "", lang or quality.UNKNOWN) for _, t, lang in rows]
    want, kept = brute_scores(spark, plain), brute_kept(spark, plain)
    for (i, _, _), row, stays in zip(rows, plain, kept):
        for value, plainly in zip(got[i][:2], want[row][::2]):
            assert plainly is None and (value is None or math.isnan(value)) or value == pytest.approx(plainly, rel=1e-9)
        assert got[i][2] == stays
    assert 20 < sum(kept) and not any(kept[100:102])


def test_unseen_ngrams_back_off(spark, texts):
    fit = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id bigint, text string, lang string")
    counts = quality.count_ngrams(quality.with_language(fit, "doc_id", "text", "lang"))
    other = spark.createDataFrame([(1, "abzzé aaa", "x"), (2, "abc", "y")], "doc_id bigint, text string, lang string")
    wanted = quality.count_ngrams(quality.with_language(other, "doc_id", "text", "lang"))
    model = BruteModel(texts)
    rows = quality.probabilities(quality.count_levels(counts), wanted).collect()
    assert len(rows) == 9 + 3
    for r in rows:
        gram = "".join(chr((r.gram >> (16 * k)) & 0xFFFF) for k in (3, 2, 1, 0))
        assert r.p == pytest.approx(model.p(gram) if r.lang == "x" else 1 / quality.SYMBOLS, rel=1e-9)


def test_verdicts_and_edges(spark):
    rng = random.Random(8)
    words = ["the", "cat", "sat", "on", "many", "mats", "while", "dogs", "ran", "home", "again", "today"]
    good = [" ".join(rng.choices(words, k=80)) for _ in range(60)]
    odd = " ".join("".join(rng.choices("QXZ#$%&*|<>!?0123456789", k=6)) for _ in range(80))
    rows = [(i, t, "en", 0) for i, t in enumerate(good)] + [
        (100, odd, "en", 0), (101, "the cat " * 100, "en", 0), (102, None, "en", 0), (103, "", None, 0),
        (None, good[0], "en", 0), (7, good[7], "en", 0)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, n_words int")
    got = quality.assess(df).toPandas()
    assert len(got) == len(rows) and got["doc_id"].isna().sum() == 1
    by = got.dropna(subset="doc_id").drop_duplicates("doc_id").set_index("doc_id")
    assert by.loc[range(60), "kept"].all() and not by.loc[[100, 101, 102, 103], "kept"].any()
    assert not by.loc[100, "base_failed"] and by.loc[[101, 102, 103], "base_failed"].all()
    assert quality.assess(df.limit(0)).collect() == []


@pytest.mark.parametrize("held", [4_000_000, 0])
def test_copies_of_a_text_do_not_move_the_band(spark, monkeypatch, held):
    monkeypatch.setattr(quality, "HELD_GRAMS", held)
    rng = random.Random(18)
    words = ["the", "cat", "sat", "on", "many", "mats", "while", "dogs", "ran", "home", "again", "today"]
    rows = [(i, " ".join(rng.choices(words, k=80)), "en") for i in range(80)]
    rows += [(100 + i, " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(80)), "en")
             for i in range(4)]
    copies = [(1000 + i, rows[3][1], "en") for i in range(42)]  # a third of all rows

    def judged(some):
        df = spark.createDataFrame(some, "doc_id bigint, text string, lang string").repartition(4)
        return {r.doc_id: (r.log_ppl, r.kept) for r in quality.assess(df).collect()}

    alone, crowded = judged(rows), judged(rows + copies)
    assert {i: kept for i, (_, kept) in alone.items()} == {i: i < 100 for i, *_ in rows}
    for i, (ppl, kept) in alone.items():
        assert crowded[i] == (pytest.approx(ppl, rel=1e-9), kept)
    assert {crowded[i] for i, *_ in copies} == {crowded[3]}


def test_word_costs_equal_brute_force(texts):
    rng = random.Random(28)
    texts = [*texts, "", " \n ", " *** ", "a", "** lead  and\x0btail ", "\U00010020 x\xa0y", "*", "b * c", "**"]
    logs = [[-rng.random() for _ in t] for t in texts]
    docs, costs = quality.word_costs(texts, quality.np.array([x for t in logs for x in t]))
    sizes, means = quality.trimmed_means(docs, costs, len(texts))
    for i, (text, own) in enumerate(zip(texts, logs)):
        words, early = [], 0.0
        for m in re.finditer(r"[^\x20\x09-\x0D]+", text):
            cost = -sum(own[m.start():m.end() + 1])
            if any(c.isalnum() for c in m.group()):
                words.append(cost + early)
                early = 0.0
            elif words:
                words[-1] += cost
            else:
                early += cost
        assert costs[docs == i] == pytest.approx(words) and sizes[i] == len(words)
        kept = sorted(words)[:len(words) - len(words) // quality.TRIMMED]
        assert means[i] == pytest.approx(sum(kept) / len(kept)) if kept else math.isnan(means[i])


def test_runs_count_like_one_sort():
    rng = quality.np.random.default_rng(1)
    runs, parts = quality.Runs(), [rng.integers(0, 50, size=rng.integers(0, 80)) for _ in range(60)]
    for part in parts:
        runs.add(part)
        assert all(len(a[0]) >= 2 * len(b[0]) for a, b in zip(runs.runs, runs.runs[1:]))
    codes, counts = runs.total()
    want = quality.np.unique(quality.np.concatenate(parts), return_counts=True)
    assert codes.tolist() == want[0].tolist() and counts.tolist() == want[1].tolist()
    assert quality.Runs().total()[0].tolist() == []


def test_text_of_the_commonest_words_is_rejected(spark):
    """The lower limit: text that says nothing."""
    rng = random.Random(48)
    common = ["the", "of", "and", "to", "in", "that", "is", "was", "for", "on", "with", "as"]
    rare = ["".join(rng.choices(["th", "er", "on", "an", "re", "he", "in", "ed", "nd"], k=rng.randrange(2, 5))) for _ in range(300)]
    good = [" ".join(rng.choice(common) if rng.random() < 0.5 else rng.choice(rare) for _ in range(rng.randrange(80, 200))) for _ in range(120)]
    empty = [" ".join(rng.choices(common, k=rng.randrange(80, 200))) for _ in range(5)]
    rows = [(i, t, "en") for i, t in enumerate(good + empty)]
    kept = {r.doc_id: (r.base_failed, r.kept) for r in quality.assess(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect()}
    assert not any(failed for failed, _ in kept.values())
    assert not any(kept[i][1] for i in range(120, 125)) and sum(kept[i][1] for i in range(120)) >= 119


def test_secret_does_not_decide(spark):
    rng = random.Random(58)
    words = ["the", "cat", "sat", "on", "many", "mats", "while", "dogs", "ran", "home", "again", "today"]
    good = [" ".join(rng.choices(words, k=rng.randrange(55, 120))) for _ in range(90)]
    rows = [(i, t + (" token = 9fK2xQ7bLm0ZpR4tVw8s deadbeef0123456789" if i % 9 == 0 else ""), "en") for i, t in enumerate(good)]
    kept = [r.kept for r in quality.assess(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect()]
    assert all(kept)


@pytest.mark.parametrize("held", [4_000_000, 0])
def test_noise_of_easy_characters_is_rejected(spark, monkeypatch, held):
    monkeypatch.setattr(quality, "HELD_GRAMS", held)
    rng = random.Random(38)
    common = ["the", "of", "and", "to", "in", "that", "is", "was", "for", "on", "with", "as"]
    rare = ["".join(rng.choices(["th", "er", "on", "an", "re", "he", "in", "ed", "nd"], k=rng.randrange(2, 5))) for _ in range(300)]

    def words():
        return [rng.choice(common) if rng.random() < 0.6 else rng.choice(rare) for _ in range(rng.randrange(80, 200))]

    good = [" ".join(words()) for _ in range(150)]
    noise = [" ".join(w + rng.choice(["***", "%%%", "$$$", "###"]) for w in words()) for _ in range(12)]
    tables = [" | ".join("".join(rng.choices(["th", "er", "on", "an", "re"], k=6)) for _ in range(60)) for _ in range(6)]
    rows = [(i, t, "en") for i, t in enumerate(good + noise + tables)]
    kept = {r.doc_id: r.kept for r in quality.assess(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect()}
    assert not any(kept[i] for i in range(150, 168)) and sum(kept[i] for i in range(150)) >= 148
