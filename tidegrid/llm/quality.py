"""Quality rules: plain counts per document, and perplexity bands per language under a modified Kneser-Ney model.

The model is of order four over characters. Spark counts its n-grams over all documents: each task adds up its own in
sorted arrays, the counts meet by n-gram, and every order is a handful of grouped tables. Scoring looks the n-grams of a
text up in sorted arrays of n-gram codes by binary search. A model of at most ``HELD_GRAMS`` n-grams is sent to the tasks as
such arrays; with a larger one, documents are dealt to blocks, and each block gets the n-grams that it has.

Copies of a text count once, in the model and in the quartiles. Texts are dealt into two folds by their hash; a text is
judged by the model of the other fold, which has seen neither the text nor its copies.

What a band judges is the log-perplexity per word: characters of noise are cheap one by one (a fifth asterisk follows
four), but the words that they make are not. A word costs what its characters and the white space after it cost. The tenth
of a text's words that cost most is left out, so that a secret, a name or a number does not decide, and the band is wider for
short texts, whose means spread more.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.llm.batches import id_and_text, small_side, steps, with_id
from tidegrid.session import discard, stored

ORDER, BITS = 4, 16
#: What stands before the first character of a document.
START = "\x02" * (ORDER - 1)
#: N-grams that a task may hold at once: 16 bytes each. A larger model is dealt to blocks of so many characters.
HELD_GRAMS, BLOCK_CHARS = 4_000_000, 16_000_000
#: N-grams that a task counts before it hands them on, and characters that it scores in one step.
COUNTED_GRAMS, SCORED_CHARS = 1_000_000, 400_000
#: Arrays that a language of such a model is collected in.
SLOTS = 8
#: Symbols a character can be: code points are folded to ``BITS`` bits.
SYMBOLS = 1 << BITS
#: Steps of a log-perplexity whose quartiles make the bands, and least distance of the quartiles.
GRAIN, LEAST_GAP = 1000, 0.02
UNKNOWN = "und"
#: A model is named by the fold that it judges, which is the one that it has not seen; the name precedes the language.
FOLDS = ("0", "1")
#: Words left out of a score: one in so many, those that cost most.
TRIMMED = 10
#: Words at which a band is as wide again, in variance, as that of an endless text.
SHORT_WORDS = 100
#: Slots (a power of two) of the table that finds most n-grams without a search.
TABLE = 1 << 20
#: Hash values of texts fall into so many slots (a power of two); a slot with copies is one bit of 1 MB in every task.
COPY_SLOTS, BITMAP = 1 << 23, 1 << 15

# Fixed values of the plain rules.
SYMBOL_CHARS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
_WHITE = re.compile(r"[\x20\x09-\x0D]")


# ---- plain counts -------------------------------------------------------------------------------------------------


def repeated_words(words: list[list[bytes]]) -> np.ndarray:
    """Per text, the words inside three-word windows that the text has at least twice."""
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    out = np.zeros(len(words), dtype=np.int64)
    if sizes.sum() < 3:
        return out
    ids = pd.factorize(np.array([w for text in words for w in text], dtype=object))[0].astype(np.int64)
    docs = np.repeat(np.arange(len(words)), sizes)
    pairs = pd.factorize(ids[:-1] * (ids.max() + 1) + ids[1:])[0].astype(np.int64)
    triples = pd.factorize(pairs[:-1] * (ids.max() + 1) + ids[2:])[0].astype(np.int64)
    inside = np.flatnonzero(docs[:-2] == docs[2:])
    if not len(inside):
        return out
    _, which, times = np.unique(docs[inside] * (triples.max() + 1) + triples[inside], return_inverse=True,
                                return_counts=True)
    again = inside[times[which] > 1]
    marked = np.zeros(len(ids), dtype=bool)
    for k in range(3):
        marked[again + k] = True
    return np.bincount(docs[marked], minlength=len(words))


def _repeated_lines(text: str) -> int:
    seen, n = set(), 0
    for line in text.split("\n"):
        if line in seen:
            n += 1
        elif line.encode().split():
            seen.add(line)
    return n


def plain_counts(texts: list[str]) -> pd.DataFrame:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` of each text."""
    words = [t.encode().split() for t in texts]  # bytes split at exactly these six white-space characters
    return pd.DataFrame({
        "n_words": [len(w) for w in words],
        "word_chars": [len(t) - len(_WHITE.findall(t)) for t in texts],
        "n_symbols": [sum(t.count(c) for c in SYMBOL_CHARS) for t in texts],
        "n_dup_lines": [_repeated_lines(t) for t in texts],
        "n_repeat_words": repeated_words(words),
    }, dtype=np.int64)


# ---- the model ----------------------------------------------------------------------------------------------------


def ngram_codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Text number and packed n-gram that ends at every character."""
    padded = [START + t for t in texts]
    sizes = np.array([len(t) for t in padded], dtype=np.int64)
    symbols = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    symbols = (symbols & (SYMBOLS - 1)).astype(np.uint64)
    docs = np.repeat(np.arange(len(texts)), sizes)
    if len(symbols) < ORDER:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    codes = np.zeros(len(symbols) - ORDER + 1, dtype=np.uint64)
    for k in range(ORDER):
        codes = (codes << np.uint64(BITS)) | symbols[k:len(codes) + k]
    same = docs[:-ORDER + 1] == docs[ORDER - 1:]
    return docs[:-ORDER + 1][same], codes[same].view(np.int64)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether each code point is a letter or digit."""
    return np.array([chr(c).isalnum() for c in range(0x110000)])


def word_costs(texts: list[str], logs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text number and cost of each word that has a letter or digit, from the logarithm of each character's probability.

    White space is that of :func:`plain_counts`. The first white space after a word belongs to it, and so do words without
    letters or digits that follow it (or, at the beginning of a text, precede it); further white space costs nothing.
    """
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    docs = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    inside = (points != 0x20) & ((points < 0x09) | (points > 0x0D))
    follows = np.zeros(len(points), dtype=bool)
    follows[1:] = inside[:-1] & (docs[1:] == docs[:-1])
    starts = np.flatnonzero(inside & ~follows)
    if not len(starts):
        return np.empty(0, dtype=np.int64), np.empty(0)
    named = np.add.reduceat(inside & _letters()[points], starts, dtype=np.int64) > 0
    costs = -np.add.reduceat(np.where(inside | follows, logs, 0.0), starts)
    # Words without letters join the named one before, or the first one of their text.
    owner, of = np.cumsum(named) - 1, docs[starts]
    kept = np.flatnonzero(named)
    if not len(kept):
        return np.empty(0, dtype=np.int64), np.empty(0)
    before = (owner < 0) | (of[kept[np.maximum(owner, 0)]] != of)
    owner = np.minimum(np.where(before, owner + 1, owner), len(kept) - 1)
    own = of[kept[owner]] == of  # a text without any such word has none to add to
    return of[kept], np.bincount(owner[own], costs[own], len(kept))


def trimmed_means(docs: np.ndarray, costs: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of words of each of ``n`` texts, and the mean of their costs without the most expensive tenth."""
    sizes = np.bincount(docs, minlength=n)
    order = np.lexsort((costs, docs))
    rank = np.arange(len(docs)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    kept = rank < np.repeat(sizes - sizes // TRIMMED, sizes)
    some = order[kept]
    total = np.bincount(docs[some], costs[some], n)
    return sizes, np.where(sizes > 0, total / np.maximum(sizes - sizes // TRIMMED, 1), np.nan)


class Runs:
    """Counts of n-grams in sorted runs, each at least twice as long as the next: an n-gram is merged about log n times."""

    def __init__(self):
        self.runs: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, codes: np.ndarray) -> None:
        self.runs.append(np.unique(codes, return_counts=True))
        while len(self.runs) > 1 and len(self.runs[-2][0]) < 2 * len(self.runs[-1][0]):
            self._merge()

    def _merge(self) -> None:
        (a, n), (b, m) = self.runs.pop(), self.runs.pop()
        codes, counts = np.concatenate([a, b]), np.concatenate([n, m])
        order = np.argsort(codes, kind="stable")  # merges two sorted runs
        codes, counts = codes[order], counts[order]
        first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.empty(0, dtype=np.int64)
        self.runs.append((codes[first], np.add.reduceat(counts, first) if len(first) else counts))

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        while len(self.runs) > 1:
            self._merge()
        return self.runs[0] if self.runs else (np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64))

    def __len__(self) -> int:
        return sum(len(codes) for codes, _ in self.runs)


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The n-grams of a task's rows per language; handed on whenever they are many."""
    held: dict[str, Runs] = {}

    def flush() -> Iterator[pd.DataFrame]:
        while held:
            lang, runs = held.popitem()
            grams, n = runs.total()
            for start in range(0, len(grams), 100_000):
                yield pd.DataFrame({"lang": lang, "gram": grams[start:start + 100_000], "n": n[start:start + 100_000]})

    for rows in steps(batches):
        for lang, own in rows.groupby("lang"):
            held.setdefault(lang, Runs()).add(ngram_codes(list(own["text"]))[1])
        if sum(map(len, held.values())) > COUNTED_GRAMS:
            yield from flush()
    yield from flush()


def with_language(df: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """``(id, text, lang)``: a missing text counts as empty, a missing language is one of its own."""
    return id_and_text(df, id_col, text_col, lang=F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)))


def with_fold(rows: DataFrame) -> DataFrame:
    """``rows`` with ``key``, the same for the copies of a text in a language, and its ``fold``."""
    key = F.xxhash64("lang", "text")
    return rows.withColumn("key", key).withColumn("fold", F.pmod(F.shiftright(key, 40), F.lit(len(FOLDS))).cast("string"))


def slots_with_copies(rows: DataFrame) -> np.ndarray:
    """One bit for each of ``COPY_SLOTS``: whether a key of the slot has more than one row."""
    slot = F.pmod("key", F.lit(COPY_SLOTS))
    copied = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(slot.alias("slot"))
    found = (copied.groupBy(F.floor(F.col("slot") / BITMAP).alias("part"))
             .agg(F.bitmap_construct_agg(F.col("slot") % BITMAP).alias("bits")))
    out = np.zeros(COPY_SLOTS // 8, dtype=np.uint8)
    for r in found.toLocalIterator():
        out[r["part"] * BITMAP // 8:][:BITMAP // 8] = np.frombuffer(r["bits"], dtype=np.uint8)
    return out


def _once(batches: Iterator[pd.DataFrame], bits: np.ndarray, copied: bool) -> Iterator[pd.DataFrame]:
    """The rows in slots without copies, or of those in slots with copies one per key and task."""
    seen: set[int] = set()
    for rows in batches:
        slot = rows["key"].to_numpy() & (COPY_SLOTS - 1)
        rows = rows[(((bits[slot >> 3] >> (slot & 7)) & 1) == 1) == copied]
        if copied:
            rows = rows[~rows["key"].duplicated() & ~rows["key"].isin(seen)]
            seen.update(rows["key"].tolist())
        yield rows


def count_texts(rows: DataFrame) -> DataFrame:
    """``(lang, gram, n)`` over one row of each text of :func:`with_fold`, with the fold before the language; written out.

    Only the texts in slots with copies move, one of each task.
    """
    bits = rows.sparkSession.sparkContext.broadcast(slots_with_copies(rows))
    named = rows.select("key", F.concat("fold", "lang").alias("lang"), "text")
    single = named.mapInPandas(lambda batches: _count(_once(batches, bits.value, False)), "lang string, gram bigint, n bigint")
    copies = named.mapInPandas(lambda batches: _once(batches, bits.value, True), named.schema).dropDuplicates(["key"])
    counts = single.unionByName(count_ngrams(copies))
    out = stored(counts.groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    bits.destroy()
    return out


def _of_other_fold(counts: DataFrame) -> DataFrame:
    """Counts under the name of the model that is made of them."""
    fold = F.translate(F.substring("lang", 1, 1), "".join(FOLDS), "".join(reversed(FOLDS)))
    return counts.withColumn("lang", F.concat(fold, F.expr("substring(lang, 2)")))


def count_ngrams(rows: DataFrame) -> DataFrame:
    """``(lang, gram, n)`` over the rows of :func:`with_language`, a row for each task that has the n-gram."""
    return rows.select("lang", "text").mapInPandas(_count, "lang string, gram bigint, n bigint")


def _last(code: str, order: int) -> Column:
    """The last ``order`` symbols of an n-gram."""
    return F.col(code).bitwiseAND(F.lit((1 << (BITS * order)) - 1))


def _before(code: str, order: int) -> Column:
    """All but the last symbol of an n-gram of ``order``."""
    kept = F.shiftrightunsigned(F.col(code), BITS)
    return kept if order == ORDER else kept.bitwiseAND(F.lit((1 << (BITS * (order - 1))) - 1))


def count_levels(counts: DataFrame) -> dict[int, DataFrame]:
    """``(lang, gram, n)`` by order: occurrences at the highest, distinct predecessors below."""
    levels = {ORDER: counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))}
    for order in range(ORDER - 1, 0, -1):
        levels[order] = (levels[order + 1].groupBy("lang", _last("gram", order).alias("gram"))
                         .agg(F.count(F.lit(1)).alias("n")))
    return levels


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b)


def discounts(level: DataFrame) -> DataFrame:
    """``(lang, d1, d2, d3)``: what counts of one, two and more give up, from how many n-grams have counts one to four.

    Where a count of counts is zero, the discount is half the count; none takes a whole count.
    """
    n = [F.count_if(F.col("n") == k).cast("double").alias(f"n{k}") for k in (1, 2, 3, 4)]
    share = F.when(F.col("n1") > 0, F.col("n1") / (F.col("n1") + 2 * F.col("n2")))
    cuts = [F.coalesce(k - (k + 1) * share * _ratio(F.col(f"n{k + 1}"), F.col(f"n{k}")), F.lit(k / 2)) for k in (1, 2, 3)]
    return (level.groupBy("lang").agg(*n)
            .select("lang", *[F.least(F.greatest(c, F.lit(0.05)), F.lit(k - 0.05)).alias(f"d{k}")
                              for k, c in zip((1, 2, 3), cuts)]))


def _discount() -> Column:
    return F.when(F.col("n") >= 3, F.col("d3")).when(F.col("n") == 2, F.col("d2")).when(F.col("n") == 1, F.col("d1"))


def probabilities(levels: dict[int, DataFrame], wanted: DataFrame) -> DataFrame:
    """``(lang, gram, p)`` of the distinct ``(lang, gram)`` of ``wanted``, which the counts may or may not have.

    A language without any counts spreads its probability evenly.
    """
    needs = {ORDER: wanted.select("lang", "gram").distinct()}
    for order in range(ORDER - 1, 0, -1):
        needs[order] = needs[order + 1].select("lang", _last("gram", order).alias("gram")).distinct()
    cuts = small_side(reduce(DataFrame.unionByName, [
        discounts(level).withColumn("order", F.lit(order)) for order, level in levels.items()]))
    lower = None
    for order in range(1, ORDER + 1):
        cut = levels[order].join(cuts.filter(F.col("order") == order).drop("order"), "lang")
        context = _before("gram", order) if order > 1 else F.lit(0).cast("bigint")
        seen = cut.select("lang", "gram", (F.col("n") - _discount()).alias("kept"))
        around = (cut.groupBy("lang", context.alias("context"))
                  .agg(F.sum("n").alias("total"), F.sum(_discount()).alias("freed")))
        found = (needs[order].withColumn("context", context).join(seen, ["lang", "gram"], "left")
                 .join(around, ["lang", "context"], "left"))
        if lower is None:
            found = found.withColumn("below", F.lit(1.0 / SYMBOLS))
        else:
            found = found.withColumn("tail", _last("gram", order - 1)).join(
                lower.select("lang", F.col("gram").alias("tail"), F.col("p").alias("below")), ["lang", "tail"])
        own = F.coalesce(F.col("kept"), F.lit(0.0))
        lower = found.select("lang", "gram", F.when(
            F.col("total").isNull(), F.col("below")).otherwise((own + F.col("freed") * F.col("below")) / F.col("total"))
            .alias("p"))
    return lower


#: Sorted n-grams and the logarithms of their probabilities, by model name and language.
Arrays = dict[str, tuple[np.ndarray, np.ndarray]]
_SCORED = ("id string, lang string, key bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
           "n_repeat_words bigint, log_ppl double, judged_words bigint, word_ppl double")


def _arrays(model: pd.DataFrame) -> Arrays:
    out = {}
    for lang, own in model.groupby("lang"):
        order = np.argsort(own["gram"].to_numpy())
        out[lang] = own["gram"].to_numpy()[order], np.log(own["p"].to_numpy()[order])
    return out


class Models:
    """Models of a task, with a hash table of the n-grams of the one in use in front of the binary search."""

    def __init__(self, arrays: Arrays):
        self.arrays, self.tables = arrays, {}

    def logs(self, name: str, codes: np.ndarray) -> np.ndarray:
        """The logarithms of n-grams, each of which the model has."""
        grams, logs = self.arrays[name]
        if name not in self.tables:
            self.tables[name] = np.zeros(TABLE, dtype=np.int32)
            self.tables[name][_slot(grams)] = np.arange(len(grams), dtype=np.int32)
        where = self.tables[name][_slot(codes)]
        other = np.flatnonzero(grams[where] != codes)
        where[other] = np.searchsorted(grams, codes[other])
        return logs[where]


def _slot(codes: np.ndarray) -> np.ndarray:
    return ((codes.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - TABLE.bit_length() + 1)).view(np.int64)


def _score(rows: pd.DataFrame, models: Models) -> pd.DataFrame:
    """Plain counts and the log-perplexities per character and per word by the model of the other fold."""
    out = []
    for (lang, fold), own in rows.groupby(["lang", "fold"]):
        texts = list(own["text"])
        docs, codes = ngram_codes(texts)
        size = np.bincount(docs, minlength=len(texts))
        logs = models.logs(fold + lang, codes) if len(codes) else np.empty(0)
        mean = np.where(size > 0, -np.bincount(docs, logs, len(texts)) / np.maximum(size, 1), np.nan)
        judged, word_ppl = trimmed_means(*word_costs(texts, logs), len(texts))
        out.append(plain_counts(texts).assign(id=list(own["id"]), lang=lang, key=own["key"].to_numpy(), log_ppl=mean,
                                              judged_words=judged, word_ppl=word_ppl))
    return pd.concat(out)[[c.split()[0] for c in _SCORED.split(", ")]]


def sorted_arrays(model: DataFrame) -> DataFrame:
    """``(lang, grams, logs)``: the models as sorted arrays of n-gram codes and logarithms, some to a name and language."""

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        (lang, (grams, logs)), = _arrays(rows).items()
        return pd.DataFrame({"lang": [lang], "grams": [grams.tobytes()], "logs": [logs.tobytes()]})

    slot = F.pmod(F.xxhash64("gram"), F.lit(SLOTS)).alias("slot")
    return model.groupBy("lang", slot).applyInPandas(pack, "lang string, grams binary, logs binary")


def score_with_held_model(rows: DataFrame, model: DataFrame) -> DataFrame:
    """The columns of ``_SCORED`` (log-perplexities are missing for empty texts), with all models in every task; written out."""
    parts: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    for r in sorted_arrays(model).toLocalIterator():
        parts.setdefault(r["lang"], []).append((np.frombuffer(r["grams"], dtype=np.int64), np.frombuffer(r["logs"])))
    held = {}
    while parts:
        lang, some = parts.popitem()
        grams = np.concatenate([g for g, _ in some])
        order = np.argsort(grams)
        held[lang] = grams[order], np.concatenate([p for _, p in some])[order]
    shared = rows.sparkSession.sparkContext.broadcast(held)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        models = Models(shared.value)
        for part in steps(batches, SCORED_CHARS):
            yield _score(part, models)

    out = stored(rows.mapInPandas(run, _SCORED))
    shared.destroy()
    return out


def score_in_blocks(rows: DataFrame, model: DataFrame) -> DataFrame:
    """The same, with rows dealt by their hash into as many blocks as their characters need, and to each block what it has
    of the model. Rows that are equal but for their number in the task are told apart by it, so copies spread."""
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    copy = F.monotonically_increasing_id() % 4096
    blocks = rows.withColumn("block", F.pmod(F.xxhash64("id", "text", copy), F.lit(chars // BLOCK_CHARS + 1)))
    blocks = stored(blocks)

    def grams_of(block: pd.DataFrame) -> pd.DataFrame:
        counted = pd.concat([*_count(iter([block.assign(lang=block["fold"] + block["lang"])]))] or [
            pd.DataFrame({"lang": [], "gram": [], "n": []})])
        return pd.DataFrame({"block": int(block["block"].iloc[0]), "lang": list(counted["lang"]),
                             "gram": counted["gram"].to_numpy(dtype=np.int64)})

    def score_block(block: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        models = Models(_arrays(found))
        return pd.concat([_score(part, models) for part in steps([block])])

    wanted = blocks.groupBy("block").applyInPandas(grams_of, "block bigint, lang string, gram bigint")
    answers = wanted.join(model, ["lang", "gram"])
    return stored(blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(score_block, _SCORED))


# ---- bands and verdicts -------------------------------------------------------------------------------------------


def _quantiles(values: DataFrame, **shares: float) -> DataFrame:
    """``(lang, ...)``: for each share the least value, in steps of 1 / ``GRAIN``, that it of the values do not exceed.

    What meets per language is a histogram of the steps."""
    bins = values.groupBy("lang", F.floor(F.col("value") * GRAIN).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    up_to, whole = Window.partitionBy("lang").orderBy("bin"), Window.partitionBy("lang")
    part = F.sum("n").over(up_to) / F.sum("n").over(whole)
    return bins.withColumn("part", part).groupBy("lang").agg(*[
        F.min(F.when(F.col("part") >= share, F.col("bin") / GRAIN)).alias(name) for name, share in shares.items()])


def deviation() -> Column:
    """How far ``word_ppl`` is from the ``middle`` of its language, in terms of an endless text: the variance of the mean over
    n words is taken to be in proportion to 1 + ``SHORT_WORDS`` / n."""
    n = F.col("judged_words")
    return (F.col("word_ppl") - F.col("middle")) * F.sqrt(n / (n + SHORT_WORDS))


def bands(scored: DataFrame, below: float, above: float) -> DataFrame:
    """``(lang, middle, low, high)``: the median of ``word_ppl`` over different texts, and the quartiles of the deviations from
    it, widened by multiples of their distance."""
    texts = scored.filter("judged_words > 0").groupBy("lang", "key").agg(
        F.min("word_ppl").alias("word_ppl"), F.min("judged_words").alias("judged_words"))
    middle = small_side(_quantiles(texts.withColumn("value", F.col("word_ppl")), middle=0.5))
    q = _quantiles(texts.join(middle, "lang").withColumn("value", deviation()), q1=0.25, q3=0.75)
    gap = F.greatest(F.col("q3") - F.col("q1"), F.lit(LEAST_GAP))
    return q.join(middle, "lang").select("lang", "middle", (F.col("q1") - below * gap).alias("low"),
                                         (F.col("q3") + above * gap + 1 / GRAIN).alias("high"))


def assess(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", below: float = 3.0,
           above: float = 5.0) -> DataFrame:
    """``(id_col, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, log_ppl, word_ppl, base_failed, kept)``.

    One row per input row. A document fails the base rules with under 50 words, or with over half of its words in
    repeated three-word windows; it is kept if it passes them and its log-perplexity per word, by the model of the texts
    of the other fold, lies within the band of its language (see :func:`word_costs`, :func:`trimmed_means`, :func:`bands`). Bands
    are the quartiles of the different texts that pass, widened by ``below`` and ``above`` times their distance (at least
    ``LEAST_GAP``). ``log_ppl`` is per character, by the same model. A text without letters and digits is not kept. A missing
    text counts as empty, a missing language is one of its own; repeated rows and missing ids are rows like others; other
    columns are not read.
    """
    rows = with_fold(with_language(df, id_col, text_col, lang_col))
    counts = count_texts(rows)
    levels = {order: stored(level) for order, level in count_levels(_of_other_fold(counts)).items()}
    model = stored(probabilities(levels, counts))
    score = score_with_held_model if model.count() <= HELD_GRAMS else score_in_blocks
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    scored = score(rows, model).withColumn("base_failed", failed)
    for frame in (counts, model, *levels.values()):
        discard(frame)
    judged = scored.join(small_side(bands(scored.filter(~F.col("base_failed")), below, above)), "lang", "left")
    inside = F.coalesce(deviation().between(F.col("low"), F.col("high")), F.lit(False))
    return with_id(judged.select("id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "log_ppl",
                                 "word_ppl", "base_failed", (~F.col("base_failed") & inside).alias("kept")), df, id_col)
