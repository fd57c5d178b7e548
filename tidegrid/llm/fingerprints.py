"""Document fingerprints by consistent weighted sampling, with DataFrame functions only.

A document is the set of its words, weighted by how often it has them. For each of the samples, every weighted word draws
from two gamma distributions and a uniform one, all seeded by the word and the number of the sample, and the word of least
value is the sample. Two documents draw the same one with a probability equal to their generalised Jaccard similarity: the
sum of the smaller weights over the sum of the larger.

The value of a draw depends on the word and its quantised weight alone, so equal least values mean equal samples. The
signature is therefore the least value per sample, and the aggregation is a plain minimum of numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.llm.batches import small_side
from tidegrid.session import stored

#: Draws per document: the standard error of a likeness is at most half of 1 / sqrt(SAMPLES).
SAMPLES = 32

#: Sorted hashes of the words of {text}, as (word, number of occurrences). One-element arrays bind a value to a name.
_TERMS = r"""
transform(array(array_sort(transform(filter(split({text}, '[ \\t\\n\\x0B\\f\\r]+'), w -> w <> ''), w -> xxhash64(w)))), s ->
  transform(array(filter(sequence(1, greatest(size(s), 1)), i -> i >= size(s) or s[i] <> s[i - 1])), e ->
    transform(if(size(s) = 0, cast(array() as array<int>), e), (x, j) ->
      struct(s[x - 1] as word, x - if(j = 0, 0, e[j - 1]) as times)))[0])[0]
"""


def _uniform(bits: Column) -> Column:
    """A number above 0 and below 1 from 32 bits."""
    return (bits + F.lit(0.5)) * F.lit(2.0**-32)


def _halves(seed: int) -> tuple[Column, Column]:
    bits = F.xxhash64("word", F.lit(seed))
    return _uniform(F.shiftrightunsigned(bits, 32)), _uniform(bits.bitwiseAND(F.lit(0xFFFFFFFF)))


def _draw(k: int) -> Column:
    """Logarithm of the value of a weighted word in sample ``k``: c / (y e^r), y = e^(r (t - b)), t = [ln w / r + b]."""
    u1, u2 = _halves(3 * k)
    u3, u4 = _halves(3 * k + 1)
    b, _ = _halves(3 * k + 2)
    r, c = -F.ln(u1 * u2), -F.ln(u3 * u4)
    t = F.floor(F.col("log_weight") / r + b)
    return F.ln(c) - r * (t - b) - r


def signatures(df: DataFrame, keys: list[str], text_col: str = "text", samples: int = SAMPLES) -> DataFrame:
    """``(*keys, signature array<double>)``, one row per distinct ``keys``.

    Rows with equal keys must have equal texts. Missing keys are values like others. A text without words, or a missing
    one, has a signature of nulls. Every task reduces its words before anything is shuffled.
    """
    terms = df.select(*keys, F.explode_outer(F.expr(_TERMS.format(text=f"coalesce(`{text_col}`, '')"))).alias("term"))
    words = terms.select(*keys, F.col("term.word").alias("word"),
                         F.ln(F.col("term.times").cast("double")).alias("log_weight"))
    least = words.groupBy(*keys).agg(*[
        F.min(F.when(F.col("word").isNotNull(), _draw(k))).alias(f"m{k}") for k in range(samples)])
    return least.select(*keys, F.array(*[f"m{k}" for k in range(samples)]).alias("signature"))


def likeness(a: Column | str, b: Column | str) -> Column:
    """Share of equal samples of two signatures; two without words are alike."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), lambda same: same)) / F.size(a)


def fingerprint(signature: Column | str) -> Column:
    """A signature as text, eight hexadecimal digits per sample."""
    return F.array_join(F.transform(signature, lambda x: F.substring(
        F.lpad(F.hex(F.xxhash64(x)), 16, "0"), 1, 8)), "")


def same_key(left: str, right: str, keys: dict[str, str]) -> Column:
    """Null-safe equality of the columns of alias ``left`` with those of alias ``right``."""
    out = F.lit(True)
    for a, b in keys.items():
        out = out & F.col(f"{left}.{a}").eqNullSafe(F.col(f"{right}.{b}"))
    return out


def successors(keys: DataFrame, order: list[str]) -> DataFrame:
    """Every distinct row of ``keys`` with ``next_<column>``, those of the row after it in ``order``; the last one's is the first.

    Rows are dealt by range and each range is walked on its own; only the first row of each range meets the others'.
    """
    named = [f"next_{c}" for c in order]
    placed = stored(keys.repartitionByRange(*order).withColumn("part", F.spark_partition_id()))
    heads = placed.groupBy("part").agg(F.min(F.struct(*order)).alias("first"))
    in_order = Window.orderBy("part")  # one row per range
    after = small_side(heads.select("part", F.coalesce(
        F.lead("first").over(in_order), F.first("first").over(in_order)).alias("after")))
    inside = Window.partitionBy("part").orderBy(*order)
    walked = placed.withColumn("next", F.lead(F.struct(*order)).over(inside)).join(after, "part", "left")
    chosen = F.coalesce("next", "after")
    return walked.select(*keys.columns, *[chosen[c].alias(n) for c, n in zip(order, named)])


def edited_fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        samples: int = SAMPLES) -> DataFrame:
    """Fingerprints of every text and of the text whose last quarter gives way to the start of the next one.

    Returns ``id_col, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``, one row per input
    row. The last floor(n / 4) code points are replaced by the first as many (or all) of the next document by id; the last
    document is followed by the first. Missing ids come first. Rows of one id come in the order of their content's hash,
    and equal rows count as one document and give equal results. A missing text counts as empty.
    """
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("hash", F.xxhash64("text"))
    key = ["id", "hash"]
    places = successors(rows.groupBy(*key).agg(F.max(F.length("text")).alias("n_chars")), key)
    places = stored(places.withColumn("cut", F.floor(F.col("n_chars") / 4).cast("int")))

    heads = (places.alias("p").join(rows.alias("r"), same_key("p", "r", {"next_id": "id", "next_hash": "hash"}))
             .select("p.id", "p.hash", "p.n_chars", "p.cut", F.expr("substring(r.text, 1, p.cut)").alias("head")))
    edited = (heads.alias("h").join(rows.alias("r"), same_key("h", "r", {"id": "id", "hash": "hash"}))
              .select("h.id", "h.hash", F.expr("concat(substring(r.text, 1, cast(h.n_chars as int) - h.cut), h.head)")
                      .alias("text")))
    plain = stored(signatures(rows, key, "text", samples))
    changed = signatures(edited, key, "text", samples).withColumnRenamed("signature", "edited")
    digests = edited.select(*key, F.sha2("text", 256).alias("edited_sha256")).dropDuplicates(key)

    own = {"id": "id", "hash": "hash"}
    # The next document's signature moves first, while the row is narrow; the other joins share one partitioning.
    beside = (places.alias("p").join(plain.alias("n"), same_key("p", "n", {"next_id": "id", "next_hash": "hash"}))
              .select("p.id", "p.hash", "p.n_chars", F.col("n.signature").alias("following")))
    result = (
        beside.alias("p")
        .join(plain.alias("a"), same_key("p", "a", own))
        .join(changed.alias("e"), same_key("p", "e", own))
        .join(digests.alias("d"), same_key("p", "d", own))
        .select("p.id", "p.hash", "p.n_chars", "d.edited_sha256", fingerprint("a.signature").alias("fingerprint"),
                fingerprint("e.edited").alias("edited_fingerprint"),
                likeness("a.signature", "e.edited").alias("near_edited"),
                likeness("a.signature", "p.following").alias("near_next")))
    return (rows.select(*key).alias("r").join(result.alias("x"), same_key("r", "x", own))
            .select(F.col("r.id").alias(id_col), F.col("x.n_chars").cast("bigint").alias("n_chars"), "edited_sha256",
                    "fingerprint", "edited_fingerprint", "near_edited", "near_next"))
