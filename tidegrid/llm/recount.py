"""Token counts of documents under edits, without encoding whole texts again.

A document's pre-tokens are grouped in leaves, cut where the parts encode like the whole; a segment tree over them holds
the characters and tokens below each node. An edit starts at the last leaf boundary that cannot see it, goes on to the next
one behind it that is still a place to cut, and encodes only what lies between; the sums above the changed leaves are
updated.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.batches import STEP_CHARS, id_and_text, with_id
from tidegrid.llm.tokens import LOOK_AHEAD, cut_places, encoder, is_cut

#: Characters of a leaf; a leaf that edits have made this many times as long makes the tree be laid out anew.
LEAF_CHARS, OVERFULL = 192, 8


def leaf_cuts(text: str, begin: int, end: int) -> list[int]:
    """Places to cut ``text[begin:end]`` into leaves, ``begin`` included; both ends must be such places themselves.

    Mostly spaces after something else; where none comes for long, pre-tokens are scanned.
    """
    cuts = [begin]
    while end - cuts[-1] > 2 * LEAF_CHARS:
        far = min(end, cuts[-1] + OVERFULL * LEAF_CHARS)
        at = text.find(" ", cuts[-1] + LEAF_CHARS, far)
        while at >= 0 and not is_cut(text, at):
            at = text.find(" ", at + 1, far)
        if at < 0:
            least = cuts[-1] + LEAF_CHARS
            at = next((p for p in cut_places(text, cuts[-1]) if p >= least), end)
        if at >= end:
            break
        cuts.append(at)
    return cuts


class CountTree:
    """Characters and tokens of consecutive leaves, summed up to the root (node 1; the children of n are 2n and 2n + 1)."""

    def __init__(self, chars: list[int], tokens: list[int]):
        self.leaves = len(chars)
        self.width = 1 << max(0, (self.leaves - 1).bit_length())
        self.chars, self.tokens = ([0] * self.width + x + [0] * (self.width - self.leaves) for x in (chars, tokens))
        for node in range(self.width - 1, 0, -1):
            self._add_up(node)

    def _add_up(self, node: int) -> None:
        self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
        self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    @classmethod
    def of(cls, text: str, encode) -> CountTree:
        cuts = [*leaf_cuts(text, 0, len(text)), len(text)]
        parts = [text[a:b] for a, b in zip(cuts, cuts[1:])]
        return cls([len(p) for p in parts], [len(encode(p)) for p in parts])

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    @property
    def n_chars(self) -> int:
        return self.chars[1]

    def leaf_at(self, position: int) -> tuple[int, int]:
        """The last leaf that begins at or before ``position``, and where it begins."""
        node, begin = 1, 0
        while node < self.width:
            left, right = self.chars[2 * node], 2 * node + 1
            first_leaf = right << (self.width.bit_length() - right.bit_length())
            if begin + left <= position and first_leaf - self.width < self.leaves:
                node, begin = right, begin + left
            else:
                node *= 2
        return node - self.width, begin

    def edit(self, text: str, start: int, stop: int, new: str, encode) -> tuple[str, int]:
        """Replace ``text[start:stop]`` by ``new``; returns the new text and how many of its characters were encoded."""
        changed, shift = text[:start] + new + text[stop:], len(new) - (stop - start)
        first, begin = self.leaf_at(max(0, start - LOOK_AHEAD))
        last, end = first, begin  # leaves first..last-1 are replaced, old characters begin..end
        while last < self.leaves and (end < stop or last == first):
            end, last = end + self.chars[self.width + last], last + 1
        if last < self.leaves and not is_cut(changed, end + shift):
            last, end = self._resume(changed, begin, shift, last, end)
        self._replace(first, last, begin, end + shift, changed, encode)
        return changed, end + shift - begin

    def _resume(self, changed: str, begin: int, shift: int, last: int, end: int) -> tuple[int, int]:
        """The first leaf boundary from ``end`` on that is a place to cut in the changed text, found by scanning it."""
        for at in cut_places(changed, begin):
            while last < self.leaves and end + shift < at:
                end, last = end + self.chars[self.width + last], last + 1
            if end + shift == at:
                return last, end
        return self.leaves, self.n_chars

    def _replace(self, first: int, last: int, begin: int, end: int, text: str, encode) -> None:
        """Lay out ``text[begin:end]`` over the leaves ``first`` to ``last`` - 1 and add up what is above them."""
        cuts = leaf_cuts(text, begin, end)
        slots = last - first
        if len(cuts) > OVERFULL * slots:  # other leaves keep their counts
            cuts.append(end)
            parts = [text[a:b] for a, b in zip(cuts, cuts[1:])]
            width = self.width
            chars = self.chars[width:width + first] + [len(p) for p in parts] + self.chars[width + last:width + self.leaves]
            tokens = (self.tokens[width:width + first] + [len(encode(p)) for p in parts]
                      + self.tokens[width + last:width + self.leaves])
            self.__init__(chars, tokens)
            return
        ends = [cuts[k * len(cuts) // slots] if k * len(cuts) // slots else begin for k in range(slots)] + [end]
        low, high = self.width + first, self.width + last - 1
        for node, a, b in zip(range(low, high + 1), ends, ends[1:]):
            self.chars[node], self.tokens[node] = b - a, len(encode(text[a:b])) if b > a else 0
        while low > 1:
            low, high = low // 2, high // 2
            for node in range(low, high + 1):
                self._add_up(node)


def recount(df: DataFrame, edits: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, n_tokens_before, n_tokens, n_chars, encoded_chars, text_sha256)``, one row per row of ``df``.

    ``edits`` has ``id_col, seq, start, stop, replacement``: by ascending ``seq``, the code points ``start`` to ``stop`` - 1
    of the text as it then is give way to the replacement. Positions beyond the text mean its end, negative or missing
    ones its start, a stop before the start means the start, a missing replacement nothing. Edits of an id apply to every
    row that has it, those of ids that no row has to none; equal ``seq`` apply in the order of the other columns. A
    missing text counts as empty; a row without id has no edits. ``encoded_chars`` counts what the edits made to encode.

    Documents and edits meet sorted in a stream: a task holds one document at a time and none of the edits to come.
    """
    key = F.md5("text")
    docs = id_and_text(df, id_col, text_col).withColumn("digest", key)
    known = docs.filter("id is not null").select("id", "digest").distinct()
    clean = edits.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("string").alias("id"), F.col("seq").cast("bigint").alias("seq"),
        F.col("start").cast("bigint").alias("start"), F.col("stop").cast("bigint").alias("stop"),
        F.coalesce("replacement", F.lit("")).alias("text"))
    none = F.lit(None).cast("bigint")
    stream = (docs.select("id", "digest", F.lit(0).alias("kind"), none.alias("seq"), none.alias("start"),
                          none.alias("stop"), "text")
              .unionByName(clean.join(known, "id").withColumn("kind", F.lit(1)))
              .repartition("id", "digest")
              .sortWithinPartitions("id", "digest", "kind", "seq", "start", "stop", "text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(vocabulary)
        held, copies, tree, text, before, done = None, 0, None, "", 0, 0

        results: list[tuple] = []
        waiting = 0  # characters in them

        def finish() -> None:
            nonlocal waiting
            results.extend([(held[0], before, tree.n_tokens, tree.n_chars, done, text)] * copies)
            waiting += len(text) * copies

        def drain() -> pd.DataFrame:
            nonlocal waiting
            out = pd.DataFrame(results, columns=["id", "n_tokens_before", "n_tokens", "n_chars", "encoded_chars", "text"])
            results.clear()
            waiting = 0
            return out

        for rows in batches:
            for doc, digest, kind, start, stop, new in zip(*(rows[c] for c in (
                    "id", "digest", "kind", "start", "stop", "text"))):
                if kind == 0:
                    if held is not None and held == (doc, digest):
                        copies += 1
                        continue
                    if held is not None:
                        finish()
                        if waiting > STEP_CHARS:
                            yield drain()
                    held, copies, text, done = (doc, digest), 1, new, 0
                    tree = CountTree.of(text, encode)
                    before = tree.n_tokens
                else:
                    start = min(max(0, int(start) if start == start else 0), len(text))
                    stop = min(max(start, int(stop) if stop == stop else 0), len(text))
                    text, work = tree.edit(text, start, stop, new, encode)
                    done += work
        if held is not None:
            finish()
        yield drain()

    out = stream.mapInPandas(run, "id string, n_tokens_before bigint, n_tokens bigint, n_chars bigint, "
                                  "encoded_chars bigint, text string")
    return with_id(out.withColumn("text_sha256", F.sha2("text", 256)).drop("text"), df, id_col)
