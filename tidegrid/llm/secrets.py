"""Secret spans by keyword hits, anchored expressions and embedded checksums.

One pass of an Aho-Corasick automaton over the lower-cased text finds the keywords. Expressions are tried only where a
keyword begins. Token formats that embed a checksum count only if it holds.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.batches import id_and_text, with_id

#: Kinds in the order in which spans with the same start are listed.
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "github", "npm")

# Keywords, patterns and lengths of the formats.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")  # a greedy run: the same as dropping shorter runs
_GITHUB = re.compile(r"(gh[pousr]_)([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
_NPM = re.compile(r"(npm_)([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
ASSIGN_VALUE, ACCESS_LENGTH = 12, 18
KEYWORDS = {
    "password": "assign", "passwd": "assign", "secret": "assign", "token": "assign", "apikey": "assign",
    "api_key": "assign", "akia": "access", "ghp_": "github", "gho_": "github", "ghu_": "github", "ghs_": "github",
    "ghr_": "github", "npm_": "npm",
}
_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def checksum(payload: str) -> str:
    """The six base-62 digits that such tokens carry: CRC-32 of the payload."""
    n, out = zlib.crc32(payload.encode()), ""
    for _ in range(6):
        n, digit = divmod(n, 62)
        out = _DIGITS[digit] + out
    return out


def _checked(match: re.Match) -> bool:
    return checksum(match[2]) == match[3]


_RULES = {
    "assign": (_ASSIGN, lambda m: len(m[2]) >= ASSIGN_VALUE),
    "access": (_ACCESS, lambda m: len(m[0]) >= ACCESS_LENGTH),
    "github": (_GITHUB, _checked),
    "npm": (_NPM, _checked),
}


@lru_cache(maxsize=1)
def _automaton():
    import ahocorasick

    out = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        out.add_word(word, (len(word), kind))
    out.make_automaton()
    return out


def find_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)`` of every span, sorted; positions are code points.

    Within a kind, matches are the leftmost non-overlapping ones of its expression over the whole text; those that
    fail its length or checksum still take their characters, as a search that filters afterwards does.
    """
    # One letter lower-cases to two characters; as a plain I it keeps the positions.
    folded = text.replace("İ", "I").lower()
    spans, hits = [], {}
    for end, (length, kind) in _automaton().iter(folded):
        hits.setdefault(kind, []).append(end - length + 1)
    for kind, starts in hits.items():
        (pattern, holds), number, free = _RULES[kind], KINDS.index(kind), 0
        for start in sorted(starts):
            if start >= free and (match := pattern.match(text, start)):
                free = match.end()
                if holds(match):
                    spans.append((start, number, free))
    number = KINDS.index("hex")
    spans += [(m.start(), number, m.end()) for m in _HEX.finditer(text)]
    spans.sort()
    return spans


def _listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def scan_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, n_assign, n_access, n_hex, base_spans, spans)``, one row per input row, without a shuffle.

    Spans are ``kind:start:end`` by start, then kind, comma-joined; none gives an empty string. ``base_spans`` has
    the three unconditional kinds, ``spans`` also the checksummed ones. A missing text counts as empty. Other columns
    are not read, so their names cannot clash; repeated rows give repeated results.
    """
    base = len(BASE_KINDS)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            found = [find_spans(t) for t in rows["text"]]
            counts = {f"n_{k}": [sum(s[1] == i for s in spans) for spans in found] for i, k in enumerate(BASE_KINDS)}
            yield rows[["id"]].assign(
                **counts, base_spans=[_listed([s for s in spans if s[1] < base]) for spans in found],
                spans=[_listed(spans) for spans in found])

    rows = id_and_text(df, id_col, text_col)
    out = rows.mapInPandas(run, "id string, n_assign bigint, n_access bigint, n_hex bigint, base_spans string, "
                                "spans string")
    return with_id(out, df, id_col)


def redact(df: DataFrame, text_col: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """``df`` with every span of ``text_col`` replaced by ``mask``; overlapping spans become one mask.

    All rows and all other columns are kept; a missing text stays missing.
    """

    @F.pandas_udf("string")
    def masked(column: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else _masked(t, mask) for t in column], dtype=object)

    return df.withColumn(text_col, masked(F.col(text_col)))


def _masked(text: str, mask: str) -> str:
    out, done = [], 0
    for start, _, end in find_spans(text):
        if start >= done:
            out += [text[done:start], mask]
        done = max(done, end)
    return "".join([*out, text[done:]])
