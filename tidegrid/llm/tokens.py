"""Byte-level BPE vocabularies as encoders of text."""

from __future__ import annotations

import base64
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import regex
import tiktoken
from tokenizers import Tokenizer

#: Fixed value: the pattern that splits a text before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: A match is settled once this many characters after its end are known: ``'re`` looks two ahead of ``'``, and
#: white space looks one past the run it leaves its last character of.
LOOK_AHEAD = 2
_SPLIT = regex.compile(PATTERN)


def cut_places(text: str, begin: int = 0) -> Iterator[int]:
    """Where pre-tokens begin after something other than white space, from ``begin``, where one begins (itself included).

    A text cut at these places encodes to the ids of its parts. A place after white space is none: the part before it
    would end in a run of white space, which is one match there but may be two in the whole text.
    """
    for match in _SPLIT.finditer(text, begin):
        at = match.start()
        if at == begin or not text[at - 1].isspace():
            yield at


def is_cut(text: str, at: int) -> bool:
    """Whether ``at`` is a place to cut by its two neighbours alone: a space after something else starts a pre-token, as no
    pre-token has a space behind its beginning unless it is white space throughout."""
    return at > 0 and text[at] == " " and not text[at - 1].isspace()


@lru_cache(maxsize=4)
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@lru_cache(maxsize=4)
def added_tokens(path: str) -> dict[str, int]:
    """Texts and ids of the tokens that a tokenizer's ``.json`` file adds to its vocabulary; they are matched before the split."""
    with open(path, encoding="utf-8") as file:
        added = json.load(file)["added_tokens"]
    if any(t[flag] for t in added for flag in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError("added tokens that are matched in another way than letter by letter")
    return {t["content"]: t["id"] for t in added}


@lru_cache(maxsize=4)
def encoder(path: str, added: str | None = None):
    """Function from a text to its ids, without special tokens at its ends.

    ``path`` is a file of base64 tokens and ranks, or the ``.json`` file of a byte-level tokenizer. The tokens that the ``.json``
    file (``added``, for a rank file) adds to the vocabulary are matched in the text, as its library does by default; without
    such a file their strings are ordinary text.
    """
    if path.endswith(".json"):
        tokenizer = Tokenizer.from_file(path)
        return lambda text: np.array(tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")
    special = added_tokens(added) if added else {}
    encoding = tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=load_ranks(path), special_tokens={})

    def encode(text: str) -> np.ndarray:
        return encoding.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False)

    if not special:
        return encode
    parts = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")")

    def encode_all(text: str) -> np.ndarray:
        if not any(token in text for token in special):
            return encode(text)
        return np.concatenate([np.array([special[part]], dtype="<u4") if part in special else encode(part)
                               for part in parts.split(text)])

    return encode_all


@lru_cache(maxsize=4)
def token_bytes(path: str) -> list[bytes]:
    """Bytes of each id of a rank file; an id it lacks has none."""
    ranks = load_ranks(path)
    table = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return table
