"""Hashed word shingles of whole texts, in bulk."""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd: it has an inverse modulo 2**64
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Text number and 64-bit hash of every word, A-Z lower-cased.

    The hash is a polynomial in the word's bytes: differences of running sums, scaled back to the word's start.
    """
    raw = [t.encode("utf-8", "surrogatepass").lower() for t in texts]
    data = np.frombuffer(b"\n".join([*raw, b""]), dtype=np.uint8)
    space = _SPACE[data]
    before = np.concatenate([[True], space[:-1]])
    starts = np.flatnonzero(before & ~space)
    stops = np.flatnonzero(space & ~before)
    powers = np.cumprod(np.full(len(data), _BASE))
    sums = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers)])
    back = np.cumprod(np.full(len(data), _BACK))
    hashes = mix((sums[stops] - sums[starts]) * back[starts] + (stops - starts).astype(np.uint64))
    ends = np.cumsum([len(r) + 1 for r in raw])
    return np.searchsorted(ends, starts, side="right"), hashes


def shingle_sets(texts: list[str], words: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the ``words``-word shingles of each text.

    A text of fewer words has one shingle, the whole sequence; one without words has none.
    """
    docs, hashes = word_hashes(texts)
    counts = np.bincount(docs, minlength=len(texts))
    first = np.concatenate([[0], np.cumsum(counts)])
    rolled = hashes.copy()
    for k in range(1, words):
        rolled = mix(rolled[:len(hashes) - k] * _BASE + hashes[k:]) if len(hashes) > k else rolled[:0]
    out = []
    for doc, n in enumerate(counts.tolist()):
        at = first[doc]
        if n >= words:
            out.append(np.unique(rolled[at:at + n - words + 1]))
        elif n:
            whole = np.uint64(n)
            with np.errstate(over="ignore"):
                for h in hashes[at:at + n]:
                    whole = mix(np.array([whole * _BASE + h]))[0]
            out.append(np.array([whole]))
        else:
            out.append(np.empty(0, dtype=np.uint64))
    return out
