"""Hashed words and word n-grams of texts, as arrays of 64 bits."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import xxhash

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
CACHE = 1 << 18


class Memo(dict):
    """A function of words that remembers up to `CACHE` of them."""

    def __init__(self, function: Callable):
        super().__init__()
        self._function = function

    def __missing__(self, key):
        if len(self) >= CACHE:
            self.clear()
        value = self[key] = self._function(key)
        return value

    def array(self, tokens: list[bytes], kind=np.uint64) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, tokens), kind, len(tokens))


def word_hasher() -> Memo:
    return Memo(xxhash.xxh3_64_intdigest)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64 bits."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all n-grams, in order (a polynomial of the word hashes, scrambled); none if
    there are fewer than n words."""
    if len(hashes) < n:
        return np.empty(0, np.uint64)
    m = len(hashes) - n + 1
    out = hashes[:m].copy()
    for i in range(1, n):
        out *= MULTIPLIER
        out += hashes[i:i + m]
    return mixed(out)


def shingle_set(hasher: Memo, text: str | None, n: int) -> np.ndarray:
    """Sorted distinct shingles of n words (runs of characters other than ASCII white space, at
    which bytes are split); a shorter text with words is one shingle."""
    hashes = hasher.array(text.encode().split()) if text else np.empty(0, np.uint64)
    if 0 < len(hashes) < n:
        return grams(hashes, len(hashes))
    return np.unique(grams(hashes, n))
