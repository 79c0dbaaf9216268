"""Word shingles of texts and minwise samples of them, in numpy."""

from __future__ import annotations

import functools

import numpy as np
import xxhash

WORDS = 5
MIX = np.uint64(0x9E3779B97F4A7C15)
ROUND = np.uint64(0xD6E8FEB86659FD93)


@functools.lru_cache(maxsize=40_000)
def _word(word: str) -> int:
    return xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers; one to one."""
    h = (h ^ (h >> np.uint64(32))) * ROUND
    h = (h ^ (h >> np.uint64(29))) * MIX
    return h ^ (h >> np.uint64(32))


def word_hashes(words: list[str]) -> np.ndarray:
    return np.fromiter(map(_word, words), np.uint64, len(words))


def shingle_hashes(hashes: np.ndarray, k: int = WORDS) -> np.ndarray:
    """Hashes of all runs of ``k`` words, repeats included; fewer words are one run."""
    n = len(hashes)
    if n == 0:
        return hashes
    k = min(k, n)
    last = n - k + 1
    out = np.full(last, k, np.uint64)
    for at in range(k):
        out = (out ^ hashes[at : at + last]) * MIX
        out ^= out >> np.uint64(31)
    return mixed(out)


def shingle_set(text: str | None, k: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the ``k``-word shingles of a text, lower-cased, words
    cut at white space."""
    return np.unique(shingle_hashes(word_hashes((text or "").lower().split()), k))


@functools.cache
def _multipliers(count: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(seed)
    odd = random.integers(0, 1 << 31, count, np.uint32) * np.uint32(2) + np.uint32(1)
    return odd[:, None], random.integers(0, 1 << 32, count, np.uint32)[:, None]


def hash_values(hashes: np.ndarray, count: int, seed: int = 3) -> np.ndarray:
    """``count`` hash functions of each of some hashes, those of ``minima``."""
    scale, shift = _multipliers(count, seed)
    return (hashes >> np.uint64(32)).astype(np.uint32)[None, :] * scale + shift


def minima(hashes: np.ndarray, count: int, seed: int = 3) -> np.ndarray:
    """The least of ``count`` hash functions over a non-empty set of 64-bit hashes."""
    low = (hashes >> np.uint64(32)).astype(np.uint32)
    scale, shift = _multipliers(count, seed)
    best = np.full(count, 0xFFFFFFFF, np.uint32)
    step = max(1, (1 << 17) // count)
    for at in range(0, len(low), step):
        values = low[None, at : at + step] * scale
        values += shift
        np.minimum(best, values.min(axis=1), out=best)
    return best
