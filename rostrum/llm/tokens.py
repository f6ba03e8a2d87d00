"""64-bit hashes of words and of runs of words, in numpy."""

from __future__ import annotations

import numpy as np
import xxhash

_MIX = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB], np.uint64)


def hash_words(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Names of ordered pairs of names."""
    return mix(a * _MIX[0] + (b ^ (b >> np.uint64(32))) + np.uint64(0x632BE59BD9B4E019))


def windows(h: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Hashes of the runs of ``k`` items; none if there are fewer."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.full(n, seed, np.uint64)
    for j in range(k):
        out = joined(out, h[j : j + n])
    return out


def seeds(n: int, key: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * _MIX[0] + np.uint64(key))
