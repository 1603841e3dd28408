"""Word-shingle sets and MinHash signatures of whole texts (numpy, inside tasks)."""

from __future__ import annotations

import numpy as np
import xxhash

WIDTH = 5
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)
_CACHE_WORDS = 100_000


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every output bit depends on every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Distinct five-word shingles of texts, as sorted 64-bit hashes.

    A-Z is lower-cased; words are runs of anything but blanks and the control characters 9 to 13.
    A text of fewer than five words is one shingle of its whole word sequence; a NULL text or one
    without words has none.  The word cache only saves hashing and is emptied when full.
    """

    def __init__(self) -> None:
        self.words: dict[bytes, int] = {}

    def hashes(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, np.uint64)
        words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII case and blanks only
        if not words:
            return np.empty(0, np.uint64)
        cache = self.words
        if len(cache) > _CACHE_WORDS:
            cache.clear()
        try:
            ids = [cache[w] for w in words]
        except KeyError:
            for w in words:
                if w not in cache:
                    cache[w] = xxhash.xxh3_64_intdigest(w)
            ids = [cache[w] for w in words]
        h = np.array(ids, dtype=np.uint64)
        n = len(h)
        if n < WIDTH:
            whole = np.uint64(n)
            for i in range(n):
                whole = whole + h[i : i + 1] * _FACTORS[i]
            return mix(whole)
        total = h[: n - WIDTH + 1] * _FACTORS[0]
        for i in range(1, WIDTH):
            total = total + h[i : n - WIDTH + 1 + i] * _FACTORS[i]
        return np.unique(mix(total))


def permutations(k: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    a = rng.integers(1, 2**63, size=k, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a, rng.integers(0, 2**63, size=k, dtype=np.uint64)


def signature(hashes: np.ndarray, a: np.ndarray, b: np.ndarray, block: int = 1024) -> np.ndarray:
    """The k smallest permuted hashes, cut to 32 bits; the set must not be empty."""
    best = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(hashes), block):
        part = hashes[i : i + block, None] * a + b
        np.minimum(best, (part ^ (part >> np.uint64(29))).min(axis=0), out=best)
    return (mix(best) >> np.uint64(32)).astype(np.uint32)
