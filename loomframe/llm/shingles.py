"""Sets of word shingles and their MinHash values, for many texts at once."""

from __future__ import annotations

import numpy as np

from loomframe.llm.common import LOWER, mixed, word_hashes


def shingle_set(text: bytes, size: int) -> np.ndarray:
    """The distinct shingles of ``size`` words as sorted 64-bit hashes.

    A-Z are lower-cased. With fewer words the whole sequence is one shingle; a text without words has none.
    """
    words, _ = word_hashes(LOWER[np.frombuffer(text, np.uint8)])
    if not len(words):
        return words
    width = min(size, len(words))
    h = np.full(len(words) - width + 1, width, np.uint64)
    for i in range(width):
        h = mixed(h * np.uint64(0xD6E8FEB86659FD93) + words[i : len(words) - width + 1 + i])
    return np.unique(h)


def minhash_seeds(n: int, seed: int = 7) -> np.ndarray:
    """Multipliers (odd) and addends of ``n`` hash functions."""
    rng = np.random.default_rng(seed)
    drawn = rng.integers(0, 1 << 63, (2, n), np.uint64)
    drawn[0] |= np.uint64(1)
    return drawn


def minhashes(sets: list[np.ndarray], seeds: np.ndarray) -> np.ndarray:
    """MinHash values of sets that are not empty: a row for each set, a column for each function."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    values = np.concatenate(sets)
    out = np.empty((len(sets), seeds.shape[1]), np.uint32)
    for j, (a, b) in enumerate(seeds.T):
        out[:, j] = np.minimum.reduceat(values * a + b, starts) >> np.uint64(32)
    return out
