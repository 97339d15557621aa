"""Word shingles of a text as sorted arrays of 64-bit hashes."""

from __future__ import annotations

import numpy as np

N_WORDS = 5
_BASE = 0x9E3779B97F4A7C15
_SPACES = np.zeros(256, bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True
_BYTES = np.random.default_rng(5).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mixed(x: np.ndarray, step: int = 1) -> np.ndarray:
    """Finaliser of a 64-bit hash, element by element."""
    x = x + np.uint64(_BASE * step % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(n: int) -> list[np.ndarray]:
    """Powers of the odd base and of its inverse modulo 2**64, up to n."""
    if len(_powers[0]) < n:
        n = max(n, 2 * len(_powers[0]))
        for k, base in enumerate((_BASE, pow(_BASE, -1, 2**64))):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers


def word_hashes(text: bytes) -> np.ndarray:
    """One hash per word of the text in ASCII lower case."""
    letters = np.frombuffer(text.lower(), np.uint8)
    if not len(letters):
        return np.zeros(0, np.uint64)
    inside = np.concatenate([[False], ~_SPACES[letters], [False]])
    turns = np.nonzero(inside[1:] != inside[:-1])[0]
    start, end = turns[::2], turns[1::2]
    power, inverse = _power(len(letters) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[letters] * power[: len(letters)], dtype=np.uint64)])
    return mixed((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64))


def shingle_set(text: bytes, n_words: int = N_WORDS) -> np.ndarray:
    """Sorted distinct shingles; a text of fewer words is one shingle, a text without words has none."""
    words = word_hashes(text)
    if not len(words):
        return np.zeros(0, np.int64)
    n = min(n_words, len(words))
    total = np.full(len(words) - n + 1, n, np.uint64)
    for k in range(n):
        total = mixed(total ^ words[k : k + len(total)], k + 1)
    return np.unique(total.view(np.int64))
