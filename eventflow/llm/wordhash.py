"""Hashes of all words of a batch of texts at once."""

from __future__ import annotations

import numpy as np

_RNG = np.random.default_rng(20240301)
#: ASCII letters (case folded), digits and non-ASCII bytes make words; 0 stands for all else
FOLD = np.zeros(256, np.uint8)
FOLD[48:58] = np.arange(48, 58)
FOLD[97:123] = np.arange(97, 123)
FOLD[65:91] = np.arange(97, 123)
FOLD[128:] = np.arange(128, 256)
_OF_BYTE = _RNG.integers(1, 2 ** 63, 256, dtype=np.uint64)
_BASE = int(_RNG.integers(1, 2 ** 62)) * 2 + 1
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> list[np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 1 << 20)
        _POWERS.clear()
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _POWERS.append(np.multiply.accumulate(p))
    return _POWERS


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def word_hashes(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word of the texts data[off[i]:off[i + 1]], and the number of words in front of each text (and in all)."""
    folded = FOLD[data]
    word = folded != 0
    first = word.copy()
    first[1:] &= ~word[:-1]
    inner = off[(off > 0) & (off < len(data))]
    first[inner] = word[inner]  # a word ends with its text
    starts = np.flatnonzero(first)
    last = word.copy()
    last[:-1] &= ~word[1:] | first[1:]
    ends = np.flatnonzero(last) + 1
    return run_hashes(_OF_BYTE[folded] * word, starts, ends), np.searchsorted(starts, off)


def byte_values(data: np.ndarray) -> np.ndarray:
    return _OF_BYTE[data]


#: values that one polynomial covers; longer ones could be built to share it
PIECE = 64


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the runs values[starts[i]:ends[i]]: mixed differences of scaled prefix sums.

    A run of more than PIECE values is the run of its pieces' hashes.
    """
    up, down = _powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:len(values)], out=sums[1:])
    out = mix((sums[np.minimum(ends, starts + PIECE)] - sums[starts]) * down[starts])
    long = np.flatnonzero(ends - starts > PIECE)
    if len(long):
        a, e = starts[long], ends[long]
        count = -(-(e - a) // PIECE)
        at = np.concatenate(([0], np.cumsum(count)))
        begin = np.repeat(a, count) + PIECE * (np.arange(at[-1]) - np.repeat(at[:-1], count))
        end = np.minimum(begin + PIECE, np.repeat(e, count))
        out[long] = run_hashes(mix((sums[end] - sums[begin]) * down[begin]) + np.uint64(1), at[:-1], at[1:])
    return out


def shingle_hashes(words: np.ndarray, before: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the k words that begin at each word, and which of them stay inside one text."""
    n = len(words)
    h = np.zeros(n, np.uint64)
    for i in range(k):
        if n > i:
            h[:n - i] += words[i:] * np.uint64(2 * int(_OF_BYTE[i] >> np.uint64(2)) + 1)
    left = np.repeat(before[1:], np.diff(before)) - np.arange(n)
    return mix(h), left >= k
