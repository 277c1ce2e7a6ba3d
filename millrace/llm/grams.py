"""Words of a text as numbers, and hashes of runs of words, made by doubling."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import xxhash

# Odd numbers that mix two hashes.
_LEFT, _RIGHT, _LAST = (np.uint64(n) for n in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))
_SHIFT = np.uint64(32)

#: Words whose hash is remembered; beyond that all are forgotten.
REMEMBERED = 1 << 19


class WordHashes(dict):
    """64-bit hashes of words, each worked out once."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def words_of(text: str) -> list[bytes]:
    """Words between space, tab, line feed, vertical tab, form feed and carriage return,
    which are what separates bytes."""
    return text.encode().split()


def numbered(words: list[bytes]) -> np.ndarray:
    """A number for each word, the same for the same word of this text only."""
    return np.fromiter(map(_Numbers().__getitem__, words), np.int64, len(words))


def mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A hash of two hashes, which depends on their order."""
    out = left * _LEFT + (right ^ (right >> _SHIFT)) * _RIGHT
    out ^= out >> _SHIFT
    out *= _LAST
    return out ^ (out >> _SHIFT)


def doubled(hashes: np.ndarray, step: int) -> np.ndarray:
    """From hashes of ``step`` words from each place on, those of twice as many."""
    return mixed(hashes[:-step], hashes[step:])


def hashes_of(hashes: np.ndarray, words: int) -> np.ndarray:
    """From hashes of single words, those of ``words`` words from each place on: two
    overlapping powers of two make any length."""
    step = 1
    while 2 * step <= words:
        hashes, step = doubled(hashes, step), 2 * step
    return hashes if step == words else mixed(hashes[: len(hashes) - (words - step)], hashes[words - step :])


def over_windows(pick: Callable[..., np.ndarray], values: np.ndarray, width: int) -> np.ndarray:
    """``pick`` (``np.minimum`` or ``np.maximum``) of every ``width`` neighbours; a power of two."""
    step = 1
    while step < width:
        values = pick(values[:-step], values[step:])
        step *= 2
    return values
