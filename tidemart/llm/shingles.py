"""Word shingles of whole texts as sorted sets of 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

WORDS = 5
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xFF51AFD7ED558CCD)
_HALF = np.uint64(32)


class WordHashes(dict):
    """64-bit hash of each word, remembered for a bounded number of words."""

    LIMIT = 500_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def split_words(raw: bytes) -> list[bytes]:
    """Words of a UTF-8 text, A-Z lower-cased; bytes know only the six ASCII white space characters."""
    return raw.lower().split()


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> _HALF)) * _MIX
    return values ^ (values >> _HALF)


def word_hashes(words: list[bytes], known: WordHashes) -> np.ndarray:
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` words, in order: a polynomial, put together from runs of 1, 2, 4 ... words."""
    n = len(hashes) - size + 1
    total = np.full(max(n, 0), size, np.uint64)
    run, length, at = hashes, 1, 0
    while True:
        factor = np.uint64(pow(int(_FACTOR), length, 1 << 64))
        if size & length:
            total = total * factor + run[at:at + len(total)]
            at += length
        if length * 2 > size:
            return mixed(total)
        run = run[:-length] * factor + run[length:]
        length *= 2


def shingle_set(raw: bytes | None, known: WordHashes, size: int = WORDS) -> np.ndarray:
    """Sorted distinct shingles; one of all words where there are fewer; empty without words."""
    words = split_words(raw or b"")
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(windows(word_hashes(words, known), min(size, len(words))))
