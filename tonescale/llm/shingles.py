"""Words and word shingles of texts as 64-bit numbers."""

from __future__ import annotations

import hashlib

import numpy as np

SIZE = 5
KNOWN_WORDS = 300_000
ODD = np.uint64(0x9E3779B97F4A7C15)


class WordNumbers(dict):
    """Number of a word, computed once while it is kept."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        number = self[word] = digest(word)
        return number


def digest(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little")


NUMBERS = WordNumbers()


def words_of(text: str) -> list[bytes]:
    """Runs of other characters than ASCII white space, A-Z in lower case."""
    return text.encode().lower().split()


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A well-spread image of 64-bit numbers; one to one for each seed."""
    x = x ^ np.uint64(seed)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def shingles_of(text: str, size: int = SIZE) -> np.ndarray:
    """Numbers of all shingles in order; of fewer words, the whole sequence is one; none without words."""
    words = words_of(text)
    numbers = np.fromiter(map(NUMBERS.__getitem__, words), np.uint64, len(words))
    if not words:
        return numbers
    if len(words) < size:
        return np.array([digest(b"short " + b" ".join(words))], np.uint64)
    count = len(words) - size + 1
    total = np.zeros(count, np.uint64)
    for i in range(size):
        total = total * ODD + numbers[i : i + count]
    return mix(total)


def shingle_set(text: str, size: int = SIZE) -> np.ndarray:
    """The distinct shingles, ascending."""
    return np.unique(shingles_of(text, size))
