"""Words of whole texts as 64-bit numbers, and hashed word shingles of them.

A word is a longest run of bytes other than ASCII white space, A-Z in lower case. Every
function takes UTF-8 bytes (None: no text) and works on all of them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

WIDTH, LONGEST = 5, 64
# Odd 64-bit factors, one for each place in a shingle.
FACTORS = [int(xxhash.xxh3_64_intdigest(bytes([k])) | 1) for k in range(16)]


class Remembered(dict):
    """Value of a word, worked out once. Holds two halves of at most `most` words each; when
    the younger is full the older is dropped, so words in steady use are kept. Very long words
    are worked out each time."""

    def __init__(self, work, most: int = 150_000):
        super().__init__()
        self.work, self.most, self.older = work, most, {}

    def __missing__(self, word):
        value = self.older.get(word)
        if value is None:
            value = self.work(word)
        self.put(word, value)
        return value

    def put(self, word, value) -> None:
        if len(word) > LONGEST:
            return
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[word] = value


def word_numbers() -> Remembered:
    return Remembered(xxhash.xxh3_64_intdigest)


def as_bytes(column) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def split(text: bytes | None) -> list[bytes]:
    return text.lower().split() if text else []


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes | None, numbers: Remembered, width: int = WIDTH) -> np.ndarray:
    """Distinct shingles of a text as sorted numbers; with fewer words than `width`, the
    whole sequence is one shingle; without words there is none."""
    words = split(text)
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(numbers.__getitem__, words), np.uint64, len(words))
    size = min(width, len(h))
    n = len(h) - size + 1
    # The length is part of the number, so a short text never equals a longer one's shingle.
    total = np.full(n, size, np.uint64)
    for k in range(size):
        total += h[k : k + n] * np.uint64(FACTORS[k])
    return np.unique(mix(total))
