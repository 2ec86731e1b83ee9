"""Word hashes inside Arrow batches, shared by the operators that read words in Python."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import xxhash

LOWER_AZ = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
ODD = np.uint64(0x9E3779B97F4A7C15)


class WordHash(dict):
    """Word (bytes) to its 64-bit hash; forgets all at ``limit`` words."""

    def __init__(self, limit: int = 300_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > self.limit:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64, on uint64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(text: str | None, lower: bool = True) -> list[bytes]:
    """The words of a text: split at the six ASCII white-space characters only."""
    raw = (text or "").encode()
    return (raw.translate(LOWER_AZ) if lower else raw).split()


def runs(items: Iterable, weight, limit: int) -> Iterator[list]:
    """Consecutive items in lists of about ``limit`` total weight, one item at least."""
    part, held = [], 0
    for x in items:
        part.append(x)
        held += weight(x)
        if held >= limit:
            yield part
            part, held = [], 0
    if part:
        yield part
