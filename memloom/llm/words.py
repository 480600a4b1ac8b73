"""Words of texts as 64-bit hashes in numpy arrays, for n-grams and shingles."""

from __future__ import annotations

import numpy as np
import xxhash

from memloom.llm.common import worker_held
from memloom.llm.line_dedup import mixed

STRIP = b".,;:!?\"'()[]{}<>|*#%&$@~`^_=+-/\\"


class WordHashes(dict):
    """Hashes of words; a task keeps those of the first words that it meets."""

    KEPT = 60_000

    def __init__(self, bare: bool):
        super().__init__()
        self.bare = bare

    def __missing__(self, word: bytes) -> int:
        """bare: signs around the word don't count, and a word of signs alone is 0."""
        core = word.strip(STRIP) if self.bare else word
        found = (xxhash.xxh3_64_intdigest(core) or 1) if core else 0
        if len(self) < self.KEPT and len(word) <= 64:
            self[word] = found
        return found

    def of(self, text: str | None) -> np.ndarray:
        """Words are runs of signs other than space, tab, line feed, vertical tab, form feed, carriage return; A-Z count as a-z."""
        found = (text or "").encode("utf-8", "surrogatepass").lower().split()
        out = np.fromiter(map(self.__getitem__, found), dtype=np.uint64, count=len(found))
        return out[out != 0] if self.bare else out


def word_hashes(bare: bool = False) -> WordHashes:
    """One for each worker."""
    return worker_held(("words", bare), lambda: WordHashes(bare))


def grams(words: np.ndarray, n: int, skip: int = 0) -> np.ndarray:
    """Hashes of n words that follow each other, or with skip words left out between each two."""
    step = skip + 1
    size = len(words) - (n - 1) * step
    if size <= 0:
        return np.zeros(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        out = np.full(size, (n * 64 + skip) * 0x9E3779B97F4A7C15 & (2**64 - 1), dtype=np.uint64)
        for k in range(n):
            out = (out ^ words[k * step : k * step + size]) * np.uint64(0x9FB21C651E98DF25)
            out ^= out >> np.uint64(32)
    return out


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct hashes of n-word shingles; of fewer words the whole sequence is one; of none, none."""
    if not len(words):
        return words
    return np.unique(mixed(grams(words, min(n, len(words))), n))
