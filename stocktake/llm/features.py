"""Hashed features of words for the linear models."""

from __future__ import annotations

import numpy as np
import xxhash

# Fixed multipliers that tell the places of a word in a gram apart.
_FIRST, _SECOND, _SKIPPED = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_MARKS = ".,;:!?\"'()[]{}|*$#%&-"
WORDS = 150_000  # remembered words per Python worker


class Words(dict):
    """Hashes of words without case and marks; forgets all of them when full."""

    def __missing__(self, word: str) -> int:
        bare = word.lower().strip(_MARKS)
        value = xxhash.xxh64_intdigest((bare or word).encode())
        if len(self) >= WORDS:
            self.clear()
        if len(word) <= 48:
            self[word] = value
        return value


def hashes(text: str, words: Words) -> np.ndarray:
    found = text.split()
    return np.fromiter(map(words.__getitem__, found), np.uint64, len(found))


def grams(word_hashes: np.ndarray, bits: int) -> np.ndarray:
    """Buckets of words, of neighbours, and of words one apart (skip-grams)."""
    shift = np.uint64(64 - bits)
    h = word_hashes * _FIRST
    with np.errstate(over="ignore"):
        pairs = h[:-1] ^ (word_hashes[1:] * _SECOND)
        skips = h[:-2] ^ (word_hashes[2:] * _SKIPPED)
        mixed = np.concatenate([h, pairs * _SECOND, skips * _SECOND])
    return (mixed >> shift).astype(np.int64)
