"""Hashed word shingles."""

from __future__ import annotations

import re

import numpy as np
import xxhash

ASCII_WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def blank_words(text: str) -> list[str]:
    """Words between ASCII white space, A to Z in lower case and no other letter changed."""
    return ASCII_WORD.findall(text.lower() if text.isascii() else text.translate(LOWER))


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


class WordHashes(dict):
    """Hashes of words, each computed once, in a cache of bounded size."""

    def __missing__(self, word: str) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[str]) -> np.ndarray:
        if len(self) > 400_000:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` (at most five) words, or of all words where there are fewer."""
    size = min(size, len(words))
    if not size:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(words) - size + 1, np.uint64)
    for k in range(size):
        total += words[k : len(words) - size + 1 + k] * MULTIPLIERS[k]
    return mixed(total + np.uint64(size))
