"""Word shingles as sorted distinct 64-bit hashes, by whole batches in numpy. Words are runs of anything but ASCII white
space, with A-Z in lower case; a text with fewer words than a shingle is one shingle of all of them, one without words
is the empty set."""

from __future__ import annotations

import numpy as np
import xxhash

CACHED_WORDS = 100_000
ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0xD6E8FEB86659FD93], np.uint64)

_of_word: dict[bytes, int] = {}


def mixed(h: np.ndarray) -> np.ndarray:
    """A finalizer that spreads every input bit over all 64."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(words: list[bytes], seed: int = 0) -> np.ndarray:
    if seed:
        return np.array([xxhash.xxh3_64_intdigest(w, seed) for w in words], np.uint64)
    known = _of_word
    if len(known) > CACHED_WORDS:
        known.clear()
    out = list(map(known.get, words))
    if None in out:
        for i, h in enumerate(out):
            if h is None:
                h = xxhash.xxh3_64_intdigest(words[i])
                if len(words[i]) <= 48:
                    known[words[i]] = h
                out[i] = h
    return np.array(out, np.uint64)


def rolling(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of every run of k numbers."""
    n = len(hashes) - k + 1
    total = np.zeros(max(0, n), np.uint64)
    for j in range(k):
        total += hashes[j : n + j] * (ODD[j % 8] + np.uint64(2 * (j // 8)))
    return mixed(total)


def shingle_set(text: str, k: int) -> np.ndarray:
    hashes = word_hashes(text.encode("utf-8").lower().split())
    if not len(hashes):
        return hashes
    if len(hashes) < k:
        return np.array([xxhash.xxh3_64_intdigest(hashes.tobytes(), seed=len(hashes))], np.uint64)
    return np.unique(rolling(hashes, k))
