"""Word shingles of whole texts as 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

from kestrel.llm.batches import CACHES

WORDS = 5
_CACHE_WORDS = 200_000


class _WordHash(dict):
    """Hash of each word; emptied when it has grown, so a task's memory stays bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHE_WORDS:
            self.clear()
        got = self[word] = xxhash.xxh64_intdigest(word)
        return got


_hash = _WordHash()
CACHES.append(_hash)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, element by element."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def shingle_hashes(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the word shingles: A-Z lower-cased, words between the ASCII white space; a text
    with fewer words is one shingle, one without words has none."""
    ws = text.encode("utf-8", "surrogatepass").lower().split()  # both ASCII only, on bytes
    if not ws:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_hash.__getitem__, ws), np.uint64, len(ws))
    k = min(words, len(h))
    out = np.full(len(h) - k + 1, k, np.uint64)
    for i in range(k):
        out = mix(out + h[i:len(h) - k + 1 + i])
    return np.unique(out)
