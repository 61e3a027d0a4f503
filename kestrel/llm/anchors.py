"""Sampled suffixes of byte strings: positions chosen by content, so that equal strings choose alike.

Of the 69 stretches of 32 bytes in a 100-byte window the one of least hash (leftmost if equal) is the window's
anchor. Equal windows, wherever they are, have their anchor at the same place, so strings of 100 bytes can only
be equal if their anchors' suffixes share 32 bytes. Neighbouring windows mostly share an anchor: one anchor in
about 32 bytes stands for all windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

WINDOW = 100
CORE = 32
_PLACES = WINDOW - CORE + 1
_BLOCK = 1 << 23
_rng = np.random.default_rng(20240703)
_BYTE = _rng.integers(0, 2**64, 256, np.uint64)
_MULT = _rng.integers(0, 2**64, 8, np.uint64) | np.uint64(1)
_LOW = np.uint64((1 << 24) - 1)


def _core_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the 32 bytes from each position, by doubling."""
    h, width = _BYTE[data], 1
    for c in _MULT[:5]:
        x = h[:-width] * c
        x ^= x >> np.uint64(32)
        h = x + h[width:]
        width *= 2
    h = h * _MULT[5]
    return h ^ (h >> np.uint64(29))


def anchors(text: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Arrays (position, left, right, core hash, stretch hash) block by block: the anchor's windows lie in the stretch
    from position - left to position + right, whose bytes and anchor place the stretch hash covers."""
    data = np.frombuffer(text, np.uint8)
    for start in range(0, len(data) - WINDOW + 1, _BLOCK):
        g = _core_hashes(data[start:start + _BLOCK + WINDOW - 1])
        v = (g & ~_LOW) | np.arange(len(g), dtype=np.uint64)
        width = 1
        while width * 2 <= _PLACES:
            v = np.minimum(v[:-width], v[width:])
            width *= 2
        v = np.minimum(v[:len(v) - (_PLACES - width)], v[_PLACES - width:])
        of_window = (v & _LOW).astype(np.int64)
        cut = np.flatnonzero(np.diff(of_window)) + 1
        first = np.concatenate([[0], cut])
        end = np.concatenate([cut, [len(of_window)]]) - 1 + WINDOW
        at = of_window[first]
        stretch = (at - first).astype(np.uint64) * _MULT[6] + (end - first).astype(np.uint64) * _MULT[7]
        for i in range(3):  # 96 bytes from either end cover a stretch of at most 168
            for q in (first + CORE * i, end - CORE * (i + 1)):
                stretch = (stretch ^ g[q]) * _MULT[i]
                stretch ^= stretch >> np.uint64(31)
        yield start + at, at - first, end - at, g[at].view(np.int64), stretch.view(np.int64)


def window_hashes(text: bytes, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of the windows at these positions."""
    data = np.frombuffer(text, np.uint8)
    low = int(starts.min())
    g = _core_hashes(data[low:int(starts.max()) + WINDOW])
    out = []
    for salt in (1, 2):
        h = np.full(len(starts), salt, np.uint64) * _MULT[5 + salt]
        for q in (0, CORE, 2 * CORE, WINDOW - CORE):
            h = (h ^ g[starts - low + q]) * _MULT[salt]
            h ^= h >> np.uint64(32 - salt)
        out.append(h.view(np.int64))
    return out[0], out[1]
