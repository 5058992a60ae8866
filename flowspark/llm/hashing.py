"""Vectorised 64-bit hashes of the words of a text. Different words get the same hash with a chance of about 2^-64."""

from __future__ import annotations

import numpy as np

_G = 0x9E3779B97F4A7C15
_BYTES = np.random.Generator(np.random.PCG64(1)).integers(1, 2**64 - 1, 256, np.uint64)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def mix(h: np.ndarray) -> np.ndarray:
    """Scatters 64-bit values, one to one."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def odd(n: int) -> np.ndarray:
    """n fixed odd multipliers."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_G)) | np.uint64(1)


def salt(i: int) -> np.uint64:
    return np.uint64((i + 1) * _G % 2**64)


# Bytes that are hashed at once; longer data is cut at separators.
_SEGMENT = 1 << 20


def word_hashes(data: bytes, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each maximal run of bytes that are not separators, and where it begins.

    A word's hash is a polynomial in its bytes, summed for all words of the data at once.
    """
    b = np.frombuffer(data, np.uint8)
    hashes, starts, at = [], [], 0
    while at < len(b) or not hashes:
        end = min(at + _SEGMENT, len(b))
        while end < len(b) and not separator[b[end]]:
            end += 1
        h, s = _segment_hashes(b[at:end], separator)
        hashes.append(h)
        starts.append(s + at)
        at = end
    return np.concatenate(hashes), np.concatenate(starts)


def _segment_hashes(b: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = ~separator[b]
    begins = inside.copy()
    begins[1:] &= separator[b[:-1]]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    at = np.flatnonzero(inside)
    first = np.flatnonzero(begins[at])
    position = at - np.repeat(starts, np.diff(np.append(first, len(at))))
    powers = np.multiply.accumulate(np.full(int(position.max()) + 1, _STEP))
    return mix(np.add.reduceat(_BYTES[b[at]] * powers[position], first)), starts


def as_signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)
