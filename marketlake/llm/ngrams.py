"""Hashed character n-grams of whole texts, in numpy."""

from __future__ import annotations

import numpy as np

_MIX = np.uint64(0x9E3779B97F4A7C15)
_SPREAD = np.uint64(0xD6E8FEB86659FD93)
SEGMENT = 1 << 20


def buckets(text: str, low: int, high: int, bits: int):
    """Yield arrays of bucket numbers (``bits`` wide), one per n-gram
    occurrence of ``low`` to ``high`` code points, in segments of bounded
    size; n-grams across segment borders are included once."""
    shift = np.uint64(64 - bits)
    for at in range(0, len(text), SEGMENT):
        piece = text[at:at + SEGMENT + high - 1]
        cp = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
        starts = min(SEGMENT, len(piece))
        h = cp
        for n in range(2, high + 1):
            if len(cp) < n:
                break
            h = h[:-1] * _MIX + cp[n - 1:]
            if n >= low:
                yield ((h[:starts] * _SPREAD) >> shift).astype(np.int32)


def counted(text: str, low: int, high: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and their counts."""
    parts = list(buckets(text, low, high, bits))
    if not parts:
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    return np.unique(np.concatenate(parts), return_counts=True)
