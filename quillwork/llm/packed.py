"""Rows of small numbers as compressed bytes."""

from __future__ import annotations

import numpy as np
import zstandard


def packed(numbers: np.ndarray) -> bytes:
    """Numbers below 2 ** 32: bytes of equal weight side by side, compressed."""
    planes = numbers.astype("<u4").view("u1").reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpacked(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), "u1").reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()
