"""Hashes of whole Arrow string arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from lexmill.llm import vec


def hashes(strings: pa.Array, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each string's UTF-8 bytes; of a null, that of the empty string."""
    strings = strings.cast(pa.large_binary())
    if strings.null_count:
        strings = strings.fill_null(b"")
    offsets = np.frombuffer(strings.buffers()[1], np.int64)[strings.offset : strings.offset + len(strings) + 1]
    if not len(strings):
        return np.zeros(0, np.uint64)
    lo, hi = int(offsets[0]), int(offsets[-1])
    data = np.frombuffer(strings.buffers()[2], np.uint8)[lo:hi] if hi > lo else np.zeros(0, np.uint8)
    pw, inv = vec.powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(vec.char_table()[data] * pw[: len(data)], out=total[1:])
    a, b = offsets[:-1] - lo, offsets[1:] - lo
    return vec.mix(((total[b] - total[a]) * inv[a] + (b - a).astype(np.uint64)) ^ np.uint64(vec.mix(np.array([seed], np.uint64))[0]))
