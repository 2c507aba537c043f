"""Places on Hilbert curves, for many points at once."""

from __future__ import annotations

import numpy as np


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each point on the Hilbert curve over a grid of ``2**bits`` cells a side.

    ``cells`` is (points, dimensions) of unsigned integers below ``2**bits``; dimensions
    times bits is at most 63.  Points near on the curve are near in space.  The method is
    Skilling's (2004): undo the rotations and reflections from the highest bit down, Gray
    code, then interleave the bits.
    """
    x = [cells[:, i].astype(np.uint32) for i in range(cells.shape[1])]
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = np.uint32(q - 1)
        for i in range(n):
            set_ = (x[i] & np.uint32(q)) != 0
            swap = (x[0] ^ x[i]) & p
            first = np.where(set_, x[0] ^ p, x[0] ^ swap)
            if i:
                x[i] = np.where(set_, x[i], x[i] ^ swap)
            x[0] = first
        q >>= 1
    for i in range(1, n):
        x[i] = x[i] ^ x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[n - 1] & np.uint32(q)) != 0, t ^ np.uint32(q - 1), t)
        q >>= 1
    key = np.zeros(len(t), np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | (((x[i] ^ t) >> np.uint32(b)) & np.uint32(1)).astype(np.int64)
    return key
