"""Hilbert curve index of points on a grid, for whole columns of points."""

from __future__ import annotations

import numpy as np


def hilbert_index(axes: np.ndarray, bits: int) -> np.ndarray:
    """Place on the curve of points ``axes`` (``[points, dims]``, each 0 .. 2**bits - 1) as int64;
    ``bits * dims`` is at most 62.

    From the highest bit down, the orthant of each point reflects or swaps the axes below it; what
    is left, Gray-decoded and interleaved, is the index.  Points next to each other on the curve
    differ by one in one axis.
    """
    x = axes.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(dims):
            up = (x[i] & q) != 0
            x[0] = np.where(up, x[0] ^ p, x[0])
            t = np.where(up, 0, (x[0] ^ x[i]) & p)
            x[0] ^= t
            x[i] ^= t
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[dims - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            out = (out << 1) | ((x[i] >> b) & 1)
    return out
