"""Strassen's recursive multiplication on int64 tiles.

Seven products of half-sized blocks take the place of eight. Odd sides are padded with zeros before they are halved.
Sums and products are taken modulo 2**64, a ring, so that intermediate sums may overflow: a result that fits a long is
exact.
"""

from __future__ import annotations

import numpy as np

#: A tile with a side of at most this many is multiplied as it is.
SIDE = 32


def _padded(x: np.ndarray) -> np.ndarray:
    """x with zeros added so that both sides are even."""
    rows, columns = (n + n % 2 for n in x.shape)
    if (rows, columns) == x.shape:
        return x
    out = np.zeros((rows, columns), np.int64)
    out[: x.shape[0], : x.shape[1]] = x
    return out


def _quarters(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    i, j = x.shape[0] // 2, x.shape[1] // 2
    return x[:i, :j], x[:i, j:], x[i:, :j], x[i:, j:]


def times_transposed(a: np.ndarray, b: np.ndarray, side: int = SIDE) -> np.ndarray:
    """a @ b.T of int64 tiles whose rows are vectors. b stays as it is: its quarters are those of b.T, mirrored."""
    if min(*a.shape, len(b)) <= side:
        return np.einsum("ik,jk->ij", a, b)
    a11, a12, a21, a22 = _quarters(_padded(a))
    b11, b21, b12, b22 = _quarters(_padded(b))
    m1 = times_transposed(a11 + a22, b11 + b22, side)
    m2 = times_transposed(a21 + a22, b11, side)
    m3 = times_transposed(a11, b12 - b22, side)
    m4 = times_transposed(a22, b21 - b11, side)
    m5 = times_transposed(a11 + a12, b22, side)
    m6 = times_transposed(a21 - a11, b11 + b12, side)
    m7 = times_transposed(a12 - a22, b21 + b22, side)
    i, j = len(a11), len(b11)
    out = np.empty((2 * i, 2 * j), np.int64)
    out[:i, :j] = m1 + m4 - m5 + m7
    out[:i, j:] = m3 + m5
    out[i:, :j] = m2 + m4
    out[i:, j:] = m1 - m2 + m3 + m6
    return out[: len(a), : len(b)]
