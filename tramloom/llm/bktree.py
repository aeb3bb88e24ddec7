"""Burkhard-Keller trees over 64-bit fingerprints, as arrays, and union-find over what they find.

A node's children are keyed by their Hamming distance to it. A search at radius r follows, from a node at distance d,
only the edges from d - r to d + r. Many small trees form one forest; all steps are made for whole levels at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_BITS = 65


class Forest:
    """Trees over ``codes`` (uint64), one for each value of ``tree``; ``tree`` is sorted."""

    def __init__(self, codes: np.ndarray, tree: np.ndarray) -> None:
        n = len(codes)
        self.codes = codes
        starts = np.flatnonzero(np.r_[True, tree[1:] != tree[:-1]]) if n else np.empty(0, np.int64)
        sizes = np.diff(np.r_[starts, n])
        self.root = np.repeat(starts, sizes)
        self.largest = int(sizes.max(initial=0))
        key = np.full(n, -1, np.int64)
        at = self.root.copy()
        waiting = np.flatnonzero(np.arange(n) != self.root)
        while len(waiting):
            edge = at[waiting] * _BITS + np.bitwise_count(codes[waiting] ^ codes[at[waiting]])
            unique, first, of = np.unique(edge, return_index=True, return_inverse=True)
            child = waiting[first]
            key[child] = unique
            at[waiting] = child[of]
            waiting = waiting[waiting != child[of]]
        self.nodes = np.argsort(key, kind="stable")
        self.keys = key[self.nodes]

    def pairs(self, radius: int, room: int = 4_000_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All pairs (i, j), j < i, of one tree within the radius, some at a time; ``room`` bounds the pairs held."""
        n = len(self.codes)
        step = max(64, room // max(64, self.largest))
        for low in range(0, n, step):
            q = np.arange(low, min(n, low + step))
            node = self.root[q]
            while len(q):
                d = np.bitwise_count(self.codes[q] ^ self.codes[node]).astype(np.int64)
                near = (d <= radius) & (node < q)
                if near.any():
                    yield q[near], node[near]
                left = np.searchsorted(self.keys, node * _BITS + np.maximum(0, d - radius), "left")
                right = np.searchsorted(self.keys, node * _BITS + np.minimum(_BITS - 1, d + radius), "right")
                many = right - left
                q = np.repeat(q, many)
                node = self.nodes[np.repeat(left - np.r_[0, np.cumsum(many)[:-1]], many) + np.arange(many.sum())] if len(many) else node[:0]


def find(parent: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Roots of x; paths of x are shortened."""
    root = parent[x]
    while True:
        above = parent[root]
        if (above == root).all():
            break
        root = above
    parent[x] = root
    return root


def unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the sets of each a and b; a root is the least index of its set."""
    while len(a):
        ra, rb = find(parent, a), find(parent, b)
        apart = ra != rb
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))
