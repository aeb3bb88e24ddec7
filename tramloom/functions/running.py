"""The exact median of all earlier values, for every row, in linear time and by slices.

1. A histogram of each key's slices is made by one aggregate (map-side combined).
2. Each key's histograms pass once, in order, through a running histogram, whose size is the number of distinct values
   (seconds under a cap, say), not of rows. A slice of m rows can move the median by m places at most, so its carry is
   the part of the history within m places of the median, and the number of rows below that.
3. Slices run apart from each other: a Fenwick tree over the carry and the slice's own values takes each row in
   logarithmic time.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of the key before the slice, values among them, those below the carried ones, carried values and their counts.
_CARRY = {"__prior": "long", "__known": "long", "__below": "long", "__values": "array<double>", "__counts": "array<long>"}


class Fenwick:
    """Counts of sorted values, with the value of any rank."""

    def __init__(self, counts: np.ndarray) -> None:
        self.n = len(counts)
        sums = np.concatenate([[0], np.cumsum(counts)])
        at = np.arange(1, self.n + 1)
        self.tree = [0, *(sums[at] - sums[at - (at & -at)]).tolist()]
        self.top = 1 << max(0, self.n.bit_length() - 1)

    def add(self, i: int) -> None:
        i += 1
        while i <= self.n:
            self.tree[i] += 1
            i += i & -i

    def at_rank(self, rank: int) -> int:
        """The place of the value of this rank, from 0."""
        place, step = 0, self.top
        while step:
            if (after := place + step) <= self.n and self.tree[after] <= rank:
                place, rank = after, rank - self.tree[after]
            step >>= 1
        return place


class History:
    """A running histogram, from which slices take their carry."""

    def __init__(self) -> None:
        self.rows = 0
        self.values, self.counts = np.empty(0), np.empty(0, np.int64)

    def carry(self, values: np.ndarray, counts: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
        """(number below, values, earlier counts) for a slice with these values: the neighbourhood of the median and the slice's own."""
        m, n = int(counts.sum()), int(self.counts.sum())
        if not n:
            return 0, values, np.zeros(len(values), np.int64)
        upto = np.cumsum(self.counts)
        low = int(np.searchsorted(upto, max(0, (n - 1) // 2 - m - 1), "right"))
        high = int(np.searchsorted(upto, min(n - 1, n // 2 + m + 1), "right"))
        near, known = self.values[low : high + 1], self.counts[low : high + 1]
        every = np.union1d(near, values)
        before = np.zeros(len(every), np.int64)
        before[np.searchsorted(every, near)] = known
        return int(upto[low] - self.counts[low]), every, before

    def take(self, values: np.ndarray, counts: np.ndarray, rows: int) -> None:
        every = np.union1d(self.values, values)
        sums = np.zeros(len(every), np.int64)
        sums[np.searchsorted(every, self.values)] = self.counts
        sums[np.searchsorted(every, values)] += counts
        self.values, self.counts, self.rows = every, sums, self.rows + rows


    def medians_without(self, taken: Sequence[float]) -> list[float | None]:
        """The median of all values but the first of ``taken``, but the first two, and so on."""
        left, out = self.counts.copy(), []
        for v in taken:
            left[np.searchsorted(self.values, v)] -= 1
            upto = np.cumsum(left)
            n = int(upto[-1])
            out.append(float(self.values[np.searchsorted(upto, [(n - 1) // 2, n // 2], "right")].mean()) if n else None)
        return out


def _histories(keys: Sequence[str]):
    """For mapInArrow over (keys, __slice, value, n) in order: the carry of each slice. A key's slices may lie in several batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        history, key, part, own = History(), None, None, []
        out: list[tuple] = []

        def close() -> None:
            known = sorted((v, n) for v, n in own if v is not None)
            values, counts = np.array([v for v, _ in known], float), np.array([n for _, n in known], np.int64)
            below, every, before = history.carry(values, counts)
            out.append((*key, part, history.rows, int(history.counts.sum()), below, every.tolist(), before.tolist()))
            history.take(values, counts, sum(n for _, n in own))

        for b in batches:
            names = b.schema.names
            columns = [b.column(i).to_pylist() for i in range(b.num_columns)]
            for *k, s, v, n in zip(*columns, strict=True):
                if own and (k != key or s != part):
                    close()
                    own = []
                    if k != key:
                        history = History()
                key, part = k, s
                own.append((v, n))
            if len(out) >= 1000:
                yield _batch(out, b.schema, names, len(keys))
                out = []
            last = b.schema
        if own:
            close()
        if out:
            yield _batch(out, last, last.names, len(keys))

    return run


def _batch(out: list[tuple], schema: pa.Schema, names: list[str], keys: int) -> pa.RecordBatch:
    kinds = [*[schema.field(i).type for i in range(keys + 1)], pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.int64())]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=[*names[: keys + 1], *_CARRY])


def _medians(kept: Sequence[str], value: str):
    """For mapInArrow over carries, each followed by its slice's rows in order: the rows with the median of all before, and their place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, place_of, values, below, known, place = Fenwick(np.empty(0, np.int64)), {}, [], 0, 0, 0
        for b in batches:
            column = {c: b.column(b.schema.get_field_index(c)) for c in b.schema.names}
            prior, total, under, lists, counts = (column[c].to_pylist() for c in _CARRY)
            rows, medians, places = [], [], []
            for i, (p, v) in enumerate(zip(prior, column[value].to_pylist(), strict=True)):
                if p is not None:  # a new slice
                    place, known, below, values = p, total[i], under[i], lists[i]
                    tree, place_of = Fenwick(np.array(counts[i], np.int64)), {x: j for j, x in enumerate(values)}
                    continue
                rows.append(i)
                places.append(place)
                place += 1
                medians.append((values[tree.at_rank((known - 1) // 2 - below)] + values[tree.at_rank(known // 2 - below)]) / 2 if known else None)
                if v is not None:
                    tree.add(place_of[float(v)])
                    known += 1
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([*[column[c].take(at) for c in kept], pa.array(medians, pa.float64()), pa.array(places, pa.int64())], names=[*kept, *ADDED])

    return run


ADDED = ("__median", "__place")


def medians_before(rows: DataFrame, keys: Sequence[str], part: str, order: Sequence[str], value: str) -> DataFrame:
    """rows with __median, the exact median of the key's earlier values (nulls don't count, of none it is null), and __place, the number of its earlier rows.

    ``part`` is a whole number that never falls along ``order``; rows of one part of a key are one task's. Keys are
    columns without nulls that order.
    """
    kinds = dict(rows.dtypes)
    names = [*keys, part]
    histograms = rows.groupBy(*names, F.col(value).cast("double").alias("__value")).agg(F.count("*").alias("__n"))
    shape = ", ".join(f"`{c}` {t}" for c, t in [*[(c, kinds[c]) for c in names], *_CARRY.items()])
    carries = histograms.repartition(*keys).sortWithinPartitions(*names).mapInArrow(_histories(keys), shape)
    # carries come first in their slice: true sorts after false
    both = rows.withColumn("__row", F.lit(True)).unionByName(carries.withColumn("__row", F.lit(False)), allowMissingColumns=True)
    both = both.repartition(*names).sortWithinPartitions(*names, "__row", *order)
    shape = ", ".join(f"`{c}` {t}" for c, t in [*rows.dtypes, ("__median", "double"), ("__place", "long")])
    return both.mapInArrow(_medians(rows.columns, value), shape)
