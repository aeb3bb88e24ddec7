"""Exact quantiles of whole columns in a few rounds, whatever the number of distinct values.

``percentile`` keeps every distinct value of a column in one buffer. Here a sketch (``percentile_approx``) names two
values around each rank, one aggregate counts what lies below and between them, and the next round looks at the rows
between them only. A rank is settled when it falls on one of its bounds, or when few enough rows are left to fetch.
Every round is one scan with bounded state: sketches, counts, and LIMIT values a rank at the end.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramloom.sources.tables import materialize

#: Rows that are fetched for a rank; accuracy of the sketches.
LIMIT, ACCURACY = 10_000, 10_000


@dataclass
class _Search:
    """A rank among the values strictly between two bounds (None: open), of which ``below`` and ``inside`` are counted."""

    rank: int
    inside: int
    below: int = 0
    low: float | None = None
    high: float | None = None
    found: float | None = None

    def holds(self, x: Column) -> Column:
        test = F.lit(True)
        if self.low is not None:
            test = test & (x > self.low)
        return test if self.high is None else test & (x < self.high)

    def share(self, off: float) -> float:
        return min(1.0, max(0.0, (self.rank - self.below) / max(1, self.inside - 1) + off))


def _narrowed(values: DataFrame, searches: list[_Search], accuracy: int) -> None:
    """One round: bounds by sketches, then exact counts of what lies under and at them."""
    x = F.col("x")
    spread = 2.0 / accuracy
    marks = values.agg(*[F.percentile_approx(F.when(s.holds(x), x), [s.share(-spread), s.share(spread)], accuracy).alias(f"q{i}") for i, s in enumerate(searches)]).first()
    ends = [marks[f"q{i}"] for i in range(len(searches))]
    counts = [F.count_if(s.holds(x) & test).alias(f"{name}{i}") for i, (s, e) in enumerate(zip(searches, ends, strict=True)) for name, test in (("a", x < e[0]), ("b", x <= e[0]), ("c", x < e[1]), ("d", x <= e[1]))]
    row = values.agg(*counts).first()
    for i, (s, (low, high)) in enumerate(zip(searches, ends, strict=True)):
        a, b, c, d = (s.below + row[f"{n}{i}"] for n in "abcd")
        if a <= s.rank < b:
            s.found = low
        elif c <= s.rank < d:
            s.found = high
        elif s.rank < a:  # a sketch may err: the part under both, between them, or over both
            s.high, s.inside = low, a - s.below
        elif s.rank < c:
            s.low, s.high, s.inside, s.below = low, high, c - b, b
        else:
            s.low, s.inside, s.below = high, s.below + s.inside - d, d


def _settled(values: DataFrame, ranks: list[int], n: int, limit: int, accuracy: int) -> dict[int, float]:
    searches = [_Search(r, n) for r in ranks]
    while wide := [s for s in searches if s.found is None and s.inside > limit]:
        _narrowed(values, wide, accuracy)
    if left := [s for s in searches if s.found is None]:
        x, wanted = F.col("x"), F.lit(False)
        for s in left:
            wanted = wanted | s.holds(x)
        held = values.where(wanted).groupBy("x").agg(F.count("*").alias("n")).toPandas().sort_values("x")
        known, upto = held["x"].to_numpy(), held["n"].to_numpy()
        for s in left:
            first = 0 if s.low is None else int(np.searchsorted(known, s.low, "right"))
            s.found = float(known[first + np.searchsorted(np.cumsum(upto[first:]), s.rank - s.below, "right")])
    return {s.rank: s.found for s in searches}


def quantiles(rows: DataFrame, wanted: Mapping[str, tuple[Column, Sequence[float]]], limit: int = LIMIT, accuracy: int = ACCURACY) -> dict[str, list[float | None]]:
    """Of each named column its quantiles, interpolated between neighbours as ``percentile`` does; None where all is null.

    The columns are written once; then each has its own rounds.
    """
    held = materialize(rows.select(*[c.cast("double").alias(name) for name, (c, _) in wanted.items()]), "values")
    total = held.agg(*[F.count(c).alias(c) for c in wanted]).first()
    out = {}
    for name, (_, shares) in wanted.items():
        n = total[name]
        if not n:
            out[name] = [None for _ in shares]
            continue
        places = [(n - 1) * p for p in shares]
        known = _settled(held.where(F.col(name).isNotNull()).select(F.col(name).alias("x")), sorted({f(p) for p in places for f in (math.floor, math.ceil)}), n, limit, accuracy)
        out[name] = [known[math.floor(p)] + (p - math.floor(p)) * (known[math.ceil(p)] - known[math.floor(p)]) if p % 1 else known[int(p)] for p in places]
    return out
