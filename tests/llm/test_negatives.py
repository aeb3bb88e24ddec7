import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tramloom.llm import negatives
from tramloom.llm.strassen import times_transposed


def brute(rows, low=80, high=100, k=5):
    fine = [(i, label, [math.floor(256 * x) for x in v]) for i, v, label in rows if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, label, v in {(i, y, tuple(v)) for i, y, v in fine if i % 100 == 0}:
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, m) for i, m, w in fine if i != a and len(w) == len(v))
        for p, positive, _ in [s for s in scored if s[2] == label][:k]:
            inside = [(n, i) for n, i, m in scored if m != label and low * -p <= 100 * -n <= high * -p]
            out += [(a, positive, r + 1, i, -p, -n) for r, (n, i) in enumerate(inside[:k])]
    return sorted(out)


def _against(spark, rows, low=80, high=100, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    got = sorted(tuple(r) for r in negatives.mine_negatives(df, F.col("vec_id") % 100 == 0, low=low, high=high, **options).collect())
    assert got == brute(rows, low, high)
    return got


@pytest.mark.parametrize("shape", [(1, 1, 1), (5, 3, 7), (64, 64, 64), (70, 33, 129), (40, 200, 41), (0, 8, 5), (129, 65, 66)])
def test_products_are_exact(shape):
    rng = np.random.default_rng(sum(shape))
    n, d, m = shape
    a, b = rng.integers(-(1 << 28), 1 << 28, (n, d)), rng.integers(-(1 << 28), 1 << 28, (m, d))
    want = a.astype(object) @ b.astype(object).T
    for side in (1, 4, 32):
        assert (times_transposed(a, b, side) == want).all()


def test_products_whose_sums_overflow_on_the_way():
    a = np.full((8, 8), (1 << 28), np.int64)
    a[::2] *= -1
    assert (times_transposed(a, a, 1) == a.astype(object) @ a.astype(object).T).all()


def test_heaps_merge_in_any_order():
    rng = random.Random(1)
    entries = [(rng.randrange(6), rng.randrange(-9, 9), i) for i in range(500)] + [(2, negatives.NONE + 1, 9)]
    for cut in (1, 7, 100, 501):
        h = negatives.Heaps(7, 4)
        for at in range(0, len(entries), cut):
            h.offer(*(np.array(x, np.int64) for x in zip(*entries[at : at + cut])))
        want = {(o, s, i) for k in range(7) for o, s, i in sorted((e for e in entries if e[0] == k), key=lambda e: (-e[1], e[2]))[:4]}
        assert set(zip(*(x.tolist() for x in h.entries()))) == want


def test_random_vectors_ties_and_odd_ones(spark):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0.4, 1) for _ in range(12)], rng.randrange(4)) for i in range(1200)]
    rows += [(2000 + i, rows[100 * (i % 3)][1], i % 4) for i in range(60)]  # ties with anchors
    rows += [rows[200], rows[201], (300, rows[5][1], 1)]  # rows alike, an id with two vectors
    rows += [(3000, None, 1), (3100, [], 1), (3200, [None] * 12, 1), (3300, [float("nan")] * 12, 1), (3400, [float("inf")] + [0.0] * 11, 1), (None, [1.0] * 12, 1), (3500, [1.0] * 12, None), (3600, [0.0] * 12, 2), (-100, [1.0] * 12, 3), (3700, [1.0, 2.0], 0), (3701, [1.0, 2.0], 0), (3702, [1.0, 1.9], 1)]
    assert {r[0] for r in _against(spark, rows)} > {0, 200, 300, -100, 3700}
    _against(spark, rows, block_bytes=1000, task_rows=200, tile=50)
    _against(spark, rows, low=0, high=150)


def test_scores_below_zero_and_of_zero(spark):
    rows = [(0, [1.0, 0.0], 0), (1, [-1.0, 0.0], 0), (2, [0.0, 1.0], 0), (3, [-0.9, 0.0], 1), (4, [0.0, 2.0], 1), (5, [0.0, 0.0], 1)]
    assert _against(spark, rows) == [(0, 2, 1, 4, 0, 0), (0, 2, 2, 5, 0, 0)]


def test_none_alone_and_no_partner(spark):
    assert _against(spark, [(0, [1.0], 0)]) == []
    assert _against(spark, [(0, [1.0], 0), (1, [1.0], 1)]) == []
    assert _against(spark, [(0, [1.0], 0), (1, [1.0], 0)]) == []
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert negatives.mine_negatives(empty, F.col("vec_id") % 100 == 0).collect() == []


def test_large_components_are_held_at_the_bound(spark):
    rows = [(0, [1e300, 1.0], 0), (1, [1e300, 0.0], 0), (2, [1e300, 2.0], 1), (3, [-1e300, 2.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = [tuple(r)[:4] for r in negatives.mine_negatives(df, F.col("vec_id") % 100 == 0).collect()]
    bound = math.isqrt(1 << 59)
    assert got in ([], [(0, 1, 1, 2)])
    row = negatives.mine_negatives(df, F.col("vec_id") % 100 == 0, low=0, high=200).first()
    assert (row["positive_score"], row["negative_score"]) == (bound * bound, bound * bound + 256 * 512)


def test_columns_of_the_operators_names(spark):
    df = spark.createDataFrame([(0, [1.0], 0, 1, "x"), (1, [1.0], 0, 1, "x"), (2, [0.9], 1, 1, "x")], "vec_id long, embedding array<double>, label int, id int, asked string")
    assert [tuple(r) for r in negatives.mine_negatives(df, F.col("vec_id") % 100 == 0).collect()] == [(0, 1, 1, 2, 65536, 58880)]
