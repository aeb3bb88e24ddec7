import math
import random

import numpy as np
from pyspark.sql import functions as F

from tramloom.llm import balltree


def brute(rows, k=5):
    fine = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, v in dict((i, v) for i, v in fine if i % 50 == 0).items():
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in fine if i != q and len(w) == len(v))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def _against(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = sorted(tuple(r) for r in balltree.top_k(df, F.col("vec_id") % 50 == 0, **options).collect())
    assert got == brute(rows)


def test_random_vectors_ties_and_odd_ones(spark):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 1) for _ in range(12)]) for i in range(1500)]
    rows += [(2000 + i, rows[i % 3][1]) for i in range(40)]  # ties
    rows += [(3000, None), (3050, []), (3100, [None] * 12), (3150, [float("nan")] * 12), (3200, [float("inf")] + [0.0] * 11), (None, [1.0] * 12), (3250, [1.0, 2.0]), (3251, [1.0, -2.0]), (3300, [0.0] * 12)]
    _against(spark, rows)
    _against(spark, rows, block_bytes=1000, pilot=16)


def test_few_and_no_vectors(spark):
    _against(spark, [(0, [1.0, 2.0]), (1, [2.0, 1.0]), (50, [0.5, 0.5])])
    _against(spark, [(0, [1.0])])
    assert balltree.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.col("vec_id") % 50 == 0).collect() == []


def test_search_leaves_most_of_a_clustered_tree_out():
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 300, (30, 16))
    points = np.floor(np.concatenate([c + rng.normal(0, 5, (200, 16)) for c in centres]))
    tree = balltree.BallTree(points)
    seen = []

    class Watched(balltree.Best):
        def offer(self, q, score, ident):
            seen.append(score.size)
            super().offer(q, score, ident)

    queries = points[::100]
    best = Watched(np.full((len(queries), 5), balltree._NONE), np.full((len(queries), 5), 1 << 62))
    balltree.search(tree, np.arange(len(points)), queries, np.full(len(queries), -1), best, np.full(len(queries), balltree._NONE))
    assert sum(seen) < 0.4 * len(queries) * len(points)
    want = np.sort(queries @ points.T, axis=1)[:, ::-1][:, :5]
    assert (best.score == want).all()


def _watched(points, queries, own, floor, k=5):
    """The best of the queries, with the number of times that a leaf met queries."""
    met = []

    class Watched(balltree.Best):
        def offer(self, q, score, ident):
            met.append(score.shape)
            super().offer(q, score, ident)

    ident = np.arange(len(points))
    best = Watched(np.full((len(queries), k), balltree._NONE), np.full((len(queries), k), np.iinfo(np.int64).max))
    balltree.search(balltree.BallTree(points), ident, queries, own, best, floor)
    return best, len(met)


def test_vectors_that_point_everywhere_meet_queries_many_at_once():
    rng = np.random.default_rng(4)
    points = np.floor(rng.normal(0, 32, (4096, 64)))
    points[2000:2040] = points[:40]  # ties
    own = np.arange(0, 4096, 16)
    queries = points[own]
    score = queries @ points.T
    score[np.arange(len(own)), own] = -np.inf
    order = np.lexsort((np.broadcast_to(np.arange(4096), score.shape), -score), axis=1)[:, :5]
    want = np.take_along_axis(score, order, 1)
    for floor in (np.full(len(own), balltree._NONE), want[:, -1].astype(np.int64), want[:, 0].astype(np.int64)):
        best, met = _watched(points, queries, own, floor)
        assert met <= 64 * 7  # 64 leaves in waves of 1, 2, 4, ..., 32 and 1; by single leaves there were thousands
        fine = want >= floor[:, None]
        assert (best.score[fine] == want[fine]).all() and (best.ident[fine] == order[fine]).all()
        assert (best.score[~fine] < np.broadcast_to(floor[:, None], fine.shape)[~fine]).all()


def test_greatest_id_and_floors_that_few_reach(spark):
    top = np.iinfo(np.int64).max
    rows = [(top, [1.0, 1.0]), (top - 1, [1.0, 1.0]), (50, [1.0, 0.0]), (51, [-1.0, 0.0]), (100, [0.0, 0.0])]
    _against(spark, rows)
    _against(spark, rows, pilot=1)
    _against(spark, [(i, [float(i % 7), 1.0]) for i in range(700)], pilot=650)
