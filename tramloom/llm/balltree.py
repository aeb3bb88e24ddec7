"""Exact top-k by inner product: a ball tree per shard, searched by branch and bound.

Every shard's vectors form a ball tree. A node's upper bound for a query is q.c + |q| r; nodes are taken in the order
of their bounds, and a node is left out once its bound is under the query's kth score so far. That score is shared:
it starts from a pilot, in which every query meets a bounded sample of candidates, and is handed from shard to shard
within a task. Leaves are taken in waves, each query's best one, then its next two, four and so on: a leaf meets all
queries of its wave at once, and a shard of n leaves takes n log n such meetings at most, not n * n. Vectors that point
everywhere alike have bounds that leave nothing out: then every query meets every vector, by matrix products.

Queries are broadcast in blocks of BLOCK_BYTES. A shard's tree is built once a block and met by the block's queries some
thousands at a time. With more than one block, candidates are prepared once and each block's finds are written.

Defined results: vectors null, empty, or with null or non-finite components take no part; a query meets only vectors
of its own length; rows with the query's id count as its own; fewer than k candidates give fewer rows; k ties go to
smaller ids. Scores are exact while they stay under 2**53.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tramloom.llm.common import col, materialize

K = 5
#: Rows of a shard, of a leaf, of the pilot sample, of queries that meet a tree at once.
SHARD, LEAF, PILOT, AT_ONCE = 16_384, 64, 4_096, 4_096
#: Bytes of queries that one broadcast holds.
BLOCK_BYTES = 32_000_000
_NONE = -(1 << 62)


class BallTree:
    """Levels of nodes over points; node i of a level has children 2i and 2i + 1 of the next. Leaves are slices of order."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF) -> None:
        n = len(points)
        depth = max(0, int(np.ceil(np.log2(max(1, n / leaf)))))
        order, bounds = np.arange(n), [0, n]
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        for level in range(depth + 1):
            centre, radius = np.zeros((len(bounds) - 1, points.shape[1])), np.zeros(len(bounds) - 1)
            cuts = [0]
            for i, (low, high) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
                own = points[order[low:high]]
                if len(own):
                    centre[i] = own.mean(0)
                    radius[i] = np.sqrt(((own - centre[i]) ** 2).sum(1).max())
                if level < depth:
                    middle = (low + high) // 2
                    if len(own) > 1:
                        widest = own[:, np.argmax(own.max(0) - own.min(0))]
                        order[low:high] = order[low:high][np.argpartition(widest, middle - low)]
                    cuts += [middle, high]
            self.levels.append((centre, radius))
            bounds = cuts if level < depth else bounds
        self.points, self.order, self.bounds = points, order, bounds


class Best:
    """The k best (score, smaller id) of each query so far."""

    def __init__(self, score: np.ndarray, ident: np.ndarray) -> None:
        self.score, self.ident = score, ident

    @staticmethod
    def of(queries: int, k: int) -> Best:
        return Best(np.full((queries, k), _NONE, np.int64), np.full((queries, k), np.iinfo(np.int64).max, np.int64))

    def part(self, some: slice) -> Best:
        """The same memory, for some of the queries."""
        return Best(self.score[some], self.ident[some])

    def offer(self, q: np.ndarray, score: np.ndarray, ident: np.ndarray) -> None:
        """For queries q (distinct), rows of scores of the same ids; -inf is no score."""
        k = self.score.shape[1]
        kth, last = self.score[q, -1], self.ident[q, -1]
        at = np.flatnonzero(score >= kth.astype(np.float64)[:, None])
        row, s, i = at // len(ident), score.ravel()[at].astype(np.int64), ident[at % len(ident)]
        better = (s > kth[row]) | (i < last[row])
        row, s, i = row[better], s[better], i[better]
        if not len(row):
            return
        own = np.unique(row)
        owner = np.r_[np.repeat(own, k), row]
        s, i = np.r_[self.score[q[own]].ravel(), s], np.r_[self.ident[q[own]].ravel(), i]
        order = np.lexsort((i, -s, owner))
        owner = owner[order]
        kept = order[np.arange(len(owner)) - np.searchsorted(owner, owner) < k]
        self.score[q[own]], self.ident[q[own]] = s[kept].reshape(-1, k), i[kept].reshape(-1, k)

    def kth(self) -> np.ndarray:
        return self.score[:, -1]


def search(tree: BallTree, ident: np.ndarray, queries: np.ndarray, own: np.ndarray, best: Best, floor: np.ndarray) -> None:
    """Offer best all points of the tree that can be among the k best. floor: a lower bound of each query's kth score."""
    norm = np.sqrt((queries**2).sum(1))

    def bounds(level: int, nodes: slice = slice(None)) -> np.ndarray:
        centre, radius = tree.levels[level]
        top = queries @ centre[nodes].T + norm[:, None] * radius[None, nodes]
        return top + 1e-9 * np.abs(top) + 0.5  # scores are integers, so this covers rounding

    under = best.score < floor[:, None] - 1  # what can't be among the k best makes way for what keeps the like out
    best.score[under], best.ident[under] = np.broadcast_to(floor[:, None] - 1, under.shape)[under], np.iinfo(np.int64).max
    here = np.isin(own, ident)
    alive = np.ones((len(queries), 1), bool)
    least = best.kth()
    for level in range(len(tree.levels)):
        if level:
            alive = np.repeat(alive, 2, axis=1)
        top = bounds(level)
        alive &= top >= least[:, None]
    top = np.where(alive, top, -np.inf)
    rank = np.argsort(-top, axis=1, kind="stable")
    first = 0
    while first < rank.shape[1]:
        wave = rank[:, first : 2 * first + 1]
        first = 2 * first + 1
        row, place = np.nonzero(np.take_along_axis(top, wave, 1) >= best.kth()[:, None])
        if not len(row):
            break
        leaf = wave[row, place]
        by = np.argsort(leaf, kind="stable")
        row, leaf = row[by], leaf[by]
        cuts = np.flatnonzero(np.r_[True, leaf[1:] != leaf[:-1], True])
        for low, high in zip(cuts[:-1], cuts[1:], strict=True):
            q, node = row[low:high], leaf[low]
            q = q[top[q, node] >= best.kth()[q]]  # the wave's other leaves may have raised it
            rows = tree.order[tree.bounds[node] : tree.bounds[node + 1]]
            if len(rows) and len(q):
                score, names = queries[q] @ tree.points[rows].T, ident[rows]
                at = np.flatnonzero(here[q])
                score[at] = np.where(names == own[q[at], None], -np.inf, score[at])
                best.offer(q, score, names)


def search_all(tree: BallTree, ident: np.ndarray, queries: np.ndarray, own: np.ndarray, best: Best, floor: np.ndarray) -> None:
    for low in range(0, len(queries), AT_ONCE):
        some = slice(low, low + AT_ONCE)
        search(tree, ident, queries[some], own[some], best.part(some), floor[some])


def usable(v: Column) -> Column:
    inf = float("inf")
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(inf))
    return v.isNotNull() & (F.size(v) > 0) & F.forall(v, fine)


def _arrays(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, vectors) of the rows of each vector length."""
    lists = batch.column("v")
    length = np.diff(lists.offsets.to_numpy())
    flat, ident, start = lists.values.to_numpy(zero_copy_only=False), batch.column("id").to_numpy(zero_copy_only=False), lists.offsets.to_numpy()[:-1]
    for n in np.unique(length):
        rows = np.flatnonzero(length == n)
        yield ident[rows].astype(np.int64), flat[start[rows, None] + np.arange(n)].astype(np.float64)


def _floors(shared, k: int):
    """For mapInArrow over queries (id, v): a lower bound of each one's kth score, by the pilot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = {n: (names, BallTree(points)) for n, (names, points) in shared.value.items()}
        for b in batches:
            for ident, q in _arrays(b):
                best = Best.of(len(ident), k)
                if q.shape[1] in trees:
                    names, tree = trees[q.shape[1]]
                    search_all(tree, names, q, ident, best, np.full(len(ident), _NONE, np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(ident), pa.array(list(q), pa.list_(pa.float64())), pa.array(best.kth())], names=["id", "v", "floor"])

    return run


def _search(shared, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = {n: (own, q, Best.of(len(own), k), floor) for n, (own, q, floor) in shared.value.items()}
        held: dict[int, list] = {}

        def flush(n: int) -> None:
            ident, points = (np.concatenate(x) for x in zip(*held.pop(n), strict=True))
            own, queries, best, floor = blocks[n]
            search_all(BallTree(points), ident, queries, own, best, floor)

        for b in batches:
            for ident, points in _arrays(b):
                if (n := points.shape[1]) in blocks:
                    held.setdefault(n, []).append((ident, points))
                    if sum(len(x) for x, _ in held[n]) >= SHARD:
                        flush(n)
        for n in list(held):
            flush(n)
        for own, _, best, floor in blocks.values():
            at = np.flatnonzero((best.score > _NONE) & (best.score >= floor[:, None]))
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(own, k)[at]), pa.array(best.ident.ravel()[at]), pa.array(best.score.ravel()[at])], names=["query_id", "vec_id", "score"])

    return run


def _packed(table: pa.Table, *more: str) -> dict[int, tuple]:
    """Of each vector length: ids, vectors and further columns."""
    found: dict[int, tuple] = {}
    for b in table.combine_chunks().to_batches():
        length = pc.list_value_length(b.column("v")).to_numpy(zero_copy_only=False)
        for n in np.unique(length):
            own = b.filter(pa.array(length == n))
            ident, points = next(iter(_arrays(own)))
            found[int(n)] = (ident, points, *[own.column(c).to_numpy(zero_copy_only=False) for c in more])
    return found


def top_k(vectors: DataFrame, queries: Column, key: str = "vec_id", vector: str = "embedding", k: int = K, scale: float = 256.0, block_bytes: int = BLOCK_BYTES, pilot: int = PILOT) -> DataFrame:
    """query_id, rank, vec_id and score of the k best partners, by floor(scale x), of each row that ``queries`` selects."""
    broadcast = vectors.sparkSession.sparkContext.broadcast
    whole = F.transform(col(vector), lambda x: F.floor(x.cast("double") * F.lit(scale)).cast("double"))
    rows = vectors.where(usable(col(vector)) & col(key).isNotNull()).select(col(key).cast("long").alias("id"), whole.alias("v"), queries.alias("asked"))
    asked = materialize(rows.where("asked").select("id", "v").dropDuplicates(), "queries")
    points = rows.select("id", "v")
    sample = materialize(points.orderBy(F.xxhash64("id")).limit(pilot), "pilot").toArrow()
    known = materialize(asked.mapInArrow(_floors(broadcast(_packed(sample)), k), "id long, v array<double>, floor long"), "floors")
    blocks = max(1, -(-(known.agg(F.sum(8 * F.size("v") + 16)).first()[0] or 0) // block_bytes))
    if blocks > 1:
        points = materialize(points, "points")
    result = None
    for i in range(blocks):
        shared = broadcast(_packed(known.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == i).toArrow(), "floor"))
        found = points.mapInArrow(_search(shared, k), "query_id long, vec_id long, score long")
        if blocks > 1:
            found = materialize(found, "found")
            shared.unpersist()
        result = found if result is None else result.unionByName(found)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return result.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
