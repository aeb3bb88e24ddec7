"""Hard-negative mining: Strassen products of anchor and candidate tiles, then mergeable heaps.

Anchors are broadcast in blocks of BLOCK_BYTES, and candidates stream past them in tiles: a task scores a tile of
anchors with a tile of candidates by one recursive multiplication on int64. There are two passes a block.

1. Positives: each anchor has a heap of its best candidates of the same label. Heaps of tiles merge within a task, those
   of tasks by a window of k rows, which Spark limits before and after its shuffle. The block's positives, k rows an
   anchor at most, are broadcast for the second pass.
2. Windows: each (anchor, positive) has a heap of the best candidates of another label whose score is between ``low``
   and ``high`` hundredths of the positive's. They merge likewise.

With n blocks the written vectors are scanned 2n times; a scan is small against the products, of which there are as
many as there are anchors for each row read.

Defined results: a row takes part if it has an id, a label and a vector without null or non-finite components that is
not empty; it meets only vectors of its own length. Rows alike in id, label and vector are one anchor; any row with
the anchor's id counts as its own. Ties go to the smaller id. An anchor without positives, or a positive without
negatives in its window, has no rows; with a positive score below zero no window holds anything if low is below high.
Components beyond +-sqrt(2**60 / length) after scaling count as that bound, so that every score fits a long exactly.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tramloom.llm.balltree import usable
from tramloom.llm.common import col, materialize
from tramloom.llm.strassen import times_transposed

POSITIVES = NEGATIVES = 5
LOW, HIGH = 80, 100
#: Rows of an anchor tile and of a candidate tile.
ANCHOR_TILE, TILE = 512, 4096
#: Bytes of anchors that one broadcast holds; rows of a task, and the number of tasks from which tasks have more rows.
BLOCK_BYTES, TASK_ROWS, MOST_TASKS = 32_000_000, 16_384, 4_096
NONE = np.iinfo(np.int64).min
_BOUND = 1 << 60


class Heaps:
    """The best k (score, id) of each of n owners, best first: higher scores, then smaller ids."""

    def __init__(self, n: int, k: int) -> None:
        self.score = np.full((n, k), NONE, np.int64)
        self.ident = np.full((n, k), np.iinfo(np.int64).max, np.int64)

    def least(self) -> np.ndarray:
        """The score that an entry must reach to get in."""
        return self.score[:, -1]

    def offer(self, owner: np.ndarray, score: np.ndarray, ident: np.ndarray) -> None:
        """Merge entries, any number an owner."""
        if not len(owner):
            return
        k = self.score.shape[1]
        own = np.unique(owner)
        owner = np.r_[np.repeat(own, k), owner]
        score, ident = np.r_[self.score[own].ravel(), score], np.r_[self.ident[own].ravel(), ident]
        order = np.lexsort((ident, ~score, owner))  # ~score falls as score rises, without overflow
        owner = owner[order]
        place = np.arange(len(owner)) - np.searchsorted(owner, owner)
        kept = order[place < k]
        self.score[own], self.ident[own] = score[kept].reshape(-1, k), ident[kept].reshape(-1, k)

    def entries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        owner, place = np.nonzero(self.score > NONE)
        return owner, self.score[owner, place], self.ident[owner, place]


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, labels, vectors) of the rows of each vector length."""
    lists = batch.column("v")
    offsets = lists.offsets.to_numpy()
    flat, length = lists.values.to_numpy(zero_copy_only=False), np.diff(offsets)
    ident, label = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "label"))
    for n in np.unique(length):
        rows = np.flatnonzero(length == n)
        yield ident[rows], label[rows], flat[offsets[rows, None] + np.arange(n)]


def _by_length(parts: Iterator[tuple[np.ndarray, ...]]) -> dict[int, list[tuple[np.ndarray, ...]]]:
    held: dict[int, list] = {}
    for p in parts:
        held.setdefault(p[2].shape[1], []).append(p)
    return held


def _tiles(batches: Iterator[pa.RecordBatch], rows: int, lengths) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Candidate tiles of about ``rows`` rows of one of the vector lengths."""
    held: dict[int, list] = {}
    for b in batches:
        for part in _rows(b):
            if (n := part[2].shape[1]) in lengths:
                held.setdefault(n, []).append(part)
                if sum(len(x[0]) for x in held[n]) >= rows:
                    yield tuple(map(np.concatenate, zip(*held.pop(n), strict=True)))
    for own in held.values():
        yield tuple(map(np.concatenate, zip(*own, strict=True)))


def _pass(shared, per_anchor: int, pick: Callable, tile: int):
    """For mapInArrow over candidates: heaps of ``pick``ed entries; an anchor owns ``per_anchor`` of them, one after another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, k, *more = shared.value
        heaps = {n: Heaps(len(own[0]) * per_anchor, k) for n, own in blocks.items()}
        for ident, label, points in _tiles(batches, tile, blocks):
            n = points.shape[1]
            own, own_label, anchors, first = blocks[n]
            for at in range(0, len(own), ANCHOR_TILE):
                some = slice(at, at + ANCHOR_TILE)
                score = times_transposed(anchors[some], points)
                same = own_label[some, None] == label
                pick(heaps[n], at, score, same, own[some, None] == ident, ident, first, *more)
        for n, h in heaps.items():
            owner, score, found = h.entries()
            owner += blocks[n][3] * per_anchor
            yield pa.RecordBatch.from_arrays([pa.array(owner), pa.array(score), pa.array(found)], names=["owner", "score", "id"])

    return run


def _pick_positives(heaps: Heaps, at: int, score: np.ndarray, same: np.ndarray, mine: np.ndarray, ident: np.ndarray, first: int) -> None:
    least = heaps.least()[at : at + len(score), None]
    row, column = np.nonzero(same & ~mine & (score >= least))
    heaps.offer(row + at, score[row, column], ident[column])


def _pick_negatives(heaps: Heaps, at: int, score: np.ndarray, same: np.ndarray, mine: np.ndarray, ident: np.ndarray, first: int, lower: np.ndarray, upper: np.ndarray) -> None:
    """lower, upper: of each anchor's positives, the scores that a negative may have; lower is above upper where there is none."""
    other, k = ~same & ~mine, lower.shape[1]
    rows = slice(first + at, first + at + len(score))
    least = heaps.least().reshape(-1, k)[at : at + len(score)]
    for j in range(k):
        low, high = np.maximum(lower[rows, j], least[:, j]), upper[rows, j]
        row, column = np.nonzero(other & (score >= low[:, None]) & (score <= high[:, None]))
        heaps.offer((row + at) * k + j, score[row, column], ident[column])


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("owner").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def score_bounds(positive: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score with low * positive <= 100 * score <= high * positive; of Python integers, so never rounded."""
    lower = [-((-low * int(p)) // 100) for p in positive]
    upper = [high * int(p) // 100 for p in positive]
    return np.array(lower, np.int64), np.array(upper, np.int64)


def mine_negatives(
    vectors: DataFrame, anchors: Column, key: str = "vec_id", vector: str = "embedding", label: Column | str = "label",
    positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: float = 256.0, block_bytes: int = BLOCK_BYTES, task_rows: int = TASK_ROWS, tile: int = TILE,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score, by floor(scale x), of the rows that ``anchors`` selects."""
    if not 0 <= low <= high <= 200:
        raise ValueError("0 <= low <= high <= 200")
    spark = vectors.sparkSession
    bound = F.floor(F.sqrt(F.lit(float(_BOUND)) / F.size(col(vector)))).cast("double")
    whole = F.transform(col(vector), lambda x: F.floor(F.least(F.greatest(x.cast("double") * F.lit(scale), -bound), bound)).cast("long"))
    marked = (col(label) if isinstance(label, str) else label).cast("long")
    rows = vectors.where(usable(col(vector)) & col(key).isNotNull()).select(col(key).cast("long").alias("id"), marked.alias("label"), whole.alias("v"), F.coalesce(anchors, F.lit(False)).alias("asked")).where("label IS NOT NULL")
    total = rows.count()
    points = materialize(rows.repartition(max(1, math.ceil(total / max(task_rows, total // MOST_TASKS)))), "vectors")
    asked = materialize(points.where("asked").select("id", "label", "v").distinct(), "anchors")
    points = points.select("id", "label", "v")
    blocks = max(1, math.ceil((asked.agg(F.sum(8 * F.size("v") + 24)).first()[0] or 0) / block_bytes))
    shape, result = "owner long, score long, id long", None
    for i in range(blocks):
        mine = asked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == i).toArrow().combine_chunks().to_batches()
        held, first = {}, 0
        for n, parts in _by_length(p for b in mine for p in _rows(b)).items():
            ident, marks, points_of = map(np.concatenate, zip(*parts, strict=True))
            held[n] = (ident, marks, points_of, first)
            first += len(ident)
        own = np.concatenate([np.empty(0, np.int64), *[x[0] for x in held.values()]])
        found = points.mapInArrow(_pass(spark.sparkContext.broadcast((held, positives)), 1, _pick_positives, tile), shape)
        best = _best(found, positives).toArrow()
        owner, rank, score, ident = (best.column(c).to_numpy() for c in ("owner", "rank", "score", "id"))
        lower, upper = np.ones((first, positives), np.int64), np.zeros((first, positives), np.int64)
        lower[owner, rank - 1], upper[owner, rank - 1] = score_bounds(score, low, high)
        found = points.mapInArrow(_pass(spark.sparkContext.broadcast((held, negatives, lower, upper)), positives, _pick_negatives, tile), shape)
        pairs = pa.table({"owner": owner * positives + rank - 1, "anchor_id": own[owner], "positive_id": ident, "positive_score": score})
        pairs = F.broadcast(spark.createDataFrame(pairs.cast(pa.schema([(c, pa.int64()) for c in pairs.column_names]))))
        mined = _best(found, negatives).join(pairs, "owner").select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
        if blocks > 1:
            mined = materialize(mined, "mined")
        result = mined if result is None else result.unionByName(mined)
    return result
