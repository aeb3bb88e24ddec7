"""Windows over long histories of few keys: a key's time line is cut into slices, and each slice gets a small carry.

A window by key alone puts a key's whole history into one task. Here a task gets a key's slice (a day, or some thousand
rows), and what it needs to know of the slices before comes as a carry: one row a slice, or the last rows of the slice
before it. The window over carries has a row for each key and slice only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAY = 86_400


def slice_of(ts: Column, seconds: int = DAY) -> Column:
    """Number of the slice that a timestamp (or a number) lies in; of null null."""
    return F.floor(ts.cast("double") / seconds).cast("long")


def carry(rows: DataFrame, keys: Sequence[str], newest: Column, name: str, at: str = "__slice") -> DataFrame:
    """Of each (keys, slice) that rows have: ``newest`` (an aggregate, null of a slice without any) of the nearest slice before."""
    line = Window.partitionBy(*keys).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    each = rows.groupBy(*keys, at).agg(newest.alias(name))
    return each.withColumn(name, F.last(name, ignorenulls=True).over(line))


def with_halo(rows: DataFrame, place: str, before: int, block: int = 4096) -> DataFrame:
    """rows in blocks of ``block`` consecutive places (a number from 0 within a key) as __block, each preceded by its
    ``before`` last rows of the block before it, for which __halo holds: windows by key and __block that look at most that
    far back are those by key."""
    block = max(block, before + 1)
    own = F.floor(F.col(place) / block).cast("long")
    also = F.when(F.col(place) % block >= block - before, own + 1)
    return rows.withColumn("__block", F.explode(F.array_compact(F.array(own, also)))).withColumn("__halo", F.col("__block") > own)
