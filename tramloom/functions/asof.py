"""Backward as-of lookup: for each query row the newest event of its key before it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tramloom.functions.slices import DAY, carry, slice_of


def asof_backward(queries: DataFrame, events: DataFrame, keys: Sequence[str], query_ts: str, event_ts: str, payload: Sequence[str], tiebreak: Sequence[str] = (), strict: bool = True, seconds: int = DAY) -> DataFrame:
    """queries with event_ts and payload of the newest event of the same keys before query_ts (or at it, unless strict).

    Queries and events are laid on one time line per key, with one shuffle and no join; the payload travels in one
    struct, so that nulls inside it never reach back to an older event. Events tied in time are ordered by tiebreak.
    A line is cut into slices of ``seconds``; each begins with the newest event of the slices before it, as its carry.
    Rows with a null in query_ts find nothing.
    """
    n, kinds = len(tiebreak), events.schema
    slice_at, ties = slice_of(F.col("__ts"), seconds), [f"__t{i}" for i in range(n)]
    ask, event = F.struct(*queries.columns), F.struct(event_ts, *payload)
    none = [F.lit(None).cast(kinds[t].dataType).alias(c) for t, c in zip(tiebreak, ties, strict=True)]
    nothing = F.lit(None).cast(events.select(event).schema[0].dataType).alias("__event")
    left = queries.select(*keys, F.col(query_ts).alias("__ts"), F.lit(0 if strict else 1).alias("__side"), *none, nothing, ask.alias("__ask")).withColumn("__slice", slice_at)
    right = events.where(F.col(event_ts).isNotNull()).select(*keys, F.col(event_ts).alias("__ts"), F.lit(1 if strict else 0).alias("__side"), *[F.col(t).alias(c) for t, c in zip(tiebreak, ties, strict=True)], event.alias("__event"), F.lit(None).cast(queries.select(ask).schema[0].dataType).alias("__ask")).withColumn("__slice", slice_at)
    line = left.unionByName(right)
    newest = F.max_by("__event", F.when(F.col("__event").isNotNull(), F.struct("__ts", *ties)))
    before_all = carry(line, keys, newest, "__event").where("__event is not null and __slice is not null")
    line = line.unionByName(before_all.withColumn("__side", F.lit(-1)), allowMissingColumns=True)
    before = Window.partitionBy(*keys, "__slice").orderBy((F.col("__side") >= 0).cast("int"), "__ts", "__side", *ties).rowsBetween(Window.unboundedPreceding, -1)
    found = line.withColumn("__found", F.last("__event", ignorenulls=True).over(before)).where("__ask is not null")
    known = F.when(F.col("__ts").isNotNull(), F.col("__found"))
    return found.select(*[F.col(f"__ask.{c}").alias(c) for c in queries.columns], *[known[c].alias(c) for c in (event_ts, *payload)])
