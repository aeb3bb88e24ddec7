"""Splits in time with an embargo, by rows and by blocks, and what they warn of."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tramloom.config import DEFAULT, SEGMENT_KEY, Settings
from tramloom.functions.quantiles import quantiles
from tramloom.operators.journeys import BLOCK_KEY


def boundary(rows: DataFrame, ts: str, settings: Settings = DEFAULT) -> DataFrame:
    """One row: the instant (microseconds) before which all but validation_fraction of the rows lie, between rows if need be."""
    edge = quantiles(rows, {"m": (F.unix_micros(ts), (1 - settings.validation_fraction,))})["m"][0]
    return rows.sparkSession.range(1).select(F.lit(edge).cast("double").alias("boundary"))


def _label(micros: Column, settings: Settings) -> Column:
    edge = F.col("boundary")
    return F.when(micros >= edge, "validation").when(micros < edge - settings.embargo_sec * 1e6, "train").otherwise("embargo")


def temporal_split(rows: DataFrame, ts: str = "actual_departure_ts", settings: Settings = DEFAULT, at: Column | None = None) -> DataFrame:
    """split: train, embargo or validation. What departs within the embargo before the boundary is in neither."""
    edge = boundary(rows, ts, settings) if at is None else rows.sparkSession.range(1).select(F.unix_micros(at).cast("double").alias("boundary"))
    return rows.join(F.broadcast(edge)).withColumn("split", _label(F.unix_micros(ts), settings)).drop("boundary")


def split_report(split: DataFrame, ts: str = "actual_departure_ts") -> DataFrame:
    """Rows, service dates and ends of each part."""
    return split.groupBy("split").agg(F.count("*").alias("n_rows"), F.countDistinct("service_date").alias("dates"), F.min(F.unix_seconds(ts)).alias("first"), F.max(F.unix_seconds(ts)).alias("last"))


def unseen_segments(split: DataFrame) -> DataFrame:
    """Segments of the validation part that training never saw."""
    part = lambda name: split.where(F.col("split") == name).select(*SEGMENT_KEY).distinct()
    return part("validation").join(part("train"), list(SEGMENT_KEY), "left_anti")


def split_warnings(split: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """One row of what makes a split doubtful."""
    valid = F.col("split") == "validation"
    one = split.agg(F.countDistinct("service_date").alias("days"), F.countDistinct(F.when(valid, F.col("service_date"))).alias("validation_days"), F.countDistinct(F.when(valid, F.weekday(F.col("service_date").cast("date")))).alias("validation_weekdays"))
    unseen = unseen_segments(split).agg(F.count("*").alias("unseen_segments"))
    return one.join(F.broadcast(unseen)).select("*", (F.col("days") < settings.min_days).alias("too_few_days"), (F.col("validation_weekdays") == 1).alias("single_weekday"), (F.col("validation_days") == 1).alias("single_date"), (F.col("unseen_segments") > 0).alias("has_unseen"))


def split_journeys(journeys: DataFrame, settings: Settings = DEFAULT, ts: str = "actual_departure_ts") -> DataFrame:
    """Whole blocks go to one part: a block counts as one, by when its first journey departs."""
    rows = journeys.withColumn("block_start", F.min(ts).over(Window.partitionBy(*BLOCK_KEY)))
    starts = journeys.groupBy(*BLOCK_KEY).agg(F.min(ts).alias("start"))
    edge = boundary(starts, "start", settings)
    return rows.join(F.broadcast(edge)).withColumn("split", _label(F.unix_micros("block_start"), settings)).drop("boundary")


def journey_split_report(split: DataFrame, ts: str = "actual_departure_ts") -> DataFrame:
    """Rows, blocks, service dates and ends of each part."""
    block = F.struct(*BLOCK_KEY)
    return split.groupBy("split").agg(F.count("*").alias("n_rows"), F.countDistinct(block).alias("blocks"), F.countDistinct("service_date").alias("dates"), F.min(F.unix_seconds(ts)).alias("first"), F.max(F.unix_seconds(ts)).alias("last"))


def journey_split_warnings(split: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """One row: days of training and validation, and what makes the split doubtful."""
    per_day = split.where("split <> 'embargo'").groupBy("service_date").agg(F.max((F.col("split") == "train").cast("int")).alias("t"), F.max((F.col("split") == "validation").cast("int")).alias("v"))
    one = per_day.agg(F.count("*").alias("days"), F.coalesce(F.sum("t"), F.lit(0)).alias("train_days"), F.coalesce(F.sum("v"), F.lit(0)).alias("validation_days"), F.coalesce(F.sum(F.col("t") * F.col("v")), F.lit(0)).alias("shared_days"))
    every = (F.col("validation_days") > 0) & (F.col("shared_days") == F.col("validation_days"))
    return one.select("*", (F.col("days") < settings.min_days).alias("too_few_days"), (F.col("validation_days") < 2).alias("single_validation_day"), every.alias("validation_days_all_in_training"))


def outside_blocks(segments: DataFrame, journeys: DataFrame) -> DataFrame:
    """Segments (with block_no) of no block that any of the journeys belongs to."""
    return segments.join(journeys.select(*BLOCK_KEY).distinct(), list(BLOCK_KEY), "left_anti")


def shared_days(split: DataFrame) -> DataFrame:
    """Service dates that are in both training and validation."""
    part = lambda name: split.where(F.col("split") == name).select("service_date")
    return part("train").intersect(part("validation"))
