"""Inputs that queries share, and their settings: the tables have hours between observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramloom.config import COARSE
from tramloom.operators import arrivals, features, schedule, segments
from tramloom.sources import bridge, tables

S = COARSE
TIE = ("event_id",)


def sec(c: str) -> Column:
    return F.unix_seconds(c).alias(c.replace("_ts", "_sec") if c.endswith("_ts") else c)


def r(c: Column | str, name: str | None = None, digits: int = 4) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col.cast("double"), digits).alias(name or str(c))


def observed(spark: SparkSession, d: str) -> DataFrame:
    return arrivals.observed_arrivals(bridge.vehicle_observations(spark, d), S, TIE)


def predicted(spark: SparkSession, d: str) -> DataFrame:
    return arrivals.predicted_arrivals(bridge.trip_update_observations(spark, d), S, TIE)


def combined(spark: SparkSession, d: str) -> DataFrame:
    """Observed arrivals are written once, since they are read as themselves and as what predictions must not be of."""
    return arrivals.combined_arrivals(tables.materialize(observed(spark, d), "observed"), predicted(spark, d), S)


def planned(spark: SparkSession, d: str) -> DataFrame:
    return schedule.scheduled_stop_times(bridge.trips(spark, d), bridge.stop_times(spark, d))


def built(spark: SparkSession, d: str) -> DataFrame:
    """All segments, written once, since most queries read them more than once."""
    return tables.materialize(segments.build_segments(combined(spark, d), planned(spark, d), "rail", "2024", "20670", S), "segments")


def kept(spark: SparkSession, d: str) -> DataFrame:
    return segments.filtered(built(spark, d), S)


def dated(spark: SparkSession, d: str) -> DataFrame:
    return features.calendar(kept(spark, d), None, S)
