"""Arrival events from observations, and the runs they form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tramloom.config import DEFAULT, Settings
from tramloom.functions import exprs as X

OBSERVED, PREDICTED = "vehicle_position", "trip_update"
CARRIED = ("trip_id", "scheduled_trip_id", "schedule_version", "route_id", "direction_id", "vehicle_id", "service_date", "stop_id", "stop_sequence")


def _carried(settings: Settings) -> tuple[str, ...]:
    return (*CARRIED, *[k for k in settings.trip_keys if k not in CARRIED])


def observed_arrivals(vehicles: DataFrame, settings: Settings = DEFAULT, tie: Sequence[str] = ()) -> DataFrame:
    """An arrival wherever a vehicle's stop sequence rises between two successive sightings of its trip.

    The instant lies between the sightings; the middle is taken and the bracket is its width.
    """
    seen = vehicles.where("stop_sequence is not null and trip_id is not null")
    line = Window.partitionBy(*settings.trip_keys).orderBy("captured_at", *tie)
    last = F.lag(F.struct("stop_sequence", "captured_at")).over(line)
    rose = seen.withColumn("last", last).where(F.col("stop_sequence") > F.col("last.stop_sequence"))
    width = (F.unix_seconds("captured_at") - F.unix_seconds("last.captured_at")).cast("int")
    return rose.select(*_carried(settings), X.midpoint(F.col("last.captured_at"), F.col("captured_at")).alias("actual_arrival_ts"), width.alias("arrival_bracket_sec"), (F.col("stop_sequence") - F.col("last.stop_sequence")).cast("int").alias("sequence_jump"), F.lit(OBSERVED).alias("arrival_source"), F.col("captured_at").alias("observed_at_utc"), (width <= settings.max_bracket_sec).alias("arrival_confident"))


def predicted_arrivals(updates: DataFrame, settings: Settings = DEFAULT, tie: Sequence[str] = ()) -> DataFrame:
    """An arrival for each (trip, stop) that was seen both before and after its own predicted arrival.

    The last prediction that still lay ahead is taken, by one aggregate; its remaining horizon is the bracket.
    """
    usable = updates.where("arrival_ts is not null and stop_sequence is not null and trip_id is not null")
    ahead = usable.withColumn("horizon", F.unix_seconds("arrival_ts") - F.unix_seconds("captured_at"))
    names = [c for c in _carried(settings) if c not in (*settings.trip_keys, "stop_sequence")]
    what = F.struct(*names, "arrival_ts", "captured_at", "horizon")
    latest = F.max_by(what, F.when(F.col("horizon") > 0, F.struct("captured_at", *tie)))
    crossed = ahead.groupBy(*settings.trip_keys, "stop_sequence").agg(F.max("horizon").alias("most"), F.min("horizon").alias("least"), F.count("*").alias("observation_count"), latest.alias("p")).where("most > 0 and least < 0")
    width = F.col("p.horizon").cast("int")
    carried = [F.col(f"p.{c}").alias(c) if c in names else F.col(c) for c in _carried(settings)]
    return crossed.select(*carried, F.col("p.arrival_ts").alias("actual_arrival_ts"), width.alias("arrival_bracket_sec"), F.lit(1).alias("sequence_jump"), F.lit(PREDICTED).alias("arrival_source"), F.col("p.captured_at").alias("observed_at_utc"), (width <= settings.max_bracket_sec).alias("arrival_confident"), "observation_count")


def combined_arrivals(observed: DataFrame, predicted: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Observed arrivals, and predicted ones where nothing was observed for the trip and stop; runs are numbered."""
    keys = [*settings.trip_keys, "stop_sequence"]
    gaps = predicted.join(observed.select(*keys), keys, "left_anti")
    return numbered_runs(observed.unionByName(gaps.select(*observed.columns)), settings)


def numbered_runs(arrivals: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """trip_run: a trip id is used again on the same day, so a new run begins where the sequence does not rise."""
    line = Window.partitionBy(*settings.trip_keys).orderBy("actual_arrival_ts", "stop_sequence", "observed_at_utc", "arrival_bracket_sec")
    anew = F.when(F.col("stop_sequence") <= F.lag("stop_sequence").over(line), 1).otherwise(0)
    so_far = line.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return arrivals.withColumn("__anew", anew).withColumn("trip_run", F.sum("__anew").over(so_far).cast("int")).drop("__anew")


def by_source(arrivals: DataFrame) -> DataFrame:
    return arrivals.groupBy("arrival_source").agg(F.count("*").alias("n"))


def prediction_lifetimes(updates: DataFrame, tie: Sequence[str] = ()) -> DataFrame:
    """Of each (trip, stop): sightings, when it was last seen, its first and last prediction and the span of captures."""
    order = F.struct("captured_at", *tie)
    rows = updates.where("arrival_ts is not null and stop_sequence is not null and trip_id is not null")
    return rows.groupBy("trip_id", "stop_sequence").agg(F.count("*").alias("observations"), F.max("captured_at").alias("last_seen"), F.max_by("arrival_ts", order).alias("final_arrival_ts"), F.min_by("arrival_ts", order).alias("first_arrival_ts"), (F.max(F.unix_seconds("captured_at")) - F.min(F.unix_seconds("captured_at"))).alias("lifetime_sec"), F.max_by("stop_id", order).alias("stop_id"))


def agreement(observed: DataFrame, predicted: DataFrame, within_sec: int = 60) -> DataFrame:
    """How far predictions lie from observed arrivals of the same trip and stop, in one row."""
    keys = ["trip_id", "stop_sequence"]
    both = observed.select(*keys, F.col("actual_arrival_ts").alias("seen")).join(predicted.select(*keys, F.col("actual_arrival_ts").alias("said")), keys)
    delta = F.unix_seconds("said") - F.unix_seconds("seen")
    q = F.percentile("delta", F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9)))
    return both.select(delta.alias("delta")).agg(F.count("*").alias("pairs"), q.alias("q"), F.avg(F.when(F.abs("delta") <= within_sec, 1.0).otherwise(0.0)).alias("share_within")).select("pairs", *[F.col("q")[i].alias(n) for i, n in enumerate(("p10", "median", "p90"))], "share_within")
