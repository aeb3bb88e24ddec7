"""Timetables: stop times, their instants on a service day, the bundle in force, and how feeds match them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tramloom.config import DEFAULT, Settings
from tramloom.functions import exprs as X


def scheduled_stop_times(trips: DataFrame, stop_times: DataFrame) -> DataFrame:
    """Stop times with their trip's route, second offsets and the trip id without version; those without a trip go."""
    named = trips.select("trip_id", X.versionless(F.col("trip_id")).alias("scheduled_trip_id"), "route_id", "direction_id")  # once a trip, not once a stop
    return stop_times.join(named, "trip_id").select("scheduled_trip_id", "route_id", "direction_id", F.col("stop_sequence").cast("int").alias("stop_sequence"), "stop_id", X.clock_seconds(F.col("arrival_time")).alias("scheduled_arrival_offset_sec"), X.clock_seconds(F.col("departure_time")).alias("scheduled_departure_offset_sec"))


def duplicate_trips(trips: DataFrame) -> DataFrame:
    """Trip ids that would multiply stop times; empty in a sound bundle."""
    return trips.groupBy("trip_id").agg(F.count("*").alias("n")).where("n > 1")


def scheduled_instants(scheduled: DataFrame, dates: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Stop times on the service dates of dates (service_date with scheduled_trip_id, or with route_id where all trips of a route run).

    Always an equi join: a timetable is never laid out for dates on which a trip or route was not seen.
    """
    by = "scheduled_trip_id" if "scheduled_trip_id" in dates.columns else "route_id"
    days = dates.select("service_date").distinct().withColumn("service_day_start_utc", X.service_day_start(F.col("service_date"), settings.zone))  # time zones are looked up once a day
    rows = scheduled.join(dates.select(by, "service_date").distinct().join(days, "service_date"), by)
    at = lambda c: F.timestamp_seconds(F.col("service_day_start_utc") + F.col(c))
    return rows.withColumn("scheduled_arrival_ts", at("scheduled_arrival_offset_sec")).withColumn("scheduled_departure_ts", at("scheduled_departure_offset_sec"))


def resolve_bundles(dates: DataFrame, bundles: DataFrame) -> DataFrame:
    """The bundle for each date: the newest whose window covers it, else the newest begun by then, else the newest.

    An 'unknown' end is open. A date's choice depends only on bundle starts, so one row per bundle and date is enough.
    """
    one = bundles.agg(F.collect_list(F.struct("feed_start", "feed_end", "version")).alias("all"))  # a row: bundles are some dozens
    d = F.col("service_date")
    grade = lambda b: F.when((b["feed_start"] <= d) & ((b["feed_end"] == "unknown") | (b["feed_end"] >= d)), 2).when(b["feed_start"] <= d, 1).otherwise(0)
    best = F.array_max(F.transform("all", lambda b: F.struct(grade(b).alias("grade"), b["feed_start"].alias("feed_start"), b["feed_end"].alias("feed_end"), b["version"].alias("version"))))
    chosen = dates.select("service_date").distinct().join(F.broadcast(one)).select("service_date", best.alias("b")).where("b is not null")
    return chosen.select("service_date", F.col("b.feed_start").alias("feed_start"), F.col("b.feed_end").alias("feed_end"), X.version_label(F.col("b.feed_start"), F.col("b.version")).alias("bundle"), (F.col("b.grade") == 2).alias("covered"))


def bundle_version(trips: DataFrame) -> DataFrame:
    """The version that most trip ids carry; of equals the lower."""
    counted = trips.select(X.version_of(F.col("trip_id")).alias("version")).where("version is not null").groupBy("version").agg(F.count("*").alias("n"))
    return counted.withColumn("r", F.row_number().over(Window.orderBy(F.desc("n"), "version"))).where("r = 1").select("version")


def match_report(realtime: DataFrame, trips: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """One row: how many revenue observations reach the timetable, by versioned and by plain trip id, and the versions."""
    known = trips.select(X.versionless(F.col("trip_id")).alias("base")).distinct().withColumn("by_base", F.lit(True))
    exact = trips.select("trip_id").distinct().withColumn("by_id", F.lit(True))
    rows = realtime.withColumn("base", X.versionless(F.col("trip_id"))).withColumn("version", X.version_of(F.col("trip_id")))
    revenue = ~F.col("route_id").eqNullSafe(settings.non_revenue_route)
    rows = rows.join(known, "base", "left").join(exact, "trip_id", "left")
    versions = trips.agg(F.array_sort(F.collect_set(X.version_of(F.col("trip_id")))).alias("bundle_versions"))
    one = rows.agg(F.count("*").alias("observations"), X.count_where(revenue).alias("revenue"), X.count_where(revenue & F.col("by_base")).alias("matched"), X.count_where(revenue & F.col("by_id")).alias("matched_by_versioned_id"), F.countDistinct("trip_id").alias("trips"), F.array_sort(F.collect_set("version")).alias("versions"))
    one = one.join(F.broadcast(versions))
    return one.select("observations", "revenue", "matched", "matched_by_versioned_id", "trips", F.coalesce(X.safe_share(F.col("matched"), F.col("revenue")), F.lit(0.0)).alias("match_rate"), F.array_join("versions", ",").alias("realtime_versions"), (F.col("versions") == F.col("bundle_versions")).alias("version_agrees"))


def version_counts(realtime: DataFrame) -> DataFrame:
    return realtime.select(X.version_of(F.col("trip_id")).alias("version")).where("version is not null").groupBy("version").agg(F.count("*").alias("n"))


def static_join_report(realtime: DataFrame, trips: DataFrame, stop_times: DataFrame, stops: DataFrame) -> DataFrame:
    """One row: of the distinct realtime trip and stop ids, how many each static table holds."""
    ids = realtime.select("trip_id", X.versionless(F.col("trip_id")).alias("base")).distinct()
    base = lambda df: df.select(X.versionless(F.col("trip_id")).alias("base")).distinct()
    parts = {
        "trip_ids": ids, "by_versioned_id": ids.join(trips.select("trip_id").distinct(), "trip_id", "left_semi"), "by_base_id": ids.join(base(trips), "base", "left_semi"), "in_stop_times": ids.join(base(stop_times), "base", "left_semi"),
        "stop_ids": realtime.select("stop_id").distinct(), "known_stops": realtime.select("stop_id").intersect(stops.select("stop_id")),
    }
    counted = None
    for name, df in parts.items():
        own = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("measure"), "n")
        counted = own if counted is None else counted.unionByName(own)
    return counted
