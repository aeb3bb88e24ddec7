"""Queries over arrivals, segments, timetables and their quality."""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramloom.operators import arrivals, explore, quality, schedule, segments
from tramloom.plans import pipelines
from tramloom.queries.base import S, TIE, built, combined, kept, observed, planned, predicted, r, sec
from tramloom.queries.sql import Query, sql
from tramloom.sources import bridge, tables

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def add(name: str, run: Query, text: str | None = None) -> None:
    QUERIES[name] = run
    if text is not None:
        SQL[name] = text


def _arrival_columns(df):
    return df.select("trip_id", "service_date", "route_id", "direction_id", "stop_id", F.col("stop_sequence").cast("int").alias("stop_sequence"), sec("actual_arrival_ts"), "arrival_bracket_sec", "sequence_jump", "arrival_source", "arrival_confident", *(["trip_run"] if "trip_run" in df.columns else []), *(["observation_count"] if "observation_count" in df.columns else []))


_ARR = (
    "trip_id, service_date, route_id, direction_id, stop_id, stop_sequence::INT AS stop_sequence, arr AS actual_arrival_sec, "
    "bracket AS arrival_bracket_sec, jump AS sequence_jump, src AS arrival_source, confident AS arrival_confident"
)
add("arrivals_observed", lambda s, d: _arrival_columns(observed(s, d)), sql(f"SELECT {_ARR} FROM vpa", "vpa"))
add("arrivals_predicted", lambda s, d: _arrival_columns(predicted(s, d)), sql(f"SELECT {_ARR}, observation_count FROM tua", "tua"))
add("arrivals_combined", lambda s, d: _arrival_columns(combined(s, d)), sql(f"SELECT {_ARR}, trip_run FROM runs", "runs"))
add("arrivals_by_source", lambda s, d: arrivals.by_source(combined(s, d)), sql("SELECT src AS arrival_source, count(*) AS n FROM runs GROUP BY 1", "runs"))
add(
    "arrivals_agreement",
    lambda s, d: arrivals.agreement(observed(s, d), predicted(s, d), 43_200).select("pairs", *[r(c) for c in ("p10", "median", "p90")], r("share_within", digits=6)),
    sql("""SELECT count(*) AS pairs, round(quantile_cont(t.arr - v.arr, 0.1)::DOUBLE, 4) AS p10, round(quantile_cont(t.arr - v.arr, 0.5)::DOUBLE, 4) AS median, round(quantile_cont(t.arr - v.arr, 0.9)::DOUBLE, 4) AS p90,
      round(avg(CASE WHEN abs(t.arr - v.arr) <= 43200 THEN 1.0 ELSE 0.0 END)::DOUBLE, 6) AS share_within FROM vpa v JOIN tua t USING (trip_id, stop_sequence)""", "vpa", "tua"),
)
add(
    "prediction_lifetimes",
    lambda s, d: arrivals.prediction_lifetimes(bridge.trip_update_observations(s, d), TIE).select("trip_id", F.col("stop_sequence").cast("int").alias("stop_sequence"), "observations", sec("final_arrival_ts"), sec("first_arrival_ts"), "lifetime_sec", "stop_id"),
    sql("SELECT trip_id, stop_sequence::INT AS stop_sequence, count(*) AS observations, arg_max(arr, (captured_at, event_id)) AS final_arrival_sec, arg_min(arr, (captured_at, event_id)) AS first_arrival_sec, max(cap) - min(cap) AS lifetime_sec, arg_max(stop_id, (captured_at, event_id)) AS stop_id FROM tuh GROUP BY 1, 2", "tuh"),
)

_SEG = ["trip_id", "trip_run", "scheduled_trip_id", "route_id", "direction_id", "mode", "from_stop_id", "to_stop_id", "stop_sequence", "from_stop_sequence", "stop_span", "scheduled_duration_sec", "actual_duration_sec", "delay_sec", "arrival_source", "arrival_bracket_sec", "arrival_confident", "duration_plausible", "schedule_version_agrees", "static_gtfs_version", "service_date"]
add(
    "segments",
    lambda s, d: built(s, d).select(*_SEG, *[F.unix_seconds(c).alias(c.replace("_ts", "_sec")) for c in ("scheduled_departure_ts", "scheduled_arrival_ts", "actual_departure_ts", "actual_arrival_ts")], F.unix_seconds("observed_at_utc").alias("observed_sec")),
    sql("""SELECT trip_id, trip_run, trip_id AS scheduled_trip_id, route_id, direction_id, 'rail' AS mode, from_stop_id, to_stop_id, stop_sequence, from_stop_sequence, stop_span, sdur AS scheduled_duration_sec, dur AS actual_duration_sec, delay AS delay_sec, src AS arrival_source,
      bracket AS arrival_bracket_sec, confident AS arrival_confident, plausible AS duration_plausible, false AS schedule_version_agrees, '2024' AS static_gtfs_version, service_date, sched_dep AS scheduled_departure_sec, sched_arr AS scheduled_arrival_sec, dep AS actual_departure_sec, arr AS actual_arrival_sec, cap AS observed_sec FROM segs""", "segs"),
)
add(
    "segment_quality",
    lambda s, d: quality.segment_quality(built(s, d), S).select(*[c for c in ("n_rows", "negative_duration", "implausibly_long", "ratio_outliers", "sequence_gaps", "missing_schedule", "low_confidence", "from_predictions", "stale_schedule_version", "repeat_run_rows")], *[r(c) for c in ("delay_p05", "delay_median", "delay_p95")], r("implausible_rate", digits=6)),
    sql("""SELECT count(*) AS n_rows, count_if(dur < 0)::BIGINT AS negative_duration, count_if(dur > 2592000)::BIGINT AS implausibly_long, count_if(sdur > 0 AND dur > sdur * 400)::BIGINT AS ratio_outliers, count_if(stop_span > 1)::BIGINT AS sequence_gaps, count_if(sdur IS NULL)::BIGINT AS missing_schedule,
      count_if(NOT confident)::BIGINT AS low_confidence, count_if(src = 'trip_update')::BIGINT AS from_predictions, count(*) AS stale_schedule_version, count_if(trip_run > 0)::BIGINT AS repeat_run_rows,
      round(quantile_cont(delay, 0.05)::DOUBLE, 4) AS delay_p05, round(quantile_cont(delay, 0.5)::DOUBLE, 4) AS delay_median, round(quantile_cont(delay, 0.95)::DOUBLE, 4) AS delay_p95,
      round((count_if(dur < 0) + count_if(dur > 2592000) + count_if(sdur > 0 AND dur > sdur * 400)) / count(*)::DOUBLE, 6) AS implausible_rate FROM segs""", "segs"),
)
add(
    "segment_stats",
    lambda s, d: segments.segment_stats(built(s, d)).select("from_stop_id", "to_stop_id", "n", r("mean_sec"), r("median_sec")),
    sql("SELECT from_stop_id, to_stop_id, count(*) AS n, round(avg(dur), 4) AS mean_sec, round(quantile_cont(dur, 0.5)::DOUBLE, 4) AS median_sec FROM segs GROUP BY 1, 2", "segs"),
)
add(
    "segment_filter_report",
    lambda s, d: segments.filter_report(built(s, d), S),
    sql("SELECT count(*) AS n_rows, count_if(NOT plausible)::BIGINT AS dropped_duration_plausible, count_if(plausible AND NOT confident)::BIGINT AS dropped_arrival_confident, 0::BIGINT AS dropped_observed, count_if(plausible AND confident AND sdur IS NULL)::BIGINT AS dropped_scheduled, count_if(plausible AND confident AND sdur IS NOT NULL)::BIGINT AS kept FROM segs", "segs"),
)
add(
    "segments_kept",
    lambda s, d: kept(s, d).select("service_date", "trip_id", "trip_run", "from_stop_id", "to_stop_id", "actual_duration_sec", "delay_sec"),
    sql("SELECT service_date, trip_id, trip_run, from_stop_id, to_stop_id, dur AS actual_duration_sec, delay AS delay_sec FROM fseg", "fseg"),
)


def _pipeline(s, d):
    rows = pipelines.segments_of(bridge.vehicle_observations(s, d), bridge.trip_update_observations(s, d), bridge.trips(s, d), bridge.stop_times(s, d), S, TIE)
    return rows.groupBy("service_date").agg(F.count("*").alias("n"), F.sum("actual_duration_sec").alias("total_sec"), F.sum("delay_sec").alias("total_delay"))


add("segments_end_to_end", _pipeline, sql("SELECT service_date, count(*) AS n, sum(dur)::BIGINT AS total_sec, sum(delay)::BIGINT AS total_delay FROM segs GROUP BY 1", "segs"))


def _round_trip(s, d):
    """Write the segments by date, write two dates again, and read all back, and then some dates alone."""
    path = f"{tables.shared_folder(s)}/segments-{uuid.uuid4().hex}"
    rows = built(s, d)
    tables.write_partitions(rows, path)
    some = ["2024-01-03", "2024-01-04"]
    tables.write_partitions(rows.where(F.col("service_date").isin(some)), path)
    back = tables.read_partitions(s, path, rows.schema)
    return back.groupBy("service_date").agg(F.count("*").alias("n"), F.sum("actual_duration_sec").alias("total_sec"))


add("segments_written_and_read", _round_trip, sql("SELECT service_date, count(*) AS n, sum(dur)::BIGINT AS total_sec FROM segs GROUP BY 1", "segs"))



def _some_dates(s, d):
    """Written, held against what was written, and read by dates and by a range of dates."""
    path = f"{tables.shared_folder(s)}/segments-{uuid.uuid4().hex}"
    rows = built(s, d)
    tables.write_partitions(rows, path)
    back = tables.read_partitions(s, path, rows.schema)
    same = tables.fingerprint(rows.select(*sorted(rows.columns))).join(tables.fingerprint(back.select(*sorted(rows.columns))).select(F.col("hash").alias("again")))
    count = lambda df, name: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("what"), "n")
    named = tables.read_partitions(s, path, rows.schema, ["2024-01-03", "2024-01-09"])
    parts = [count(named, "two dates"), count(tables.between_dates(back, "2024-01-03", "2024-01-09"), "a week"), count(tables.completed_dates(back), "dates"), same.select(F.lit("rows read as written").alias("what"), F.when(F.col("hash") == F.col("again"), F.col("n_rows")).otherwise(-1).alias("n"))]
    return functools.reduce(DataFrame.unionByName, parts)


add(
    "segments_of_some_dates",
    _some_dates,
    sql(
        """SELECT 'two dates' AS what, count(*) AS n FROM segs WHERE service_date IN ('2024-01-03', '2024-01-09') UNION ALL SELECT 'a week', count(*) FROM segs WHERE service_date BETWEEN '2024-01-03' AND '2024-01-09'
      UNION ALL SELECT 'dates', count(DISTINCT service_date) FROM segs UNION ALL SELECT 'rows read as written', count(*) FROM segs""",
        "segs",
    ),
)

# --- timetables ----------------------------------------------------------------------------------------------------
add(
    "scheduled_stop_times",
    lambda s, d: planned(s, d),
    sql("SELECT trip_id AS scheduled_trip_id, route_id, direction_id, seq AS stop_sequence, stop_id, off AS scheduled_arrival_offset_sec, off AS scheduled_departure_offset_sec FROM sched", "sched"),
)


def _instants(s, d):
    rows = schedule.scheduled_instants(planned(s, d), combined(s, d), S)
    return rows.groupBy("scheduled_trip_id").agg(F.count("*").alias("n"), F.sum(F.unix_seconds("scheduled_arrival_ts")).alias("total_sec"), F.max(F.unix_seconds("scheduled_departure_ts")).alias("last_sec"))


_INSTANT = "epoch(strptime(service_date, '%Y-%m-%d'))::BIGINT + 18000 + off"
add(
    "scheduled_instants",
    _instants,
    sql(f"SELECT trip_id AS scheduled_trip_id, count(*) AS n, sum({_INSTANT})::BIGINT AS total_sec, max({_INSTANT})::BIGINT AS last_sec FROM sched JOIN (SELECT DISTINCT trip_id, service_date FROM arrs) USING (trip_id) GROUP BY 1", "sched", "arrs"),
)
add(
    "bundle_in_force",
    lambda s, d: schedule.resolve_bundles(s.read.parquet(f"{d}/orders.parquet").select(F.date_format(F.date_add(F.to_date("o_orderdate"), 40), "yyyy-MM-dd").alias("service_date")), bridge.bundles(s, d)),
    sql("""SELECT service_date, feed_start, feed_end, feed_start || '/' || version AS bundle, grade = 2 AS covered FROM (SELECT service_date, feed_start, feed_end, version, CASE WHEN feed_start <= service_date AND (feed_end = 'unknown' OR feed_end >= service_date) THEN 2 WHEN feed_start <= service_date THEN 1 ELSE 0 END AS grade
      FROM (SELECT DISTINCT strftime(o_orderdate + INTERVAL 40 DAY, '%Y-%m-%d') AS service_date FROM orders), bund) QUALIFY row_number() OVER (PARTITION BY service_date ORDER BY grade DESC, feed_start DESC, feed_end DESC, version DESC) = 1""", "bund"),
)
add("bundle_version", lambda s, d: schedule.bundle_version(bridge.trips(s, d)), "SELECT '20670' AS version FROM customer LIMIT 1")
add(
    "match_report",
    lambda s, d: schedule.match_report(bridge.realtime_ids(s, d), bridge.trips(s, d), S).select("*").withColumn("match_rate", F.round("match_rate", 6)),
    sql("""SELECT count(*) AS observations, count_if(route_id <> 'NR')::BIGINT AS revenue, count_if(route_id <> 'NR' AND base IN (SELECT c_custkey::VARCHAR FROM customer))::BIGINT AS matched, 0::BIGINT AS matched_by_versioned_id, count(DISTINCT trip_id) AS trips,
      round(count_if(route_id <> 'NR' AND base IN (SELECT c_custkey::VARCHAR FROM customer)) / count_if(route_id <> 'NR')::DOUBLE, 6) AS match_rate, '20660' AS realtime_versions, false AS version_agrees FROM rt""", "rt"),
)
add("version_counts", lambda s, d: schedule.version_counts(bridge.realtime_ids(s, d)), sql("SELECT '20660' AS version, count(*) AS n FROM rt", "rt"))
add(
    "static_join_report",
    lambda s, d: schedule.static_join_report(bridge.realtime_ids(s, d), bridge.trips(s, d), bridge.stop_times(s, d), bridge.stops(s, d)),
    sql("""SELECT 'trip_ids' AS measure, count(DISTINCT trip_id) AS n FROM rt UNION ALL SELECT 'by_versioned_id', 0 UNION ALL SELECT 'by_base_id', count(DISTINCT base) FROM rt WHERE base IN (SELECT c_custkey::VARCHAR FROM customer)
      UNION ALL SELECT 'in_stop_times', count(DISTINCT base) FROM rt WHERE base IN (SELECT trip_id FROM sched) UNION ALL SELECT 'stop_ids', count(DISTINCT stop_id) FROM rt UNION ALL SELECT 'known_stops', count(DISTINCT stop_id) FROM rt WHERE stop_id IN (SELECT stop_id FROM stops)""", "rt", "sched", "stops"),
)
add(
    "duplicate_trips",
    lambda s, d: schedule.duplicate_trips(bridge.trips(s, d).unionByName(bridge.trips(s, d).where("direction_id = 0"))),
    "SELECT c_custkey::VARCHAR || '_20670' AS trip_id, 2::BIGINT AS n FROM customer WHERE c_custkey % 2 = 0",
)
add(
    "arrival_jumps",
    lambda s, d: explore.jump_histogram(observed(s, d)).select("sequence_jump", "n", r("median_bracket"), "longest_bracket"),
    sql("SELECT jump AS sequence_jump, count(*) AS n, round(quantile_cont(bracket, 0.5)::DOUBLE, 4) AS median_bracket, max(bracket) AS longest_bracket FROM vpa GROUP BY 1", "vpa"),
)
add(
    "arrival_viability",
    lambda s, d: explore.viability(observed(s, d), S.max_bracket_sec).select("arrivals", r("within_share", digits=6), r("one_stop_share", digits=6), "unseen_stops", r("median_bracket")),
    sql("SELECT count(*) AS arrivals, round(avg((bracket <= 43200)::INT), 6) AS within_share, round(avg((jump = 1)::INT), 6) AS one_stop_share, sum(jump - 1)::BIGINT AS unseen_stops, round(quantile_cont(bracket, 0.5)::DOUBLE, 4) AS median_bracket FROM vpa", "vpa"),
)
