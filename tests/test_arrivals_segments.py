from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tramloom.config import DEFAULT
from tramloom.operators import arrivals, quality, schedule, segments
from tramloom.sources import observations

BASE = datetime(2026, 8, 5, 12, 0, tzinfo=timezone.utc)


def at(minute):
    return BASE + timedelta(minutes=minute)


def vehicles(spark, track, trip="T1_20660"):
    rows = [(at(m), "2026-08-05", trip, trip.split("_")[0], "20660", "RED", 0, "V1", f"PF_{q}", q, "STOPPED_AT", None) for m, q in track]
    return spark.createDataFrame(rows, observations.VEHICLE_SCHEMA)


def updates(spark, track, trip="T1_20660", sequence=3):
    rows = [(at(m), "2026-08-05", trip, trip.split("_")[0], "20660", "RED", 0, "V1", f"PF_{sequence}", sequence, at(p) if p is not None else None, None, "SCHEDULED") for m, p in track]
    return spark.createDataFrame(rows, observations.TRIP_UPDATE_SCHEMA)


def test_arrival_is_the_middle_of_its_bracket(spark):
    rows = arrivals.observed_arrivals(vehicles(spark, [(0, 1), (1, 2), (2, 3)])).orderBy("stop_sequence").select(F.unix_seconds("actual_arrival_ts").alias("t"), "arrival_bracket_sec", "arrival_confident", "sequence_jump").collect()
    start = int(BASE.timestamp())
    assert [tuple(r) for r in rows] == [(start + 30, 60, True, 1), (start + 90, 60, True, 1)]


def test_dropout_is_flagged_not_dropped(spark):
    row = arrivals.observed_arrivals(vehicles(spark, [(0, 1), (10, 2)])).first()
    assert row["arrival_bracket_sec"] == 600 and not row["arrival_confident"]


def test_standing_and_falling_sequences_are_no_arrivals(spark):
    assert arrivals.observed_arrivals(vehicles(spark, [(0, 3), (1, 3), (2, 1)])).count() == 0


def test_last_prediction_still_ahead_counts(spark):
    row = arrivals.predicted_arrivals(updates(spark, [(0, 3), (1, 3), (2, 3), (4, 3), (5, 4)])).select(F.unix_seconds("actual_arrival_ts").alias("t"), "arrival_bracket_sec", "observation_count").first()
    assert tuple(row) == (int(at(3).timestamp()), 60, 5)


def test_never_crossed_is_no_arrival(spark):
    assert arrivals.predicted_arrivals(updates(spark, [(0, 9), (1, 9), (2, None)])).count() == 0


def test_predictions_fill_gaps_only(spark):
    seen = arrivals.observed_arrivals(vehicles(spark, [(0, 1), (1, 2)]))
    said = arrivals.predicted_arrivals(updates(spark, [(0, 3), (4, 3)], sequence=2).unionByName(updates(spark, [(0, 5), (6, 5)], sequence=4)))
    rows = arrivals.combined_arrivals(seen, said).orderBy("stop_sequence").collect()
    assert [(r["stop_sequence"], r["arrival_source"]) for r in rows] == [(2, "vehicle_position"), (4, "trip_update")]


def test_reused_trip_id_is_split_into_runs_and_not_paired(spark):
    track = [(0, 1), (1, 2), (2, 3), (60, 1), (61, 2), (62, 3)]
    both = arrivals.numbered_runs(arrivals.observed_arrivals(vehicles(spark, track)))
    assert sorted((r["stop_sequence"], r["trip_run"]) for r in both.collect()) == [(2, 0), (2, 1), (3, 0), (3, 1)]
    paired = segments.paired(both).collect()
    assert sorted((r["trip_run"], r["from_stop_sequence"], r["stop_sequence"], r["actual_duration_sec"]) for r in paired) == [(0, 2, 3, 60), (1, 2, 3, 60)]


def _trips(spark):
    return spark.createDataFrame([("T1_20670", "RED", 0)], "trip_id string, route_id string, direction_id int"), spark.createDataFrame([("T1_20670", q, f"08:{q:02d}:00", f"08:{q:02d}:30", f"PF_{q}") for q in range(1, 5)] + [("GONE_1", 1, "25:30:00", "bad", "PF_1")], "trip_id string, stop_sequence int, arrival_time string, departure_time string, stop_id string")


def test_schedule_joins_by_plain_id_and_date(spark):
    trips, stop_times = _trips(spark)
    planned = schedule.scheduled_stop_times(trips, stop_times)
    assert planned.count() == 4  # stop times without a trip go
    dates = spark.createDataFrame([("2026-08-05", "RED"), ("2026-08-06", "RED"), ("2026-08-06", "BLUE")], "service_date string, route_id string")
    laid = schedule.scheduled_instants(planned, dates)
    assert laid.count() == 8
    both = arrivals.numbered_runs(arrivals.observed_arrivals(vehicles(spark, [(0, 1), (1, 2), (2, 3)])))
    rows = segments.build_segments(both, laid, "rail", "2026/1", "20670").collect()
    assert len(rows) == 1 and rows[0].scheduled_duration_sec == 60 and rows[0].delay_sec == 0 and rows[0].duration_plausible and not rows[0].schedule_version_agrees
    assert list(rows[0].asDict()) == list(segments.SEGMENT_COLUMNS)
    assert int(rows[0].scheduled_departure_ts.timestamp()) % 86400 == 12 * 3600 + 120  # 08:02 in New York is 12:02 UTC in August


@pytest.mark.parametrize(("duration", "bracket", "scheduled", "fine"), [(-45, 60, 120, True), (-45, 30, 120, False), (3600, 60, None, True), (3601, 60, None, False), (1201, 60, 120, False), (1200, 60, 120, True), (500, 60, 0, True), (None, 60, 120, False)])
def test_plausible_durations(spark, duration, bracket, scheduled, fine):
    from tramloom.functions.exprs import plausible

    df = spark.createDataFrame([(duration, bracket, scheduled)], "d int, b int, s int")
    assert df.select(plausible(F.col("d"), F.col("b"), F.col("s"), 3600, 10)).first()[0] is fine


def test_filter_counts_each_rule_on_what_is_left(spark):
    rows = [(False, False, None, "vehicle_position"), (True, False, None, "vehicle_position"), (True, True, None, "vehicle_position"), (True, True, 60, "trip_update")]
    df = spark.createDataFrame(rows, "duration_plausible boolean, arrival_confident boolean, scheduled_duration_sec int, arrival_source string")
    assert segments.filter_report(df).first().asDict() == {"n_rows": 4, "dropped_duration_plausible": 1, "dropped_arrival_confident": 1, "dropped_observed": 0, "dropped_scheduled": 1, "kept": 1}
    assert segments.filtered(df).count() == 1


def test_quality_of_no_segments(spark):
    from tramloom.operators.quality import segment_quality

    both = arrivals.numbered_runs(arrivals.observed_arrivals(vehicles(spark, [(0, 1)])))
    trips, stop_times = _trips(spark)
    empty = segments.build_segments(both, schedule.scheduled_instants(schedule.scheduled_stop_times(trips, stop_times), both), "rail", "x", None)
    row = segment_quality(empty).first()
    assert row["n_rows"] == 0 and row["implausible_rate"] == 0


def test_nested_snapshots(spark):
    shape = "captured_at timestamp, entities array<struct<trip_id:string,route_id:string,direction_id:int,start_date:string,vehicle_id:string,stop_id:string,stop_sequence:int,status:string,vehicle_epoch:long>>"
    df = spark.createDataFrame([(BASE, [("T1_2", "RED", 0, "20260805", "V1", "PF_1", 1, "STOPPED_AT", 0), (None, "RED", 0, None, "V2", "PF_1", 1, "X", 1), ("T9", None, None, None, "V3", None, None, "X", 1785931200)])], shape)
    rows = {r["trip_id"]: r for r in observations.vehicle_rows(df).collect()}
    assert set(rows) == {"T1_2", "T9"} and rows["T1_2"]["vehicle_ts"] is None and rows["T1_2"]["schedule_version"] == "2"
    assert rows["T9"]["service_date"] == "2026-08-05" and rows["T9"]["schedule_version"] is None and rows["T9"]["vehicle_ts"] is not None
    stops = "captured_at timestamp, entities array<struct<trip_id:string,route_id:string,direction_id:int,start_date:string,vehicle_id:string,stops:array<struct<stop_sequence:int,stop_id:string,relationship:string,arrival_epoch:long,departure_epoch:long>>>>"
    df = spark.createDataFrame([(BASE, [("T1_2", "RED", 0, "20260805", "V1", [(1, "PF_1", "SCHEDULED", 1785931200, 0), (2, "PF_2", "SKIPPED", 1785931200, 0), (3, "PF_3", None, None, 1785931200)])])], stops)
    rows = observations.trip_update_rows(df).orderBy("stop_sequence").collect()
    assert [(r["stop_sequence"], r["arrival_ts"] is not None, r["departure_ts"] is not None) for r in rows] == [(1, True, False), (3, False, True)]


def _coverage(spark, counts, cadence, now):
    hours = spark.createDataFrame([("f", at(60 * i), n) for i, n in enumerate(counts)], "feed string, hour timestamp, n long")
    speed = spark.createDataFrame([("f", cadence)], "feed string, interval_seconds long")
    return quality.coverage(quality.hour_status(hours, speed, F.lit(now))).first()


def test_coverage_by_measured_cadence(spark):
    row = _coverage(spark, [60, 31, 0, 5], 60, at(180))
    assert (row["complete_hours"], row["short_hours"], row["empty_hours"], row["pending_hours"], row["missing_snapshots"]) == (1, 1, 1, 1, 89)
    assert _coverage(spark, [60], 30, at(600))["short_hours"] == 1  # half of what 30 s gives
    assert _coverage(spark, [60], None, at(600))["complete_hours"] == 1


def test_modal_interval_takes_the_first_seen_of_equals(spark):
    df = spark.createDataFrame([("f", at(m)) for m in (0, 2, 3, 5, 6)], "feed string, captured_at timestamp")
    assert observations.modal_interval(df).first()["interval_seconds"] == 120
    assert observations.modal_interval(df.limit(0)).count() == 0
    assert DEFAULT.expected_per_hour == 60
