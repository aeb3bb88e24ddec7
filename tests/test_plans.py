"""Windows, catching up, published tables, saved models, splits of journeys."""

import dataclasses
import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tramloom.config import DEFAULT
from tramloom.operators import encode, features, model, segments, split
from tramloom.plans import pipelines
from tramloom.sources import published, tables

S = dataclasses.replace(DEFAULT, lookback_days=6)
DAYS = [f"2026-08-{d:02d}" for d in range(4, 9)]
VEHICLE = "captured_at timestamp, service_date string, trip_id string, scheduled_trip_id string, schedule_version string, route_id string, direction_id int, vehicle_id string, stop_id string, stop_sequence int, status string"
UPDATE = VEHICLE.replace("status string", "arrival_ts timestamp, departure_ts timestamp, relationship string")


def _vehicles(spark, days=DAYS):
    rows = []
    for d in days:
        start = datetime.fromisoformat(d).replace(tzinfo=timezone.utc) + timedelta(hours=12)
        for t in range(3):
            for q in range(1, 8):
                rows.append((start + timedelta(hours=t, minutes=2 * q), d, f"T{t}_1", f"T{t}", "1", "RD", 0, f"V{t}", f"PF_A0{q}_C", q, "STOPPED_AT"))
        late = datetime.fromisoformat(d).replace(tzinfo=timezone.utc) + timedelta(hours=29)  # 01:00 of the next local day, still this service day
        rows += [(late + timedelta(minutes=2 * q), d, "L_1", "L", "1", "RD", 0, "VL", f"PF_A0{q}_C", q, "STOPPED_AT") for q in range(1, 5)]
    return spark.createDataFrame(rows, VEHICLE)


@pytest.fixture
def world(spark):
    trips = spark.createDataFrame([(f"{t}_1", "RD", 0) for t in ("T0", "T1", "T2", "L")], "trip_id string, route_id string, direction_id int")
    stop_times = spark.createDataFrame([(f"{t}_1", q, f"{h:02d}:{2 * q:02d}:00", f"{h:02d}:{2 * q:02d}:00", f"PF_A0{q}_C") for t, h in (("T0", 8), ("T1", 9), ("T2", 10), ("L", 25)) for q in range(1, 8)], "trip_id string, stop_sequence int, arrival_time string, departure_time string, stop_id string")
    return spark.createDataFrame([], UPDATE), trips, stop_times


def _written(spark, path, schema):
    rows = published.read(spark, path, schema)
    return {r["service_date"]: r["n"] for r in rows.groupBy("service_date").agg(F.count("*").alias("n")).collect()}


def _at(text):
    return F.to_timestamp(F.lit(text))


def test_run_window_replaces_the_dates_that_it_covers(spark, world, tmp_path):
    path, vehicles = str(tmp_path / "segments"), _vehicles(spark)
    schema = pipelines.segments_of(vehicles, *world, settings=S).schema
    one = pipelines.run_window(vehicles, *world, _at("2026-08-05 04:00:00"), _at("2026-08-07 08:00:00"), path, S).first()
    per_day = 3 * 6 - 3 + 3 - 1  # the first sighting of a trip is no arrival
    assert one["n_rows"] == 2 * per_day
    assert _written(spark, path, schema) == {d: per_day for d in ("2026-08-05", "2026-08-06")}
    again = pipelines.run_window(vehicles, *world, _at("2026-08-05 04:00:00"), _at("2026-08-07 08:00:00"), path, S).first()
    assert again == one and _written(spark, path, schema) == {d: per_day for d in ("2026-08-05", "2026-08-06")}
    # a date without rows now keeps none; the other and those outside the window stay
    pipelines.run_window(_vehicles(spark, ["2026-08-06", "2026-08-07"]), *world, _at("2026-08-05 04:00:00"), _at("2026-08-07 08:00:00"), path, S)
    assert _written(spark, path, schema) == {"2026-08-06": per_day}
    pipelines.run_window(_vehicles(spark, ["2026-08-08"]), *world, _at("2026-08-08 04:00:00"), _at("2026-08-09 08:00:00"), path, S)
    assert set(_written(spark, path, schema)) == {"2026-08-06", "2026-08-08"}


def test_catch_up_fills_gaps_and_is_what_single_runs_give(spark, world, tmp_path):
    vehicles = _vehicles(spark)
    schema = pipelines.segments_of(vehicles, *world, settings=S).schema
    path, now = str(tmp_path / "all"), _at("2026-08-08 20:00:00")  # the day of the 8th is not over
    done = lambda *d: spark.createDataFrame([(x,) for x in d], "service_date string")
    assert pipelines.catch_up(spark, vehicles, *world, done("2026-08-05"), now, path, S, archive_start=_at("2026-08-04 00:00:00")) == ["2026-08-04", "2026-08-06", "2026-08-07"]
    found = _written(spark, path, schema)
    assert set(found) == {"2026-08-04", "2026-08-06", "2026-08-07"} and len(set(found.values())) == 1
    single = str(tmp_path / "single")
    pipelines.run_window(vehicles, *world, _at("2026-08-06 04:00:00"), _at("2026-08-07 08:00:00"), single, S)
    where = lambda p: sorted(map(str, published.read(spark, p, schema, ["2026-08-06"]).select(*sorted(schema.names)).collect()))
    assert where(path) == where(single) != []
    dates = tables.completed_dates(published.read(spark, path, schema))
    assert pipelines.catch_up(spark, vehicles, *world, dates, now, path, S, archive_start=_at("2026-08-04 00:00:00")) == ["2026-08-05"]
    assert pipelines.catch_up(spark, vehicles, *world, tables.completed_dates(published.read(spark, path, schema)), now, path, S, archive_start=_at("2026-08-04 00:00:00")) == []
    forced = pipelines.catch_up(spark, vehicles, *world, dates, now, path, S, force=True, archive_start=_at("2026-08-06 00:00:00"))
    assert forced == ["2026-08-06", "2026-08-07"] and len(_written(spark, path, schema)) == 4
    assert pipelines.catch_up(spark, spark.createDataFrame([], VEHICLE), *world, dates, now, path, S) == []


def test_catch_up_reads_only_the_days_it_writes(spark, world):
    rows = pipelines.on_run_dates(_vehicles(spark), ["2026-08-06"], S)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "captured_at" in plan.split("Filter", 1)[1]
    assert {r["service_date"] for r in rows.select("service_date").distinct().collect()} == {"2026-08-05", "2026-08-06"}  # the 5th's tail lies in the day too
    assert rows.count() == 25 + 4


def test_stop_ids_are_never_features(spark):
    row = spark.createDataFrame([("d", "t", 0, "a", "b", "a>b", "A01", 3, 9)], "service_date string, trip_id string, trip_run int, from_stop_id string, to_stop_id string, segment_id string, from_station string, local_hour int, actual_duration_sec int")
    assert encode.feature_columns(row) == ["segment_id", "from_station", "local_hour"]


def test_filter_and_feature_toggles(spark):
    row = lambda **k: {"duration_plausible": True, "arrival_confident": True, "arrival_source": "vehicle_position", "scheduled_duration_sec": 60} | k
    rows = spark.createDataFrame([row(), row(duration_plausible=False), row(arrival_confident=False), row(arrival_source="trip_update"), row(scheduled_duration_sec=None)], "duration_plausible boolean, arrival_confident boolean, arrival_source string, scheduled_duration_sec int")
    kept = lambda **k: segments.filtered(rows, dataclasses.replace(S, **k)).count()
    assert (kept(), kept(plausible_only=False), kept(confident_only=False), kept(observed_only=True), kept(plausible_only=False, confident_only=False)) == (2, 3, 3, 1, 4)
    report = segments.filter_report(rows, dataclasses.replace(S, confident_only=False)).first()
    assert (report["dropped_arrival_confident"], report["dropped_duration_plausible"], report["kept"]) == (0, 1, 3)


def test_feature_groups_can_be_left_out(spark, world):
    rows = pipelines.segments_of(_vehicles(spark, DAYS[:1]), *world, settings=S)
    plain = dataclasses.replace(S, historical_features=False, calendar_features=False)
    made = features.all_features(segments.filtered(rows, plain), plain).columns
    assert "headway_sec" not in made and "local_hour" not in made and {"trip_progress", "segment_id"} <= set(made)


def test_a_model_is_saved_and_loaded(spark, tmp_path):
    rng = random.Random(2)
    rows = spark.createDataFrame([(rng.choice("abc"), rng.randrange(24), None if i % 7 == 0 else float(rng.randrange(60)), 100 + 10 * (i % 5)) for i in range(200)], "route_id string, local_hour int, recent_deviation double, actual_duration_sec int")
    fitted = model.calibrate(model.fit(rows, ["route_id", "local_hour", "recent_deviation"], rounds=3, depth=3, bins=16), rows)
    path = str(tmp_path / "model")
    model.save(fitted, spark, path)
    model.save(fitted, spark, path)  # in place of the first
    back = model.load(spark, path)
    assert (back.columns, back.categories, back.offset) == (fitted.columns, fitted.categories, fitted.offset)
    score = lambda m: [tuple(r) for r in model.predict_calibrated(m, rows).orderBy(*rows.columns).select("prediction", "calibrated").collect()]
    assert score(back) == score(fitted)
    error = model.predict_calibrated(back, rows).agg(F.avg(F.col("actual_duration_sec") - F.col("calibrated"))).first()[0]
    assert abs(error) < 1e-9
    numbers = model.fit(rows, ["local_hour"], rounds=2, depth=2, bins=16)
    model.save(numbers, spark, path)
    assert score(model.load(spark, path)) == score(numbers)


def test_boundary_is_the_exact_percentile(spark):
    rng = random.Random(5)
    for n in (1, 2, 7, 500):
        rows = spark.createDataFrame([(datetime(2026, 8, 5, tzinfo=timezone.utc) + timedelta(microseconds=rng.randrange(10**9)),) for _ in range(n)] + [(None,)], "ts timestamp")
        for fraction in (0.2, 0.5, 0.0):
            s = dataclasses.replace(S, validation_fraction=fraction)
            want = rows.agg(F.percentile(F.unix_micros("ts"), F.lit(1 - fraction))).first()[0]
            assert split.boundary(rows, "ts", s).first()["boundary"] == pytest.approx(want, rel=1e-15)


def test_journey_split_warnings(spark):
    shape = "service_date string, trip_id string, trip_run int, block_no int, split string"
    one = lambda *rows: split.journey_split_warnings(spark.createDataFrame([(d, "t", 0, i, s) for i, (d, s) in enumerate(rows)], shape), S).first()
    w = one(("d1", "train"), ("d2", "train"), ("d2", "validation"), ("d3", "embargo"))
    assert (w["days"], w["train_days"], w["validation_days"], w["shared_days"]) == (2, 2, 1, 1)
    assert w["too_few_days"] and w["single_validation_day"] and w["validation_days_all_in_training"]
    w = one(*[(f"d{i:02d}", "train") for i in range(13)], ("e1", "validation"), ("e2", "validation"))
    assert not (w["too_few_days"] or w["single_validation_day"] or w["validation_days_all_in_training"])


def test_medians_never_see_validation_blocks(spark):
    shape = "service_date string, trip_id string, trip_run int, block_no int, x int"
    rows = spark.createDataFrame([("d", "t", 0, b, x) for b in range(4) for x in range(3)], shape)
    left = split.outside_blocks(rows, rows.where("block_no = 2 and x = 1"))
    assert sorted(r["block_no"] for r in left.collect()) == [0] * 3 + [1] * 3 + [3] * 3
