"""What grows with the tables is dealt out, built once, and handled in bulk."""

import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from tramloom import queries
from tramloom.operators import arrivals, features
from tramloom.plans import pipelines
from tramloom.queries import base, history
from tramloom.sources import bridge, tables
from tramloom.streaming import feeds


def test_a_timetable_from_one_small_file_is_made_by_many_tasks(spark, sf):
    """F1, F3 to F6: one task made all stop times of a file that is one split."""
    assert bridge.stop_times(spark, sf).rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


class _Handle:
    """State of one key, with counts of the calls."""

    def __init__(self):
        self.calls, self.kept, self.timers = Counter(), {}, set()

    def _state(self, name, schema):
        return _State(self, name)

    getListState = getValueState = _state  # noqa: N815

    def registerTimer(self, at):  # noqa: N802
        self.calls["timer"] += 1
        self.timers.add(at)

    def deleteTimer(self, at):  # noqa: N802
        self.timers.discard(at)

    def listTimers(self):  # noqa: N802
        return iter(sorted(self.timers))


class _State:
    def __init__(self, handle, name):
        self.handle, self.name = handle, name

    def exists(self):
        return self.name in self.handle.kept

    def get(self):
        self.handle.calls["get"] += 1
        found = self.handle.kept.get(self.name, [])
        return iter(found) if isinstance(found, list) else found

    def update(self, value):
        self.handle.calls["put"] += 1
        self.handle.kept[self.name] = value

    put = update

    def appendList(self, values):  # noqa: N802
        self.handle.calls["put"] += 1
        self.handle.kept.setdefault(self.name, []).extend(values)

    def clear(self):
        self.handle.kept.pop(self.name, None)


class _Mark:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):  # noqa: N802
        return self.ms


_NOON = 1_785_931_200  # seconds


def _sightings(trips, n, seed):
    rng = np.random.default_rng(seed)
    rows = [(f"T{t}", _NOON + int(s), int(q)) for t in range(trips) for s, q in zip(rng.integers(0, 7200, n), rng.integers(0, 9, n), strict=True)]
    return pd.DataFrame(rows, columns=["trip_id", "at", "stop_sequence"]).drop_duplicates(["trip_id", "at"]).sample(frac=1, random_state=seed)


def _frame(rows):
    return rows.assign(captured_at=pd.to_datetime(rows["at"], unit="s"), stop_id=None).drop(columns="at")


def _fire(work, handle, ms):
    for at in sorted(x for x in handle.timers if x < ms):
        handle.timers.discard(at)
        yield from work.handleExpiredTimer((0,), _Mark(ms), None)


def test_trips_of_a_bucket_are_taken_by_as_few_calls_as_one_trip(spark):
    """each trip had calls, a list and timers of its own."""
    calls = {}
    for trips in (1, 300):
        rows, handle = _sightings(trips, 40, 5), _Handle()
        work = feeds._Arrivals(180, 86_400_000)
        work.init(handle)
        half, out = len(rows) // 2, []
        first = rows[rows["at"] < _NOON + 3600]
        for part, ms in ((first, _NOON + 1800), (rows.drop(first.index), _NOON + 5000), (rows[:0], _NOON + 9000)):
            list(work.handleInputRows((0,), iter([_frame(part[:half]), _frame(part[half:])]), None))
            out += _fire(work, handle, ms * 1000)
        calls[trips] = sum(handle.calls.values())
        got = pd.concat(out)
        assert len(handle.kept["last"][0]) == trips and "waiting" not in handle.kept
        list(_fire(work, handle, (_NOON + 10_000 + 86_400) * 1000))  # all have been idle
        assert not handle.kept and not handle.timers
        made = spark.createDataFrame([(pd.Timestamp(int(a), unit="s").to_pydatetime(), "d", t, t, None, None, None, None, None, int(q)) for t, a, q in rows.itertuples(index=False)], "captured_at timestamp, service_date string, trip_id string, scheduled_trip_id string, schedule_version string, route_id string, direction_id int, vehicle_id string, stop_id string, stop_sequence int")
        names = ["trip_id", "trip_run", "stop_sequence", "arrival_bracket_sec", "sequence_jump", "arrival_confident", "actual_arrival_ts"]
        want = arrivals.numbered_runs(arrivals.observed_arrivals(made)).select(names).toPandas()
        assert sorted(map(tuple, got[names].to_numpy().tolist())) == sorted(map(tuple, want.to_numpy().tolist())) and len(want) > 10 * trips
    assert calls[300] <= calls[1] + 2


@pytest.mark.parametrize("name", ["evaluation_report", "unseen_rate", "codes_applied"])
def test_both_parts_of_a_split_come_from_segments_built_once(spark, sf, monkeypatch, name):
    """training and validation parts were taken from two tables of segments."""
    written, put = Counter(), tables.materialize
    monkeypatch.setattr(tables, "materialize", lambda df, kind: (written.update([kind]), put(df, kind))[1])
    queries.queries()[name](spark, sf).collect()
    assert written["segments"] == 1


def test_segments_read_events_once_for_vehicles(spark, sf):
    """observed arrivals were made once more for the predictions that they exclude."""
    plan = base.combined(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"FileScan parquet [^\n]*events\.parquet", plan)) == 1


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_text_of_an_event_is_parsed_once(spark, sf):
    """the filter on stop sequences, pushed below the columns, parsed it once more."""
    for df in (base.observed(spark, sf), base.predicted(spark, sf)):
        assert len(re.findall(r"get_json_object|json_tuple", _plan(df))) == 1


def test_odd_texts_of_events_give_what_the_path_gives(spark, tmp_path):
    odd = ['{"k": 76}', '{"k": "7"}', '{"a": {"k": 3}, "k": 12}', '{"k": null}', '{"a": 1}', '[{"k": 1}]', '{"k": -3}', '{"k": 5', "", "none", None]
    made = spark.createDataFrame([(i, None, 1, "view", 1.0, p) for i, p in enumerate(odd)], "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    made.write.parquet(f"{tmp_path}/events.parquet")
    got = {r["event_id"]: r["stop_sequence"] for r in bridge.vehicle_observations(spark, str(tmp_path)).collect()}
    want = made.selectExpr("event_id", "cast(get_json_object(props, '$.k') as int) % 10 AS q").collect()
    assert got == {r["event_id"]: r["q"] for r in want} and got[0] == 6 and got[2] == 2 and len(got) == len(odd)


def test_stop_times_meet_their_trips_without_another_shuffle(spark, sf):
    """stop times were dealt out by another key than they are joined by, and then shuffled again, ten rows a trip."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert len(re.findall(r"Exchange hashpartitioning", _plan(base.planned(spark, sf)))) == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_the_table_of_a_model_holds_its_own_features_alone(spark, sf, monkeypatch):
    """all features were made, carried through every shuffle and written, of which a model reads nine."""
    written, put = {}, tables.materialize
    monkeypatch.setattr(tables, "materialize", lambda df, kind: (written.update({kind: df.columns}), put(df, kind))[1])
    got = history._table(spark, sf)
    assert sorted(written["features"]) == sorted({*features.PAST, *history._COLUMNS})
    whole = pipelines.feature_table(base.built(spark, sf), base.S).select(got.columns)
    assert got.count() == whole.count() > 0 and not got.exceptAll(whole).count()


@pytest.mark.parametrize("only", [("recent_age_sec",), ("recent_vs_scheduled", "fare_period"), ("headway_sec",), ("upstream_delay_last_sec", "stops_remaining"), ()])
def test_some_features_are_as_among_all(spark, sf, only):
    rows = base.kept(spark, sf)
    got, whole = features.all_features(rows, base.S, only=only), features.all_features(rows, base.S)
    assert sorted(got.columns) == sorted({*features.PAST, *only})
    assert not got.exceptAll(whole.select(got.columns)).count() and got.count() == whole.count() > 0
