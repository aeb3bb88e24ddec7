"""Queries that run whole plans: windows, catching up, published tables, reports, toggles."""

from __future__ import annotations

import dataclasses
import uuid
from datetime import datetime

from pyspark.sql import functions as F

from tramloom.operators import arrivals, journeys, segments, split
from tramloom.plans import pipelines
from tramloom.queries import feeds, history, travel
from tramloom.queries.base import TIE, S, built, dated, observed, r
from tramloom.queries.sql import Query, sql
from tramloom.sources import bridge, observations, published, tables

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def add(name: str, run: Query, text: str | None = None) -> None:
    QUERIES[name] = run
    if text is not None:
        SQL[name] = text


def _folder(s, name):
    return f"{tables.shared_folder(s)}/{name}-{uuid.uuid4().hex}"


def _inputs(s, d):
    return bridge.vehicle_observations(s, d), bridge.trip_update_observations(s, d), bridge.trips(s, d), bridge.stop_times(s, d)


def _by_date(rows):
    total = lambda c, name: F.sum(c).cast("long").alias(name)
    return rows.groupBy("service_date").agg(F.count("*").alias("n"), total("actual_duration_sec", "total_sec"), total("delay_sec", "total_delay"), total("trip_run", "runs"))


_BY_DATE = "count(*) AS n, sum(dur)::BIGINT AS total_sec, sum(delay)::BIGINT AS total_delay, sum(trip_run)::BIGINT AS runs"


# --- a window, and catching up -------------------------------------------------------------------------------------
def _window(s, d):
    """A table of nine dates, of which the run of a window replaces the three that it covers whole."""
    path, at = _folder(s, "window"), lambda t: F.to_timestamp(F.lit(t))
    rows = built(s, d)
    published.publish(rows.where("service_date between '2024-01-02' and '2024-01-10'"), path)
    pipelines.run_window(*_inputs(s, d), at("2024-01-05 00:00:00"), at("2024-01-09 00:00:00"), path, S, TIE)
    return _by_date(published.read(s, path, rows.schema))


_BEFORE = sql(f"SELECT service_date, {_BY_DATE} FROM segs WHERE service_date BETWEEN '2024-01-02' AND '2024-01-10' AND service_date NOT BETWEEN '2024-01-05' AND '2024-01-07' GROUP BY 1", "segs")
_WITHIN = sql(f"SELECT service_date, {_BY_DATE} FROM segs WHERE service_date BETWEEN '2024-01-05' AND '2024-01-07' GROUP BY 1", "segs").replace("FROM events", "FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-09'", 1)
add("window_run", _window, f"SELECT * FROM ({_BEFORE}) UNION ALL SELECT * FROM ({_WITHIN})")
_DONE = ["2024-01-03", "2024-01-06"]


def _caught_up(s, d):
    """Two dates are done already, one in the middle; the others are written, each from its own service day."""
    path = _folder(s, "caught-up")
    done = s.createDataFrame([(x,) for x in _DONE], "service_date string")
    pipelines.catch_up(s, *_inputs(s, d), done, F.to_timestamp(F.lit("2024-01-12 12:00:00")), path, S, TIE)
    return _by_date(published.read(s, path, built(s, d).schema))


_RUN_DATES = f"""rds AS (SELECT d, strftime(d, '%Y-%m-%d') AS rd FROM (SELECT unnest(range(DATE '2023-12-29', DATE '2024-01-13', INTERVAL 1 DAY)) AS d)
  WHERE d + INTERVAL 33 HOUR <= TIMESTAMP '2024-01-12 12:00:00' AND d + INTERVAL 5 HOUR >= (SELECT min(ts) FROM events WHERE event_type IN ('view', 'click', 'purchase')) AND strftime(d, '%Y-%m-%d') NOT IN ({', '.join(f"'{x}'" for x in _DONE)}))"""
add(
    "caught_up",
    _caught_up,
    sql(f"SELECT service_date, {_BY_DATE} FROM segs WHERE service_date = split_part(trip_id, '|', 1) GROUP BY 1", "segs")
    .replace("WITH ", f"WITH {_RUN_DATES},\n", 1)
    .replace("user_id::VARCHAR AS trip_id", "rd || '|' || user_id AS trip_id", 1)
    .replace("FROM events),\nvp", "FROM events JOIN rds ON ts >= d + INTERVAL 5 HOUR AND ts < d + INTERVAL 33 HOUR),\nvp", 1)
    .replace("c_custkey::VARCHAR AS trip_id", "rd || '|' || c_custkey AS trip_id", 1)
    .replace("FROM customer, range(0, 10) t(q)", "FROM customer, rds, range(0, 10) t(q)", 1),
)


def _window_quality(s, d):
    """What the run of a window says of itself, observed while it wrote."""
    at = lambda t: F.to_timestamp(F.lit(t))
    found = pipelines.run_window(*_inputs(s, d), at("2024-01-05 00:00:00"), at("2024-01-09 00:00:00"), _folder(s, "window"), S, TIE)
    whole = [c for c in found.columns if c not in ("implausible", "delay_p05", "delay_median", "delay_p95", "implausible_rate")]
    return found.select(*whole, *[r(c) for c in ("delay_p05", "delay_median", "delay_p95")], r("implausible_rate", digits=6))


_WHOLE, _, _REST = travel.SQL["segment_quality"].rpartition("FROM segs")
add("window_quality", _window_quality, f"{_WHOLE}FROM segs WHERE service_date BETWEEN '2024-01-05' AND '2024-01-07'{_REST}".replace("FROM events", "FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-09'", 1))


def _archived(s, d):
    """Captures by hour of three days, through an archive of raw observations that is read by its folders."""
    path, rows = _folder(s, "archive"), bridge.vehicle_observations(s, d)
    tables.write_archive(rows.where("captured_at < timestamp '2024-01-07'"), path, "vehicles")
    tables.write_archive(rows.where("captured_at >= timestamp '2024-01-07'"), path, "vehicles")
    start, end = (datetime(2024, 1, day, 6, 30) for day in (5, 8))
    held = tables.read_archive(s, path, rows.schema, "vehicles", start, end)
    hours = observations.hour_spine(s, F.to_timestamp(F.lit(str(start))), F.to_timestamp(F.lit(str(end))))
    return observations.counts_by_hour(held, hours).select(F.unix_seconds("hour").alias("hour_sec"), "n")


add(
    "archive_written_and_read",
    _archived,
    sql("""SELECT epoch(h)::BIGINT AS hour_sec, count(cap) AS n FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-05 06:00:00', TIMESTAMP '2024-01-08 06:00:00', INTERVAL 1 HOUR)) AS h)
      LEFT JOIN (SELECT * FROM vp WHERE captured_at >= TIMESTAMP '2024-01-05 06:30:00' AND captured_at < TIMESTAMP '2024-01-08 06:30:00') ON date_trunc('hour', captured_at) = h GROUP BY h""", "vp"),
)


# --- published tables ----------------------------------------------------------------------------------------------
_FEATURES = ("local_hour", "fare_period", "headway_sec", "recent_duration_median", "upstream_delay_sec")
add(
    "features_published",
    lambda s, d: pipelines.publish_features(built(s, d), _folder(s, "features"), _FEATURES, S).select("feature", r("fill", digits=6), "n_distinct", r("mean"), "sparse"),
    history.SQL["feature_summary"],
)
add(
    "journeys_published",
    lambda s, d: pipelines.publish_journeys(built(s, d), _folder(s, "journeys"), S).select("n_segments", "n_rows", r("p05"), r("median"), r("p95")),
    history.SQL["journey_summary"],
)


def _lookup(s, d):
    found = pipelines.publish_lookup(built(s, d), _folder(s, "lookup"), S)
    return found.select("from_stop_id", "to_stop_id", F.unix_seconds("completed_at").alias("completed_sec"), *[r(c) for c in ("roll_median", "roll_mean", "roll_delay_mean", "roll_deviation")], F.col("roll_n").cast("int").alias("roll_n"))


add("lookup_published", _lookup, history.SQL["conditions_lookup"])


def _decoded(s, d):
    at = lambda t: F.to_timestamp(F.lit(t))
    return pipelines.decoded(bridge.vehicle_snapshots(s, d), "vehicles", _folder(s, "decoded"), at("2024-01-05 00:00:00"), at("2024-01-09 00:00:00")).select("feed", "n_rows", "snapshots", "hours", "service_dates")


_HOUR = "(cap // 3600) * 3600"
add(
    "feed_decoded",
    _decoded,
    sql(
        f"""SELECT 'vehicles' AS feed, count(*) AS n_rows, count(DISTINCT {_HOUR}) AS snapshots, count(DISTINCT {_HOUR}) AS hours,
      count(DISTINCT CASE WHEN direction_id = 0 THEN service_date ELSE strftime(make_timestamp(({_HOUR} - 18000) * 1000000), '%Y-%m-%d') END) AS service_dates
      FROM vp WHERE event_id % 11 <> 0 AND {_HOUR} >= 1704412800 AND {_HOUR} < 1704758400""",
        "vp",
    ),
)


# --- splits of journeys, toggles -----------------------------------------------------------------------------------
def _parts(s, d):
    return split.split_journeys(journeys.build_journeys(dated(s, d), S), S)


add(
    "journey_split_report",
    lambda s, d: split.journey_split_report(_parts(s, d)),
    sql("SELECT split, count(*) AS n_rows, count(DISTINCT (service_date, trip_id, trip_run, block_no)) AS blocks, count(DISTINCT service_date) AS dates, min(dep) AS first, max(dep) AS last FROM jsplit GROUP BY 1", "jsplit"),
)
add(
    "journey_split_warnings",
    lambda s, d: split.journey_split_warnings(_parts(s, d), S),
    sql(
        """SELECT *, days < 14 AS too_few_days, validation_days < 2 AS single_validation_day, validation_days > 0 AND shared_days = validation_days AS validation_days_all_in_training
      FROM (SELECT count(*) AS days, sum(t)::BIGINT AS train_days, sum(v)::BIGINT AS validation_days, sum(t * v)::BIGINT AS shared_days
      FROM (SELECT service_date, max((split = 'train')::INT) AS t, max((split = 'validation')::INT) AS v FROM jsplit WHERE split <> 'embargo' GROUP BY 1))""",
        "jsplit",
    ),
)
_TOGGLES = {"plain": {}, "any_duration": {"plausible_only": False}, "any_confidence": {"confident_only": False}, "observed": {"observed_only": True}, "scheduled_only": {"plausible_only": False, "confident_only": False}}


def _toggled(s, d):
    rows, found = built(s, d), None
    for name, options in _TOGGLES.items():
        own = segments.filtered(rows, dataclasses.replace(S, **options)).agg(F.count("*").alias("kept")).select(F.lit(name).alias("toggle"), "kept")
        found = own if found is None else found.unionByName(own)
    return found


_WHERE = {"plain": "plausible AND confident", "any_duration": "confident", "any_confidence": "plausible", "observed": "plausible AND confident AND src = 'vehicle_position'", "scheduled_only": "true"}
add("filter_toggles", _toggled, sql(" UNION ALL ".join(f"SELECT '{n}' AS toggle, count(*) AS kept FROM segs WHERE sdur IS NOT NULL AND {w}" for n, w in _WHERE.items()), "segs"))


# --- reports -------------------------------------------------------------------------------------------------------
def _long(select: str, part: str, about: str, names: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT '{part}' AS part, {about} AS about, '{n}' AS measure, {n}::DOUBLE AS value FROM ({select})" for n in names)


def _body(text: str) -> tuple[str, str]:
    """The named parts and the final select of a query's SQL."""
    head, _, tail = text.rpartition(")\n")
    return head + ")", tail


def _evaluation(s, d):
    rows = history.split_of(s, d)  # both parts of one split
    found = pipelines.evaluation_report(history.validated(rows), "pred", S, history.codes(rows), history.CATEGORIES)
    return found.select("part", "about", "measure", r("value", digits=3))


_BLOCKS = _body(history.SQL["block_diagnostics"])[1].replace("FROM blocks", "FROM sblocks")
_UNSEEN = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", 100 * avg(({c} NOT IN (SELECT {c} FROM split WHERE split = 'train'))::INT) AS unseen_pct FROM scored" for c in history.CATEGORIES)


_PARTS, _LEVEL = _body(history.SQL["segment_level"])
_NEEDED, _LENGTH = _body(history.SQL["journey_level"])
_ROUTES = _body(history.SQL["error_by_group"])[1]
add(
    "evaluation_report",
    _evaluation,
    f"{_NEEDED}, b AS (SELECT service_date, trip_id, trip_run, block_no, count(*) AS n FROM sblocks GROUP BY ALL), u AS (SELECT service_date, trip_id, trip_run, count(*) AS b, sum(n) AS n FROM b GROUP BY ALL), diagnosed AS ({_BLOCKS})\nSELECT part, about, measure, round(value, 3) AS value FROM ("
    + " UNION ALL ".join(
        [
            _long(_LEVEL, "segments", "baseline", ["n_rows", "mae", "rmse", "median_abs"]),
            _long(_LENGTH, "journeys", "n_segments::VARCHAR", ["n", "median_sec", "model_mae", "baseline_mae", "beats_pct"]),
            _long(_ROUTES, "routes", "route_id", ["n", "pred_mae"]),
            _long("SELECT avg(dur - pred) AS \"offset\" FROM scored", "calibration", "'pred'", ["\"offset\""]).replace("'\"offset\"'", "'offset'"),
            _long(_UNSEEN, "unseen", '"column"', ["unseen_pct"]),
            _long("SELECT * FROM diagnosed", "blocks", "''", ["n_segments", "runs", "blocks", "pairs", "broken", "median_block", "contiguous_pct"]),
        ]
    )
    + ")",
)


def _quality(s, d):
    found = pipelines.quality_report(built(s, d), bridge.realtime_ids(s, d), bridge.trips(s, d), feeds.hours(s, d), S)
    return found.where("measure <> 'implausible'").select("part", "about", "measure", r("value", digits=3))


def _wide(part: str, query: str, about: str, names: list[str]) -> str:
    """A query's columns as rows of measure and value."""
    values = ", ".join(f"{n}::DOUBLE" for n in names)
    return f"SELECT '{part}' AS part, {about} AS about, unnest([{', '.join(repr(n) for n in names)}]) AS measure, unnest([{values}]) AS value FROM ({query})"


_SEGMENT = ["n_rows", "negative_duration", "implausibly_long", "ratio_outliers", "sequence_gaps", "missing_schedule", "low_confidence", "from_predictions", "stale_schedule_version", "repeat_run_rows", "delay_p05", "delay_median", "delay_p95", "implausible_rate"]
_MATCH = ["observations", "revenue", "matched", "matched_by_versioned_id", "trips", "match_rate"]
_COVERAGE = ["hours", "complete_hours", "short_hours", "empty_hours", "pending_hours", "expected_per_hour", "missing_snapshots"]
_BLOCKING = f"""SELECT 'blocking' AS part, '' AS about, 'low_match_rate' AS measure, match_rate AS value FROM ({travel.SQL['match_report']}) WHERE match_rate < 0.95
  UNION ALL SELECT 'blocking', '', 'implausible_segments', implausible_rate FROM ({travel.SQL['segment_quality']}) WHERE implausible_rate > 0.05
  UNION ALL SELECT 'blocking', feed, 'empty_hours', empty_hours::DOUBLE FROM ({feeds.SQL['snapshot_coverage']}) WHERE empty_hours > 0"""
add(
    "quality_report",
    _quality,
    "SELECT part, about, measure, round(value, 3) AS value FROM ("
    + " UNION ALL ".join([_wide("segments", travel.SQL["segment_quality"], "''", _SEGMENT), _wide("match", travel.SQL["match_report"], "''", _MATCH), _wide("coverage", feeds.SQL["snapshot_coverage"], "feed", _COVERAGE), _BLOCKING])
    + ")",
)


def _exploration(s, d):
    vehicles = bridge.vehicle_observations(s, d).withColumn("vehicle_ts", F.timestamp_seconds(F.unix_seconds("captured_at") - F.col("event_id") % 97)).drop("event_id")
    updates = bridge.trip_update_observations(s, d)
    static = (bridge.realtime_ids(s, d), bridge.trips(s, d), bridge.stop_times(s, d), bridge.stops(s, d))
    found = pipelines.exploration_report(vehicles, updates.drop("event_id"), observed(s, d), S, feeds.hours(s, d), static, arrivals.prediction_lifetimes(updates, TIE))
    return found.select("part", "about", "measure", r("value", digits=6))


_SAME = ["captured_at", "service_date", "trip_id", "scheduled_trip_id", "schedule_version", "route_id", "direction_id", "vehicle_id", "stop_id", "stop_sequence"]
_SET = lambda part, names: f"SELECT '{part}' AS part, unnest([{', '.join(repr(n) for n in names)}]) AS about, 'share' AS measure, 1.0::DOUBLE AS value"
_UPDATES = f"""SELECT 'update_fields' AS part, 'departure_ts' AS about, 'share' AS measure, count_if(stop_sequence % 2 = 0) / count(*)::DOUBLE AS value FROM tu
  UNION ALL SELECT 'updates', 'relationship=' || event_type, 'n', count(*)::DOUBLE FROM tu GROUP BY event_type
  UNION ALL (SELECT 'updates', 'departs_at=' || stop_sequence, 'n', count(*)::DOUBLE FROM tu WHERE stop_sequence % 2 = 0 GROUP BY stop_sequence)"""
add(
    "exploration_report",
    _exploration,
    sql("", "tu").rstrip()
    + "\nSELECT part, about, measure, round(value, 6) AS value FROM ("
    + " UNION ALL ".join(
        [_SET("vehicle_fields", [*_SAME, "status", "vehicle_ts"]), _SET("update_fields", [*_SAME, "arrival_ts", "relationship"]), _UPDATES, _wide("arrivals", travel.SQL["arrival_viability"], "''", ["arrivals", "within_share", "one_stop_share", "unseen_stops", "median_bracket"])]
        + [_wide("vehicles", f"SELECT * FROM ({feeds.SQL['value_counts']})", "'status=' || value", ["n"]), _wide("vehicles", f"SELECT * FROM ({feeds.SQL['top_stops'].replace('LIMIT 5', 'LIMIT 8')})", "'stop_id=' || value", ["n"])]
        + [_wide("report_age", feeds.SQL["report_age"], "''", ["n", "median", "p95", "longest"]), _wide("predictions", feeds.SQL["prediction_drift"], "''", ["pairs", "settled", "median_drift", "most_observations"])]
        + [_wide("hours", f"SELECT feed, status, count(*) AS hours, sum(n) AS snapshots, sum(shortfall) AS shortfall FROM ({feeds.SQL['hour_shortfall']}) GROUP BY ALL", "feed || '=' || status", ["hours", "snapshots", "shortfall"])]
        + [f"SELECT 'timetable' AS part, measure AS about, 'n' AS measure, n::DOUBLE AS value FROM ({travel.SQL['static_join_report']})"]
    )
    + ")",
)
