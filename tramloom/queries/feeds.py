"""Queries over raw snapshots, their coverage, service dates and archives."""

from __future__ import annotations

from pyspark.sql import functions as F

from tramloom.config import DEFAULT
from tramloom.functions import exprs as X
from tramloom.operators import arrivals, dates, explore, quality, schedule
from tramloom.queries.base import S, TIE, built, r
from tramloom.queries.sql import Query, sql
from tramloom.sources import bridge, observations, tables

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def add(name: str, run: Query, text: str | None = None) -> None:
    QUERIES[name] = run
    if text is not None:
        SQL[name] = text


def _flat(df, *more):
    return df.select(F.unix_seconds("captured_at").alias("captured_sec"), "service_date", "trip_id", "scheduled_trip_id", "schedule_version", "route_id", "direction_id", "vehicle_id", "stop_id", "stop_sequence", *more)


_COMMON = (
    "(cap // 3600) * 3600 AS captured_sec, {date} AS service_date, trip_id || '_20660' AS trip_id, trip_id AS scheduled_trip_id, "
    "'20660' AS schedule_version, route_id, direction_id, 'V' || trip_id AS vehicle_id, stop_id, stop_sequence::INT AS stop_sequence"
)
_HOUR_DATE = "strftime(make_timestamp(((cap // 3600) * 3600 - 18000) * 1000000), '%Y-%m-%d')"
add(
    "snapshots_flattened",
    lambda s, d: _flat(observations.vehicle_rows(bridge.vehicle_snapshots(s, d)), "status", F.unix_seconds("vehicle_ts").alias("vehicle_sec")),
    sql(f"SELECT {_COMMON.format(date=f'CASE WHEN direction_id = 0 THEN service_date ELSE {_HOUR_DATE} END')}, event_type AS status, CASE WHEN event_id % 7 <> 0 THEN cap END AS vehicle_sec FROM vp WHERE event_id % 11 <> 0", "vp"),
)
add(
    "updates_flattened",
    lambda s, d: _flat(observations.trip_update_rows(bridge.trip_update_snapshots(s, d)), F.unix_seconds("arrival_ts").alias("arrival_sec"), F.unix_seconds("departure_ts").alias("departure_sec"), "relationship"),
    sql(f"SELECT {_COMMON.format(date=_HOUR_DATE)}, CASE WHEN arr >= 1000000000 THEN arr END AS arrival_sec, CASE WHEN stop_sequence % 2 = 0 AND arr >= 1000000000 THEN arr END AS departure_sec, 'SCHEDULED' AS relationship FROM tu WHERE event_id % 5 <> 0", "tu"),
)


def _by_hour(df):
    return df.withColumn("captured_at", F.date_trunc("HOUR", "captured_at"))


add(
    "vehicles_deduplicated",
    lambda s, d: observations.one_of_each(_by_hour(bridge.vehicle_observations(s, d)), observations.VEHICLE_KEY, [F.col("event_id")]).select(F.unix_seconds("captured_at").alias("captured_sec"), "trip_id", "event_id"),
    sql("SELECT (cap // 3600) * 3600 AS captured_sec, trip_id, min(event_id) AS event_id FROM vp GROUP BY 1, 2", "vp"),
)
add(
    "updates_deduplicated",
    lambda s, d: observations.one_of_each(_by_hour(bridge.trip_update_observations(s, d)), observations.TRIP_UPDATE_KEY, [F.col("event_id")]).select(F.unix_seconds("captured_at").alias("captured_sec"), "trip_id", F.col("stop_sequence").cast("int").alias("stop_sequence"), "event_id"),
    sql("SELECT (cap // 3600) * 3600 AS captured_sec, trip_id, stop_sequence::INT AS stop_sequence, min(event_id) AS event_id FROM tu GROUP BY 1, 2, 3", "tu"),
)
_FROM, _TO = 1704412800, 1704672000  # 2024-01-05 to 2024-01-08, UTC
add(
    "observations_in_window",
    lambda s, d: observations.in_window(bridge.vehicle_observations(s, d), F.timestamp_seconds(F.lit(_FROM)), F.timestamp_seconds(F.lit(_TO))).select("event_id", "trip_id", "service_date"),
    sql("SELECT event_id, trip_id, service_date FROM vp WHERE captured_at >= TIMESTAMP '2024-01-05' AND captured_at < TIMESTAMP '2024-01-08'", "vp"),
)
add(
    "window_ids",
    lambda s, d: bridge.vehicle_observations(s, d).groupBy("service_date").agg(F.min("captured_at").alias("a"), F.max("captured_at").alias("b")).select("service_date", X.window_id(F.col("a"), F.col("b")).alias("window_id")),
    sql("SELECT service_date, strftime(min(captured_at), '%Y%m%dT%H') || '-' || strftime(max(captured_at), '%Y%m%dT%H') AS window_id FROM vp GROUP BY 1", "vp"),
)


def _captures(s, d):
    both = bridge.vehicle_observations(s, d).select(F.lit("vehicles").alias("feed"), "captured_at").unionByName(bridge.trip_update_observations(s, d).select(F.lit("updates").alias("feed"), "captured_at"))
    return both


def _minutes(s, d):
    """Captures by quarter of an hour, which gives the feeds a cadence."""
    return _captures(s, d).select("feed", F.timestamp_seconds(F.floor(F.unix_seconds("captured_at") / 900) * 900).alias("captured_at")).distinct()


_CAPS = "caps AS (SELECT 'vehicles' AS feed, cap FROM vp UNION ALL SELECT 'updates', cap FROM tu), mins AS (SELECT DISTINCT feed, (cap // 900) * 900 AS m FROM caps)"


def _with(extra: str, select: str, *parts: str) -> str:
    return sql("", *parts).rstrip() + ",\n" + extra + "\n" + select


_CADENCE = (
    "gaps AS (SELECT feed, m, m - lag(m) OVER (PARTITION BY feed ORDER BY m) AS gap FROM mins), cad AS (SELECT feed, gap AS interval_seconds "
    "FROM (SELECT feed, gap, count(*) AS n, min(m) AS f FROM gaps WHERE gap > 0 GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY feed "
    "ORDER BY n DESC, f) = 1)"
)
add("cadence", lambda s, d: observations.modal_interval(_minutes(s, d)), _with(f"{_CAPS}, {_CADENCE}", "SELECT * FROM cad", "vp", "tu"))
add(
    "earliest_hour",
    lambda s, d: observations.earliest(_captures(s, d)).select(F.unix_seconds("earliest_hour").alias("earliest_sec")),
    sql("SELECT (min(cap) // 3600) * 3600 AS earliest_sec FROM obs", "obs"),
)


def hours(s, d):
    spine = observations.hour_spine(s, F.timestamp_seconds(F.lit(1704067200)), F.timestamp_seconds(F.lit(1706832000)))  # 2024-01-01 to 2024-02-02
    every = spine.join(F.broadcast(s.range(2).select(F.when(F.col("id") == 0, "vehicles").otherwise("updates").alias("feed"))))
    counts = observations.counts_by_hour(_minutes(s, d), every, by=["feed"])
    return quality.hour_status(counts, observations.modal_interval(_minutes(s, d)), F.timestamp_seconds(F.lit(1706788800)), DEFAULT)  # 2024-02-01 12:00


_HOURS = f"""{_CAPS}, {_CADENCE}, spine AS (SELECT feed, h AS hour FROM (SELECT unnest(range(1704067200, 1706832000, 3600)) AS h), (SELECT unnest(['vehicles', 'updates']) AS feed)),
  cnt AS (SELECT s.feed, s.hour, count(m.m) AS n FROM spine s LEFT JOIN mins m ON m.feed = s.feed AND m.m >= s.hour AND m.m < s.hour + 3600 GROUP BY 1, 2),
  hrs AS (SELECT cnt.feed, hour, n, greatest(1, round_even(3600.0 / interval_seconds, 0)::INT) AS expected FROM cnt LEFT JOIN cad USING (feed)),
  st AS (SELECT *, CASE WHEN hour + 3600 > 1706788800 THEN 'pending' WHEN n = 0 THEN 'empty' WHEN n < expected * 0.9 THEN 'short' ELSE 'complete' END AS status FROM hrs)"""
add(
    "hour_status",
    lambda s, d: hours(s, d).select("feed", F.unix_seconds("hour").alias("hour_sec"), F.col("n").cast("long").alias("n"), F.col("expected").cast("int").alias("expected"), "status"),
    _with(_HOURS, "SELECT feed, hour AS hour_sec, n, expected, status FROM st", "vp", "tu"),
)
_COVER = """cov AS (SELECT feed, count(*) AS hours, count_if(status = 'complete')::BIGINT AS complete_hours, count_if(status = 'short')::BIGINT AS short_hours, count_if(status = 'empty')::BIGINT AS empty_hours, count_if(status = 'pending')::BIGINT AS pending_hours, max(expected)::BIGINT AS expected_per_hour,
  coalesce(sum(n) FILTER (WHERE status = 'short'), 0) AS sh FROM st GROUP BY 1)"""
add(
    "snapshot_coverage",
    lambda s, d: quality.coverage(hours(s, d)),
    _with(
        f"{_HOURS}, {_COVER}",
        "SELECT * EXCLUDE (sh), greatest((hours - pending_hours) * expected_per_hour - sh - complete_hours * expected_per_hour, 0)::BIGINT AS missing_snapshots FROM cov",
        "vp",
        "tu",
    ),
)
add(
    "first_empty_hours",
    lambda s, d: quality.first_hours(hours(s, d), "empty").select("feed", F.unix_seconds("hour").alias("hour_sec")),
    _with(_HOURS, "SELECT feed, hour AS hour_sec FROM st WHERE status = 'empty' ORDER BY feed, hour LIMIT 10", "vp", "tu"),
)
add(
    "hour_shortfall",
    lambda s, d: explore.hour_shortfall(hours(s, d)).select("feed", F.unix_seconds("hour").alias("hour_sec"), F.col("n").cast("long").alias("n"), "status", "shortfall"),
    _with(_HOURS, "SELECT feed, hour AS hour_sec, n, status, greatest(expected::BIGINT - n, 0)::BIGINT AS shortfall FROM st", "vp", "tu"),
)
add(
    "decode_summary",
    lambda s, d: observations.decode_summary(_minutes(s, d).withColumn("service_date", F.date_format(X.local_time(F.col("captured_at"), S.zone), "yyyy-MM-dd"))),
    _with(f"{_CAPS}, {_CADENCE}", "SELECT mins.feed, count(*) AS n_rows, count(DISTINCT m) AS snapshots, count(DISTINCT m // 3600) AS hours, count(DISTINCT (m - 18000) // 86400) AS service_dates, any_value(interval_seconds) AS interval_seconds FROM mins JOIN cad USING (feed) GROUP BY 1", "vp", "tu"),
)
add(
    "blocking_issues",
    lambda s, d: quality.blocking_issues(schedule.match_report(bridge.realtime_ids(s, d), bridge.trips(s, d).where(F.col("direction_id") == 0), S), quality.segment_quality(built(s, d), S), quality.coverage(hours(s, d)), S),
    _with(f"""{_HOURS}, {_COVER}, q AS (SELECT (count_if(dur < 0) + count_if(dur > 2592000) + count_if(sdur > 0 AND dur > sdur * 400)) / count(*)::DOUBLE AS v FROM segs), m AS (SELECT count_if(route_id <> 'NR' AND base::INT % 2 = 0 AND base IN (SELECT c_custkey::VARCHAR FROM customer)) / count_if(route_id <> 'NR')::DOUBLE AS v FROM rt)""",
      "SELECT 'low_match_rate' AS issue, '' AS about, round(v, 6) AS value FROM m WHERE v < 0.95 UNION ALL SELECT 'implausible_segments', '', round(v, 6) FROM q WHERE v > 0.05 UNION ALL SELECT 'empty_hours', feed, empty_hours::DOUBLE FROM cov WHERE empty_hours > 0", "vp", "tu", "segs", "rt"),
)
add(
    "longest_gaps",
    lambda s, d: explore.longest_gaps(_minutes(s, d)).select("feed", F.unix_seconds("captured_at").alias("captured_sec"), "gap", "rank"),
    _with(
        f"{_CAPS}, {_CADENCE}",
        (
            "SELECT feed, m AS captured_sec, gap, (row_number() OVER (PARTITION BY feed ORDER BY gap DESC, m))::INT AS rank FROM gaps WHERE gap IS NOT NULL "
            "QUALIFY row_number() OVER (PARTITION BY feed ORDER BY gap DESC, m) <= 10"
        ),
        "vp",
        "tu",
    ),
)

# --- what a feed holds ---------------------------------------------------------------------------------------------
_FIELDS = ["trip_id", "stop_sequence", "arrival_ts", "departure_ts"]
add("field_census", lambda s, d: explore.field_census(bridge.trip_update_observations(s, d), _FIELDS).select("field", "n_set", r("share", digits=6)), sql("""SELECT unnest(['trip_id', 'stop_sequence', 'arrival_ts', 'departure_ts']) AS field, unnest([count(trip_id), count(stop_sequence), count(arr), count(CASE WHEN stop_sequence % 2 = 0 THEN arr END)]) AS n_set,
  unnest([round(count(trip_id) / count(*)::DOUBLE, 6), round(count(stop_sequence) / count(*)::DOUBLE, 6), round(count(arr) / count(*)::DOUBLE, 6), round(count(CASE WHEN stop_sequence % 2 = 0 THEN arr END) / count(*)::DOUBLE, 6)]) AS share FROM tu""", "tu"))
add(
    "value_counts",
    lambda s, d: explore.value_counts(bridge.vehicle_observations(s, d), "status").select("value", "n", r("share", digits=6)),
    sql("SELECT event_type AS value, count(*) AS n, round(count(*) / (SELECT count(*) FROM vp)::DOUBLE, 6) AS share FROM vp GROUP BY 1", "vp"),
)
add(
    "top_stops",
    lambda s, d: explore.value_counts(bridge.vehicle_observations(s, d), "stop_id", 5).select("value", "n"),
    sql("SELECT stop_id AS value, count(*) AS n FROM vp GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5", "vp"),
)
add(
    "report_age",
    lambda s, d: explore.report_age(bridge.vehicle_observations(s, d).withColumn("vehicle_ts", F.timestamp_seconds(F.unix_seconds("captured_at") - F.col("event_id") % 97))).select("n", r("median"), r("p95"), "longest"),
    sql("SELECT count(*) AS n, round(quantile_cont(event_id % 97, 0.5)::DOUBLE, 4) AS median, round(quantile_cont(event_id % 97, 0.95)::DOUBLE, 4) AS p95, max(event_id % 97) AS longest FROM vp", "vp"),
)
add(
    "prediction_availability",
    lambda s, d: explore.prediction_availability(bridge.trip_update_observations(s, d)).withColumn("stop_sequence", F.col("stop_sequence").cast("int")),
    sql(
        (
            "SELECT stop_sequence::INT AS stop_sequence, count(*) AS n, count(arr) AS with_arrival, count_if(arr IS NOT NULL "
            "AND stop_sequence % 2 = 0)::BIGINT AS with_departure, count_if(arr IS NOT NULL AND stop_sequence % 2 = 0)::BIGINT AS with_both, "
            "count_if(arr IS NULL)::BIGINT AS with_neither FROM tu GROUP BY 1"
        ),
        "tu",
    ),
)
add(
    "prediction_drift",
    lambda s, d: (lambda tu: explore.prediction_drift(tu, arrivals.prediction_lifetimes(tu, TIE)))(bridge.trip_update_observations(s, d)).select("pairs", "settled", r("median_drift"), "most_observations"),
    _with("l AS (SELECT trip_id, stop_sequence, count(*) AS n, max(cap) AS last, arg_max(arr, (captured_at, event_id)) - arg_min(arr, (captured_at, event_id)) AS drift FROM tuh GROUP BY 1, 2), e AS (SELECT max(cap) AS e FROM tu)", "SELECT count(*) AS pairs, count_if(last < e - 120)::BIGINT AS settled, round(quantile_cont(CASE WHEN last < e - 120 THEN drift END, 0.5)::DOUBLE, 4) AS median_drift, max(n) AS most_observations FROM l, e", "tuh"),
)

# --- service dates -------------------------------------------------------------------------------------------------
_LOCAL = "(timezone('UTC', timezone('America/New_York', {d}::TIMESTAMP + INTERVAL 12 HOUR))) - INTERVAL 12 HOUR"
add(
    "service_day_bounds",
    lambda s, d: dates.with_bounds(s.read.parquet(f"{d}/orders.parquet").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("service_date")).distinct()),
    f"SELECT strftime(d, '%Y-%m-%d') AS service_date, epoch({_LOCAL.format(d='d')})::BIGINT AS day_start, epoch({_LOCAL.format(d='(d + INTERVAL 1 DAY)')})::BIGINT + 14400 AS day_end FROM (SELECT DISTINCT o_orderdate::DATE AS d FROM orders)",
)
add(
    "dates_covered",
    lambda s, d: dates.fully_covered(s.read.parquet(f"{d}/orders.parquet").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("service_date")).distinct(), F.lit(828_000_000), F.lit(860_000_000)).select("service_date"),
    f"SELECT strftime(d, '%Y-%m-%d') AS service_date FROM (SELECT DISTINCT o_orderdate::DATE AS d FROM orders) WHERE epoch({_LOCAL.format(d='d')})::BIGINT >= 828000000 AND epoch({_LOCAL.format(d='(d + INTERVAL 1 DAY)')})::BIGINT + 14400 <= 860000000",
)


def _outstanding(s, d):
    import dataclasses

    wide = dataclasses.replace(DEFAULT, lookback_days=3000)
    return dates.outstanding(s, bridge.archive_dates(s, d), F.timestamp_seconds(F.lit(996_667_200)), F.timestamp_seconds(F.lit(800_000_000)), wide)  # 2001-08-01 12:00 UTC


add(
    "dates_outstanding",
    _outstanding,
    f"""WITH spine AS (SELECT unnest(range(DATE '2001-08-01' - 3000, DATE '2001-08-02', INTERVAL 1 DAY)) AS d) SELECT strftime(d, '%Y-%m-%d') AS service_date FROM spine
      WHERE epoch({_LOCAL.format(d='(d + INTERVAL 1 DAY)')})::BIGINT + 14400 <= 996667200 AND epoch({_LOCAL.format(d='d')})::BIGINT >= 800000000 AND strftime(d, '%Y-%m-%d') NOT IN (SELECT strftime(o_orderdate, '%Y-%m-%d') FROM orders WHERE day(o_orderdate) % 5 <> 0)""",
)
add(
    "dates_prunable",
    lambda s, d: dates.prunable(bridge.archive_dates(s, d), F.timestamp_seconds(F.lit(915_192_000))),  # 1999-01-01 12:00 UTC
    "SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d') AS service_date FROM orders WHERE day(o_orderdate) % 5 <> 0 AND o_orderdate::DATE < DATE '1998-12-25'",
)
add(
    "dates_skipped",
    lambda s, d: dates.skipped(bridge.archive_dates(s, d), bridge.archive_dates(s, d).where("service_date < '1997'")),
    "SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d') AS service_date FROM orders WHERE day(o_orderdate) % 5 <> 0 AND o_orderdate >= TIMESTAMP '1997-01-01'",
)
add("dates_completed", lambda s, d: tables.completed_dates(bridge.archive_dates(s, d)), "SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d') AS service_date FROM orders WHERE day(o_orderdate) % 5 <> 0")

# --- archives ------------------------------------------------------------------------------------------------------
add(
    "archive_layout",
    lambda s, d: _captures(s, d).groupBy(tables.archive_path(F.col("feed"), F.col("captured_at")).alias("path")).agg(F.count("*").alias("n")),
    _with(_CAPS, "SELECT feed || strftime(make_timestamp(cap * 1000000), '/year=%Y/month=%m/day=%d/hour=%H') AS path, count(*) AS n FROM caps GROUP BY 1", "vp", "tu"),
)
add(
    "content_addressed",
    lambda s, d: tables.content_addressed(s.read.parquet(f"{d}/documents.parquet").select(F.col("lang").alias("mode"), F.col("text").alias("content"))).select("mode", "sha256"),
    "SELECT DISTINCT lang AS mode, sha256(text) AS sha256 FROM documents WHERE text IS NOT NULL",
)


def _members(s, d):
    """Bundles with members by a rule: every seventh lacks one, every fifth has no start."""
    b = bridge.bundles(s, d)
    n = F.datediff(F.to_date("feed_start"), F.lit("1970-01-01").cast("date"))
    names = F.filter(F.array(*map(F.lit, tables.REQUIRED_MEMBERS)), lambda m: (n % 7 != 0) | (m != "stops.txt"))
    info = b.select(F.col("feed_start").alias("bundle"), F.when(n % 5 == 0, "").otherwise(F.col("feed_start")).alias("feed_start_date"), F.when(F.col("feed_end") == "unknown", "").otherwise(F.col("feed_end")).alias("feed_end_date"), F.when(n % 3 == 0, "").otherwise(F.col("version")).alias("feed_version"))
    return tables.bundle_problems(b.select(F.col("feed_start").alias("bundle"), F.explode(names).alias("member")), info).withColumn("missing", F.array_join("missing", ","))


add("bundle_validity", _members, sql("""SELECT feed_start AS bundle, CASE WHEN n % 7 = 0 THEN 'stops.txt' ELSE '' END AS missing, CASE WHEN n % 5 <> 0 THEN feed_start END AS feed_start, feed_end, CASE WHEN n % 3 <> 0 THEN version END AS version, n % 7 <> 0 AND n % 5 <> 0 AS valid
  FROM (SELECT *, datediff('day', DATE '1970-01-01', feed_start::DATE) AS n FROM bund)""", "bund"))
add(
    "capture_times_from_names",
    lambda s, d: bridge.vehicle_observations(s, d).select("event_id", F.concat(F.lit("raw/vehicles-"), F.unix_seconds("captured_at").cast("string"), F.when(F.col("event_id") % 9 == 0, F.lit(".tmp")).otherwise(F.lit(".pb.gz"))).alias("path")).select("event_id", F.unix_seconds(observations.captured_at_of(F.col("path"))).alias("captured_sec")),
    sql("SELECT event_id, CASE WHEN event_id % 9 <> 0 THEN cap END AS captured_sec FROM vp", "vp"),
)
