"""Queries over stations, scheduled journeys between them, and requests."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tramloom.functions import exprs as X
from tramloom.operators import stations
from tramloom.queries.base import planned, r
from tramloom.queries.sql import Query, sql
from tramloom.sources import bridge, tables

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def add(name: str, run: Query, text: str | None = None) -> None:
    QUERIES[name] = run
    if text is not None:
        SQL[name] = text


add(
    "stations_by_code",
    lambda s, d: stations.station_codes(bridge.stops(s, d)).withColumn("platforms", F.array_join("platforms", ",")),
    sql("SELECT code, name, array_to_string(platforms, ',') AS platforms FROM stcodes", "stcodes"),
)
_PLAIN = "trim(regexp_replace(lower({c}), '[^a-z0-9]+', ' ', 'g'))"
add(
    "stations_by_name",
    lambda s, d: stations.station_index(bridge.stops(s, d)).select("station", F.array_join("codes", ",").alias("codes"), "name"),
    sql(f"SELECT {_PLAIN.format(c='name')} AS station, array_to_string(list_sort(list(code)), ',') AS codes, min(name) AS name FROM stcodes GROUP BY 1", "stcodes"),
)
add(
    "od_schedule",
    lambda s, d: stations.od_schedule(planned(s, d)).withColumn("direction_id", F.col("direction_id").cast("int")),
    sql("", "odp").rstrip()
    + """, m AS (SELECT origin, destination, hour, sec, legs, route_id, direction_id, leg FROM odp UNION ALL SELECT origin, destination, -1, sec, legs, route_id, direction_id, leg FROM odp),
  ro AS (SELECT origin, destination, hour, route_id FROM m GROUP BY 1, 2, 3, 4 QUALIFY row_number() OVER (PARTITION BY origin, destination, hour ORDER BY count(*) DESC, route_id) = 1),
  di AS (SELECT origin, destination, hour, direction_id FROM m GROUP BY 1, 2, 3, 4 QUALIFY row_number() OVER (PARTITION BY origin, destination, hour ORDER BY count(*) DESC, direction_id) = 1)
SELECT m.origin, m.destination, m.hour, round_even(quantile_cont(sec, 0.5)::DOUBLE, 0)::BIGINT AS sched_sec, any_value(legs) AS n_segments, any_value(legs) AS stop_span, count(*) AS trips, any_value(ro.route_id) AS route_id, any_value(di.direction_id) AS direction_id, any_value(leg) AS first_leg_to
FROM m JOIN ro USING (origin, destination, hour) JOIN di USING (origin, destination, hour) GROUP BY 1, 2, 3""",
)


def _codes(s, d):
    """Names for the platforms that the timetable uses: one for each pair of stops, so that some requests are ambiguous."""
    stop = planned(s, d).select("stop_id").distinct()
    n = F.substring("stop_id", 6, 1).cast("int")
    return stop.select(X.station_code(F.col("stop_id")).alias("code"), F.concat(F.lit("Stop "), F.floor(F.when(n < 6, n * 2).otherwise(n) / 2).cast("string")).alias("name"), F.array("stop_id").alias("platforms"))


def _requests(s, d):
    key = F.col("c_custkey")
    rows = s.read.parquet(f"{d}/customer.parquet")
    return rows.select(key.alias("request_id"), F.concat(F.lit("STOP  "), (key % 7).cast("string")).alias("origin"), F.concat(F.lit("stop-"), (F.floor(key / 7) % 7).cast("string")).alias("destination"), (key % 24).cast("int").alias("hour"))


add(
    "requests_resolved",
    lambda s, d: stations.resolve_requests(_requests(s, d), _codes(s, d), stations.od_schedule(planned(s, d))).select("request_id", "status", "origin", "destination", F.col("hour").cast("int").alias("hour"), "sched_sec", "trips"),
    sql("", "odp").rstrip()
    + """, nm AS (SELECT DISTINCT stop_id, 'stop ' || (CASE WHEN seq < 6 THEN seq ELSE seq // 2 END) AS st FROM sched),
  q AS (SELECT c_custkey AS request_id, 'stop ' || (c_custkey % 7) AS o, 'stop ' || ((c_custkey // 7) % 7) AS t, (c_custkey % 24)::INT AS h FROM customer),
  m AS (SELECT origin, destination, hour, sec FROM odp UNION ALL SELECT origin, destination, -1, sec FROM odp),
  od AS (SELECT origin, destination, hour, round_even(quantile_cont(sec, 0.5)::DOUBLE, 0)::BIGINT AS sched_sec, count(*) AS trips FROM m GROUP BY 1, 2, 3),
  c AS (SELECT request_id, od.* FROM q JOIN nm a ON a.st = o JOIN nm b ON b.st = t JOIN od ON od.origin = a.stop_id AND od.destination = b.stop_id AND (hour = h OR hour = -1)),
  n AS (SELECT request_id, count(DISTINCT origin || '|' || destination) AS pairs FROM c GROUP BY 1),
  one AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY request_id ORDER BY hour DESC, origin DESC, destination DESC) = 1),
  st AS (SELECT q.request_id, CASE WHEN o NOT IN (SELECT st FROM nm) OR t NOT IN (SELECT st FROM nm) THEN 'unknown_station' WHEN pairs IS NULL THEN 'not_connected' WHEN pairs > 1 THEN 'ambiguous' ELSE 'ok' END AS status FROM q LEFT JOIN n USING (request_id))
SELECT st.request_id, status, CASE WHEN status = 'ok' THEN origin END AS origin, CASE WHEN status = 'ok' THEN destination END AS destination, CASE WHEN status = 'ok' THEN hour END AS hour, CASE WHEN status = 'ok' THEN sched_sec END AS sched_sec, CASE WHEN status = 'ok' THEN trips END AS trips FROM st LEFT JOIN one USING (request_id)""",
)
add(
    "names_nearest",
    lambda s, d: stations.nearest_names(s.read.parquet(f"{d}/nation.parquet").select(F.concat("n_name", F.lit("x")).alias("name")), stations.station_index(bridge.stops(s, d))).select("asked", "station", r("likeness", digits=6), "rank"),
    sql("", "stcodes").rstrip()
    + f""", k AS (SELECT DISTINCT {_PLAIN.format(c='name')} AS station FROM stcodes), a AS (SELECT DISTINCT {_PLAIN.format(c="n_name || 'x'")} AS asked FROM nation),
  p AS (SELECT asked, station, round(1 - levenshtein(asked, station) / greatest(length(asked), length(station), 1)::DOUBLE, 6) AS likeness FROM a, k)
SELECT *, (row_number() OVER (PARTITION BY asked ORDER BY likeness DESC, station))::INT AS rank FROM p QUALIFY row_number() OVER (PARTITION BY asked ORDER BY likeness DESC, station) <= 3""",
)
add(
    "id_versions",
    lambda s, d: bridge.realtime_ids(s, d).select("trip_id").distinct().select("trip_id", X.versionless(F.col("trip_id")).alias("base"), X.version_of(F.col("trip_id")).alias("version")),
    sql("SELECT DISTINCT trip_id, base, '20660' AS version FROM rt", "rt"),
)
add(
    "readable_durations",
    lambda s, d: bridge.table(s, d, "orders").select("o_orderkey", X.readable_duration(F.col("o_orderkey") * 37 % 9000).alias("text")),
    "SELECT o_orderkey, CASE WHEN x < 60 THEN x || 's' WHEN x < 3600 THEN (x // 60) || 'm' || lpad((x % 60)::VARCHAR, 2, '0') || 's' ELSE (x // 3600) || 'h' || lpad(((x % 3600) // 60)::VARCHAR, 2, '0') || 'm' END AS text FROM (SELECT o_orderkey, (o_orderkey * 37 % 9000)::BIGINT AS x FROM orders)",
)


def _static(s, d):
    """Stops through a member of a static bundle: quotes and commas in names, and nulls, which the format has not."""
    path = f"{tables.shared_folder(s)}/stops-{uuid.uuid4().hex}"
    odd = F.when(F.col("stop_id").endswith("1"), F.lit(None)).otherwise(F.concat("stop_name", F.lit(', "the" stop')))
    bridge.stops(s, d).select("stop_id", odd.alias("stop_name"), "parent_station").coalesce(1).write.option("header", True).option("escape", '"').csv(path)
    return tables.read_static_table(s, path).groupBy("stop_name", "parent_station").agg(F.count("*").alias("n"), F.min("stop_id").alias("first"))


add(
    "static_table_read",
    _static,
    sql("SELECT CASE WHEN stop_id LIKE '%1' THEN '' ELSE coalesce(stop_name || ', \"the\" stop', '') END AS stop_name, coalesce(parent_station, '') AS parent_station, count(*) AS n, min(stop_id) AS first FROM stops GROUP BY 1, 2", "stops"),
)
