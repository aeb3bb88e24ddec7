"""Queries over the events as a stream: each drains what is there into a table of files and reads that."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramloom.queries.base import S, kept, r
from tramloom.queries.sql import Query, sql
from tramloom.sources import bridge, tables
from tramloom.streaming import feeds

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def add(name: str, run: Query, text: str | None = None) -> None:
    QUERIES[name] = run
    if text is not None:
        SQL[name] = text


def drained(stream: DataFrame) -> DataFrame:
    """All that the stream puts out for the rows that are there now."""
    spark = stream.sparkSession
    path = f"{tables.shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    query = stream.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/state").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/out")


# A watermark follows the latest capture by 4 hours; what it has not passed is still open.
_PASSED = "(SELECT max(captured_at) FROM vp) - INTERVAL 4 HOUR"
add(
    "stream_deduplicated",
    lambda s, d: drained(feeds.deduplicated(bridge.vehicle_stream(s, d), ("captured_at", "trip_id"))).select("trip_id", F.unix_seconds("captured_at").alias("captured_sec")),
    sql("SELECT trip_id, cap AS captured_sec FROM (SELECT DISTINCT trip_id, captured_at, cap FROM vp)", "vp"),
)
add(
    "stream_closed_hours",
    lambda s, d: drained(feeds.hourly_counts(bridge.vehicle_stream(s, d))).select(F.unix_seconds("hour").alias("hour_sec"), "n"),
    sql(f"SELECT (cap // 3600) * 3600 AS hour_sec, count(*) AS n FROM vp GROUP BY 1 HAVING make_timestamp((hour_sec + 3600) * 1000000) <= {_PASSED}", "vp"),
)
add(
    "stream_closed_dates",
    lambda s, d: drained(feeds.service_date_counts(bridge.vehicle_stream(s, d), S)).select("service_date", "n"),
    sql("SELECT service_date, count(*) AS n FROM vp GROUP BY 1 HAVING service_date::DATE <= (SELECT max(service_date)::DATE FROM vp) - 2", "vp"),
)


def _arrived(s, d):
    found = drained(feeds.observed_arrivals(bridge.vehicle_stream(s, d), S))
    return found.select("trip_id", "stop_sequence", "trip_run", F.unix_seconds("actual_arrival_ts").alias("arrival_sec"), "arrival_bracket_sec", "sequence_jump", "arrival_confident")


add(
    "stream_arrivals",
    _arrived,
    sql(
        f"""SELECT trip_id, stop_sequence, (sum(anew) OVER (PARTITION BY trip_id ORDER BY captured_at, stop_sequence ROWS UNBOUNDED PRECEDING))::INT AS trip_run, arr AS arrival_sec, bracket AS arrival_bracket_sec, jump AS sequence_jump, confident AS arrival_confident
      FROM (SELECT *, CASE WHEN stop_sequence <= lag(stop_sequence) OVER (PARTITION BY trip_id ORDER BY captured_at, stop_sequence) THEN 1 ELSE 0 END AS anew FROM vpa WHERE captured_at <= {_PASSED})""",
        "vpa",
    ),
)


def _conditions(s, d):
    """Completions in eight files, of which a batch reads one; of a segment's rows the last in force."""
    done = kept(s, d).where("actual_arrival_ts is not null").select("from_stop_id", "to_stop_id", "actual_arrival_ts", "actual_duration_sec", "delay_sec")
    path = f"{tables.shared_folder(s)}/completions-{uuid.uuid4().hex}"
    done.repartition(8).write.parquet(path)
    stream = s.readStream.schema(done.schema).option("maxFilesPerTrigger", 1).parquet(path)
    found = drained(feeds.recent_conditions(stream, S, "20 years")).where("roll_n > 0")
    last = found.groupBy("from_stop_id", "to_stop_id").agg(F.max_by(F.struct(*[c for c in found.columns if c not in ("from_stop_id", "to_stop_id", "seen")]), "seen").alias("r"), F.max("seen").alias("seen"))
    return last.select("from_stop_id", "to_stop_id", "seen", F.unix_seconds("r.completed_at").alias("completed_sec"), *[r(F.col(f"r.{c}"), c) for c in ("roll_median", "roll_mean", "roll_delay_mean", "roll_deviation")], F.col("r.roll_n").alias("roll_n"))


add(
    "stream_conditions",
    _conditions,
    sql("", "fseg").rstrip() + """, o AS (SELECT *, row_number() OVER (PARTITION BY from_stop_id, to_stop_id ORDER BY arr, dur) AS place, count(*) OVER (PARTITION BY from_stop_id, to_stop_id) AS seen FROM fseg WHERE arr IS NOT NULL AND dur IS NOT NULL),
  n AS (SELECT a.*, (SELECT quantile_cont(b.dur, 0.5) FROM o b WHERE b.from_stop_id = a.from_stop_id AND b.to_stop_id = a.to_stop_id AND b.place < a.place) AS norm FROM o a WHERE a.place > a.seen - 5)
SELECT from_stop_id, to_stop_id, any_value(seen) AS seen, max(arr) AS completed_sec, round(quantile_cont(dur, 0.5)::DOUBLE, 4) AS roll_median, round(avg(dur), 4) AS roll_mean, round(avg(delay), 4) AS roll_delay_mean, round(avg(dur - norm)::DOUBLE, 4) AS roll_deviation, count(*)::INT AS roll_n
FROM n GROUP BY from_stop_id, to_stop_id""",
)
