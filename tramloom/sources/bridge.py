"""Transit-shaped views over the general test tables (events, customer, supplier, orders ...)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramloom.config import DEFAULT
from tramloom.functions import exprs as X

VEHICLE_EVENTS, UPDATE_EVENTS = ("view", "click", "purchase"), ("signup", "error")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame, *keys: str) -> DataFrame:
    """rows dealt to as many tasks as shuffles have: a small file is one task, however many rows each of its rows becomes."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def _observed(events: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    sequence = (F.col("k").cast("int") % 10).cast("int")
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts"))
    # a generator, so that a filter on k, which is pushed below columns, does not parse the text again
    rows = events.where(F.col("event_type").isin(*kinds)).select("*", F.json_tuple("props", "k").alias("k")).withColumn("captured_at", F.timestamp_micros(micros))
    zone = DEFAULT.zone
    return rows.select(
        "event_id", "captured_at", F.date_format(X.local_time(F.col("captured_at"), zone), "yyyy-MM-dd").alias("service_date"), F.col("user_id").cast("string").alias("trip_id"), F.col("user_id").cast("string").alias("scheduled_trip_id"),
        F.lit("20660").alias("schedule_version"), F.concat(F.lit("R"), (F.col("user_id") % 6).cast("string")).alias("route_id"), (F.col("user_id") % 2).cast("int").alias("direction_id"), F.concat(F.lit("V"), F.col("user_id").cast("string")).alias("vehicle_id"),
        F.concat(F.lit("PF_A0"), sequence.cast("string"), F.lit("_C")).alias("stop_id"), sequence.alias("stop_sequence"), "event_type", "value",
    )


def vehicle_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _observed(table(spark, sf_dir, "events"), VEHICLE_EVENTS)
    return rows.withColumn("status", F.col("event_type")).drop("event_type", "value")


def vehicle_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vehicle observations as a stream of their files."""
    events = spark.readStream.schema(table(spark, sf_dir, "events").schema).parquet(f"{sf_dir}/event[s].parquet")  # a pattern, since the table may be one file
    return _observed(events, VEHICLE_EVENTS).withColumn("status", F.col("event_type")).drop("event_type", "value")


def trip_update_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _observed(table(spark, sf_dir, "events"), UPDATE_EVENTS)
    shift = (F.floor("value").cast("int") - 40) * 600
    return rows.withColumn("arrival_ts", F.timestamp_seconds(F.unix_seconds("captured_at") + shift)).withColumn("departure_ts", F.when(F.col("stop_sequence") % 2 == 0, F.col("arrival_ts"))).withColumn("relationship", F.col("event_type")).drop("event_type", "value")


def vehicle_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested: the vehicles of one hour as the entities of one snapshot; odd trips lack a start date, some have no trip."""
    rows = vehicle_observations(spark, sf_dir)
    entity = F.struct(
        F.when(F.col("event_id") % 11 != 0, F.concat("trip_id", F.lit("_20660"))).alias("trip_id"), "route_id", "direction_id", F.when(F.col("direction_id") == 0, F.regexp_replace("service_date", "-", "")).alias("start_date"),
        "vehicle_id", "stop_id", "stop_sequence", "status", F.when(F.col("event_id") % 7 == 0, F.lit(0)).otherwise(F.unix_seconds("captured_at")).cast("long").alias("vehicle_epoch"), "event_id",
    )
    return rows.groupBy(F.date_trunc("HOUR", "captured_at").alias("captured_at")).agg(F.collect_list(entity).alias("entities"))


def trip_update_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested in two levels: entities of one hour, each with the stops predicted for its trip."""
    rows = trip_update_observations(spark, sf_dir).withColumn("hour", F.date_trunc("HOUR", "captured_at"))
    stop = F.struct("stop_sequence", "stop_id", F.when(F.col("event_id") % 5 == 0, F.lit("SKIPPED")).otherwise(F.lit("SCHEDULED")).alias("relationship"), F.unix_seconds("arrival_ts").alias("arrival_epoch"), F.when(F.col("stop_sequence") % 2 == 0, F.unix_seconds("departure_ts")).otherwise(F.lit(0)).cast("long").alias("departure_epoch"))
    trips = rows.groupBy("hour", "trip_id", "route_id", "direction_id", "vehicle_id").agg(F.collect_list(stop).alias("stops"))
    entity = F.struct(F.concat("trip_id", F.lit("_20660")).alias("trip_id"), "route_id", "direction_id", F.lit(None).cast("string").alias("start_date"), "vehicle_id", "stops")
    return trips.groupBy(F.col("hour").alias("captured_at")).agg(F.collect_list(entity).alias("entities"))


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(F.concat(c.cast("string"), F.lit("_20670")).alias("trip_id"), F.concat(F.lit("R"), (c % 6).cast("string")).alias("route_id"), (c % 2).cast("int").alias("direction_id"))


def stop_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, q = F.col("c_custkey"), F.col("q")
    offset = (c % 24) * 3600 + q * 2400
    two = lambda x: F.lpad(x.cast("int").cast("string"), 2, "0")
    clock = F.concat_ws(":", two(F.floor(offset / 3600)), two(F.floor(offset % 3600 / 60)), two(offset % 60))
    named = table(spark, sf_dir, "customer").select("c_custkey", F.concat(c.cast("string"), F.lit("_20670")).alias("trip_id"))
    rows = spread(named, "trip_id").select("c_custkey", "trip_id", F.explode(F.sequence(F.lit(0), F.lit(9))).alias("q"))  # by what stop times are joined by
    return rows.select("trip_id", q.alias("stop_sequence"), clock.alias("arrival_time"), clock.alias("departure_time"), F.concat(F.lit("PF_A0"), q.cast("string"), F.lit("_C")).alias("stop_id"))


def realtime_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trip updates by versioned id; some routes carry no passengers."""
    rows = trip_update_observations(spark, sf_dir)
    number = F.col("trip_id").cast("long")
    return rows.select("captured_at", F.concat("trip_id", F.lit("_20660")).alias("trip_id"), F.when(number % 17 == 0, F.lit("NR")).otherwise(F.col("route_id")).alias("route_id"), "stop_id")


def stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Platforms and their stations: stop_id, stop_name, parent_station."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    rows = table(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    key = F.col("n_nationkey")
    code = F.concat(F.chr(F.lit(65) + key % 8), F.lpad(key.cast("string"), 2, "0"))
    rows = rows.select(code.alias("code"), "s_suppkey", F.when(key % 5 == 0, F.col("r_name")).otherwise(F.col("n_name")).alias("name"))
    station = rows.select(F.concat(F.lit("STN_"), "code").alias("stop_id"), F.col("name").alias("stop_name")).distinct().withColumn("parent_station", F.lit(""))
    platform = rows.select(F.concat(F.lit("PF_"), "code", F.lit("_"), F.col("s_suppkey").cast("string")).alias("stop_id"), F.lit("Platform").alias("stop_name"), F.concat(F.lit("STN_"), "code").alias("parent_station"))
    return station.unionByName(platform)


def bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validity windows: each quarter that orders begin in, 100 days long, every fifth of them open."""
    starts = table(spark, sf_dir, "orders").select(F.to_date(F.date_trunc("quarter", F.col("o_orderdate").cast("timestamp"))).alias("start")).distinct()
    number = F.datediff("start", F.lit("1970-01-01").cast("date"))
    end = F.when(F.quarter("start") % 4 == 1, F.lit("unknown")).otherwise(F.date_format(F.date_add("start", 100), "yyyy-MM-dd"))
    return starts.select(F.date_format("start", "yyyy-MM-dd").alias("feed_start"), end.alias("feed_end"), (number % 1000).cast("string").alias("version"))


def archive_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Service dates that count as done."""
    date = F.to_date("o_orderdate")
    return table(spark, sf_dir, "orders").select(date.alias("d")).distinct().where(F.dayofmonth("d") % 5 != 0).select(F.date_format("d", "yyyy-MM-dd").alias("service_date"))
