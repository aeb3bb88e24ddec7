"""Snapshots of a feed as observations: flattening, windows, dedup, capture times, cadence and coverage of hours."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramloom.config import DEFAULT, Settings
from tramloom.functions import exprs as X

_COMMON = [("captured_at", T.TimestampType(), False), ("service_date", T.StringType(), False), ("trip_id", T.StringType(), False), ("scheduled_trip_id", T.StringType(), False), ("schedule_version", T.StringType(), True), ("route_id", T.StringType(), True), ("direction_id", T.IntegerType(), True), ("vehicle_id", T.StringType(), True), ("stop_id", T.StringType(), True), ("stop_sequence", T.IntegerType(), True)]
VEHICLE_SCHEMA = T.StructType([T.StructField(*f) for f in [*_COMMON, ("status", T.StringType(), True), ("vehicle_ts", T.TimestampType(), True)]])
TRIP_UPDATE_SCHEMA = T.StructType([T.StructField(*f) for f in [*_COMMON, ("arrival_ts", T.TimestampType(), True), ("departure_ts", T.TimestampType(), True), ("relationship", T.StringType(), True)]])


def _trip_columns(e: Column, settings: Settings) -> list[Column]:
    return [F.col("captured_at"), X.service_date_of(e["start_date"], F.col("captured_at"), settings.zone).alias("service_date"), e["trip_id"].alias("trip_id"), X.versionless(e["trip_id"]).alias("scheduled_trip_id"), X.version_of(e["trip_id"]).alias("schedule_version"), e["route_id"].alias("route_id"), e["direction_id"].cast("int").alias("direction_id"), e["vehicle_id"].alias("vehicle_id")]


def vehicle_rows(snapshots: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """(captured_at, entities) to one row per vehicle and snapshot; entities without a trip go."""
    e = F.col("e")
    rows = snapshots.select("captured_at", F.explode("entities").alias("e")).where(F.coalesce(e["trip_id"], F.lit("")) != "")
    return rows.select(*_trip_columns(e, settings), e["stop_id"].alias("stop_id"), e["stop_sequence"].cast("int").alias("stop_sequence"), e["status"].alias("status"), X.valid_epoch(e["vehicle_epoch"], settings.min_epoch).alias("vehicle_ts"))


def trip_update_rows(snapshots: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """(captured_at, entities with stops) to one row per stop prediction; skipped stops and entities without a trip go."""
    e, s = F.col("e"), F.col("s")
    rows = snapshots.select("captured_at", F.explode("entities").alias("e")).where(F.coalesce(e["trip_id"], F.lit("")) != "").select("captured_at", "e", F.explode("e.stops").alias("s")).where(~s["relationship"].eqNullSafe("SKIPPED"))
    stamp = lambda c: X.valid_epoch(s[c], settings.min_epoch)
    return rows.select(*_trip_columns(e, settings), s["stop_id"].alias("stop_id"), s["stop_sequence"].cast("int").alias("stop_sequence"), stamp("arrival_epoch").alias("arrival_ts"), stamp("departure_epoch").alias("departure_ts"), s["relationship"].alias("relationship"))


def read_observations(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """With the schema stated: a column that is all null in one file must not be taken for another type."""
    return spark.read.schema(schema).parquet(path)


def in_window(rows: DataFrame, start: Column, end: Column, column: str = "captured_at") -> DataFrame:
    """Half open: start is in, end is out."""
    return rows.where((F.col(column) >= start) & (F.col(column) < end))


def one_of_each(rows: DataFrame, keys: Sequence[str], prefer: Sequence[Column] = ()) -> DataFrame:
    """One row for each natural key. Without ``prefer``, duplicates are taken to be alike; with it the first by that order stays."""
    if not prefer:
        return rows.dropDuplicates(list(keys))
    first = Window.partitionBy(*keys).orderBy(*prefer)
    return rows.withColumn("__n", F.row_number().over(first)).where("__n = 1").drop("__n")


VEHICLE_KEY = ("captured_at", "trip_id")
TRIP_UPDATE_KEY = ("captured_at", "trip_id", "stop_sequence")


def captured_at_of(path: Column) -> Column:
    """Capture time from a snapshot's file name; a file's own time changes when it is copied."""
    return F.timestamp_seconds(F.nullif(F.regexp_extract(path, r"-(\d+)\.pb(?:\.gz)?$", 1), F.lit("")).cast("bigint"))


def hour_spine(spark: SparkSession, start: Column, end: Column) -> DataFrame:
    """hour of each hour partition that [start, end) touches."""
    hours = spark.range(1).select(F.explode(F.sequence(F.date_trunc("HOUR", start), end, F.expr("interval 1 hour"))).alias("hour"))
    return hours.where(F.col("hour") < end)


def counts_by_hour(captures: DataFrame, hours: DataFrame, column: str = "captured_at", by: Sequence[str] = ()) -> DataFrame:
    """hours (by and hour) with the count of captures, also where there are none."""
    keys = [*by, "hour"]
    counted = captures.groupBy(*by, F.date_trunc("HOUR", column).alias("hour")).agg(F.count("*").alias("n"))
    return hours.join(counted, keys, "left").select(*keys, F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def earliest(captures: DataFrame, column: str = "captured_at") -> DataFrame:
    return captures.agg(F.date_trunc("HOUR", F.min(column)).alias("earliest_hour"))


def modal_interval(captures: DataFrame, by: Sequence[str] = ("feed",), column: str = "captured_at") -> DataFrame:
    """The most frequent positive gap between successive captures of each feed; of equals the one seen first."""
    gap = F.unix_seconds(column) - F.unix_seconds(F.lag(column).over(Window.partitionBy(*by).orderBy(column)))
    gaps = captures.select(*by, column, gap.alias("gap")).where("gap > 0").groupBy(*by, "gap").agg(F.count("*").alias("n"), F.min(column).alias("first"))
    best = F.max_by(F.col("gap"), F.struct("n", -F.unix_micros("first")))
    return gaps.groupBy(*by).agg(best.alias("interval_seconds"))


def decode_summary(rows: DataFrame, by: Sequence[str] = ("feed",)) -> DataFrame:
    """Rows, snapshots, hours, service dates and cadence of each feed."""
    counted = rows.groupBy(*by).agg(F.count("*").alias("n_rows"), F.countDistinct("captured_at").alias("snapshots"), F.countDistinct(F.date_trunc("HOUR", "captured_at")).alias("hours"), F.countDistinct("service_date").alias("service_dates"))
    return counted.join(modal_interval(rows.select(*by, "captured_at").distinct(), by), list(by), "left")
