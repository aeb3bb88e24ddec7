"""Scalar expressions of the transit operators; all are built-in functions, without any UDF."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

HALF_DAY = 43_200


def epoch(ts: Column | str) -> Column:
    """Whole seconds since 1970 of a timestamp."""
    return F.unix_seconds(ts)


def instant(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


# Patterns of ids and clock times below are fixed formats of the feeds and of the public timetable format.

# --- ids and names -----------------------------------------------------------------------------------------------


def versionless(trip_id: Column) -> Column:
    """The trip id without its version suffix; the whole id if it has none."""
    base = F.regexp_extract(trip_id, r"^(.+)_([^_]+)$", 1)
    return F.when(base == "", trip_id).otherwise(base)


def version_of(trip_id: Column) -> Column:
    return F.nullif(F.regexp_extract(trip_id, r"^(.+)_([^_]+)$", 2), F.lit(""))


def iso_date(compact: Column) -> Column:
    """20260805 as 2026-08-05, null if empty."""
    return F.when(F.length(compact) == 8, F.concat_ws("-", F.substring(compact, 1, 4), F.substring(compact, 5, 2), F.substring(compact, 7, 2)))


def local_time(ts: Column, zone: str) -> Column:
    return F.from_utc_timestamp(ts, zone)


def service_date_of(compact: Column, captured_at: Column, zone: str) -> Column:
    """The stated service date, or else the local date of capture."""
    return F.coalesce(iso_date(compact), F.date_format(local_time(captured_at, zone), "yyyy-MM-dd"))


def station_code(stop_id: Column) -> Column:
    """The station code of a platform id; the id itself if it has none."""
    return F.coalesce(station_code_or_null(stop_id), stop_id)


def station_code_or_null(stop_id: Column) -> Column:
    return F.nullif(F.regexp_extract(stop_id, r"^PF_([A-Z]\d{2})", 1), F.lit(""))


def segment_id(start: Column, end: Column) -> Column:
    return F.concat_ws(">", start, end)


def plain_name(name: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(name), "[^a-z0-9]+", " "))


def version_label(start: Column, version: Column) -> Column:
    return F.concat_ws("/", start, F.coalesce(version, F.lit("unknown")))


def readable_duration(seconds: Column) -> Column:
    """45s, 3m12s, 1h04m."""
    s = F.floor(seconds)
    h, m = F.floor(s / 3600), F.floor(F.pmod(s, F.lit(3600)) / 60)
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    short = F.concat(s.cast("string"), F.lit("s"))
    middle = F.concat(m.cast("string"), F.lit("m"), two(F.pmod(s, F.lit(60))), F.lit("s"))
    return F.when(s < 60, short).when(s < 3600, middle).otherwise(F.concat(h.cast("string"), F.lit("h"), two(m), F.lit("m")))


# --- times -------------------------------------------------------------------------------------------------------


def clock_seconds(text: Column) -> Column:
    """Seconds of HH:MM:SS, where HH may exceed 23; null if it isn't one. One pattern is matched, as timetables are long."""
    clock = F.trim(text)
    h, m, s = (p.cast("int") for p in (F.substring_index(clock, ":", 1), F.substring(F.substring_index(clock, ":", 2), -2, 2), F.substring(F.substring_index(clock, ":", -1), 1, 2)))
    return F.when(F.regexp_like(clock, F.lit(r"^\d+:[0-5]\d:[0-5]\d$")), h * 3600 + m * 60 + s)


def service_day_start(date: Column, zone: str) -> Column:
    """Epoch seconds of local noon minus twelve hours, which holds on days when clocks change."""
    noon = F.to_timestamp_ntz(F.concat(date.cast("string"), F.lit(" 12:00:00")))
    return clock_epoch(F.convert_timezone(F.lit(zone), F.lit("UTC"), noon)) - HALF_DAY


def clock_epoch(utc: Column) -> Column:
    """Epoch seconds of a zoneless timestamp that shows UTC, whatever the session's zone."""
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), utc)


def service_day_end(date: Column, zone: str, overhang_hours: int) -> Column:
    return service_day_start(F.date_add(date.cast("date"), 1), zone) + overhang_hours * 3600


def valid_epoch(seconds: Column, least: int) -> Column:
    """An instant, or null where a feed's zero or other sentinel stands."""
    return F.when(seconds >= least, F.timestamp_seconds(seconds))


def midpoint(a: Column, b: Column) -> Column:
    """The middle of two instants, down to whole seconds."""
    return F.timestamp_seconds(F.floor((F.unix_seconds(a) + F.unix_seconds(b)) / 2))


def window_id(start: Column, end: Column) -> Column:
    form = "yyyyMMdd'T'HH"
    return F.concat_ws("-", F.date_format(start, form), F.date_format(end, form))


def hour_bucket(offset: Column) -> Column:
    """Hour of day of a second offset that may exceed a day."""
    return F.pmod(F.floor(offset / 3600), F.lit(24)).cast("int")


def hour_fraction(local: Column) -> Column:
    return F.hour(local) + F.minute(local) / 60


def cyclic(value: Column, period: float) -> tuple[Column, Column]:
    angle = value * (2 * math.pi / period)
    return F.sin(angle), F.cos(angle)


# --- measures ----------------------------------------------------------------------------------------------------


def safe_share(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double"))


def count_where(condition: Column) -> Column:
    return F.count_if(condition).cast("long")


def plausible(duration: Column, bracket: Column, scheduled: Column, longest: int, ratio: int) -> Column:
    """Durations that can be real: no more negative than the bracket allows, not too long, not many times the schedule."""
    in_ratio = scheduled.isNull() | (scheduled <= 0) | (duration <= scheduled * ratio)
    return F.coalesce(duration.isNotNull() & (duration >= -bracket) & (duration <= longest) & in_ratio, F.lit(False))
