"""Features known at departure: calendar, schedule, identity, and history without leakage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tramloom.config import DEFAULT, SEGMENT_KEY, TRIP_KEY, Settings
from tramloom.functions import exprs as X
from tramloom.functions.asof import asof_backward
from tramloom.functions.running import medians_before
from tramloom.functions.slices import carry, slice_of, with_halo

CALENDAR = ("local_hour", "local_hour_frac", "local_dow", "local_month", "is_weekend", "hour_sin", "hour_cos", "dow_sin", "dow_cos", "is_holiday", "is_service_weekday", "fare_period")
SCHEDULE = ("stop_sequence", "stop_span", "scheduled_duration_sec", "trip_progress", "stops_remaining", "minutes_into_trip", "trip_start_hour", "scheduled_duration_implausible")
IDENTITY = ("route_id", "direction_id", "mode", "from_stop_id", "to_stop_id", "segment_id", "from_station", "to_station")
TRIP_HISTORY = ("upstream_delay_sec", "upstream_delay_last_sec", "segments_completed", "headway_sec")
RECENT = ("recent_duration_median", "recent_duration_mean", "recent_delay_mean", "recent_traversals", "recent_deviation", "recent_age_sec", "recent_vs_scheduled")
_ROLLED = ("roll_median", "roll_mean", "roll_delay_mean", "roll_n", "roll_deviation")
#: What a row's history is made of: its keys, times and durations.
PAST = (*TRIP_KEY, "stop_sequence", *SEGMENT_KEY, "route_id", "direction_id", "actual_departure_ts", "actual_arrival_ts", "actual_duration_sec", "delay_sec", "scheduled_duration_sec")
_TIES = ("service_date", "trip_id", "trip_run", "stop_sequence")


def calendar(rows: DataFrame, holidays: DataFrame | None = None, settings: Settings = DEFAULT, ts: str = "actual_departure_ts") -> DataFrame:
    """Local hour, weekday (Monday 0), month, their cycles, holiday and fare period. Without holidays none is one."""
    local = X.local_time(F.col(ts), settings.zone)
    rows = rows.withColumn("__local", local)
    rows = rows.withColumn("local_hour", F.hour("__local")).withColumn("local_hour_frac", X.hour_fraction(F.col("__local"))).withColumn("local_dow", F.weekday("__local")).withColumn("local_month", F.month("__local"))
    rows = rows.withColumn("is_weekend", (F.col("local_dow") >= 5).cast("int"))
    for name, value, period in (("hour", "local_hour_frac", 24), ("dow", "local_dow", 7)):
        sine, cosine = X.cyclic(F.col(value), period)
        rows = rows.withColumn(f"{name}_sin", sine).withColumn(f"{name}_cos", cosine)
    if holidays is None:
        rows = rows.withColumn("is_holiday", F.lit(0))
    else:
        days = holidays.select(F.col("date").cast("date").alias("__day")).distinct().withColumn("__holiday", F.lit(1))
        rows = rows.withColumn("__day", F.to_date("__local")).join(F.broadcast(days) if _few(days) else days, "__day", "left").withColumn("is_holiday", F.coalesce("__holiday", F.lit(0))).drop("__day", "__holiday")
    work = (F.col("is_weekend") == 0) & (F.col("is_holiday") == 0)
    fare = F.when(~work, "weekend").when(F.col("local_hour_frac") >= settings.fare_evening_hour, "weekday_evening").otherwise("weekday_daytime")
    return rows.withColumn("is_service_weekday", work.cast("int")).withColumn("fare_period", fare).drop("__local")


def _few(df: DataFrame, rows: int = 100_000) -> bool:
    return df.limit(rows + 1).count() <= rows


def schedule_features(rows: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Where in its trip a segment lies. The trip's extent is taken from what was seen of it, so it knows a little of the future."""
    trip = Window.partitionBy(*TRIP_KEY)
    start = F.min("actual_departure_ts").over(trip)
    last = F.max("stop_sequence").over(trip)
    rows = rows.withColumn("__last", last).withColumn("__start", start)
    rows = rows.withColumn("stops_remaining", (F.col("__last") - F.col("stop_sequence")).cast("int")).withColumn("trip_progress", X.safe_share(F.col("stop_sequence"), F.nullif(F.col("__last"), F.lit(0))))
    rows = rows.withColumn("minutes_into_trip", (F.unix_seconds("actual_departure_ts") - F.unix_seconds("__start")) / 60).withColumn("trip_start_hour", F.hour(X.local_time(F.col("__start"), settings.zone)))
    long = F.coalesce(F.col("scheduled_duration_sec") > settings.implausible_schedule_sec, F.lit(False)).cast("int")
    return rows.withColumn("scheduled_duration_implausible", long).drop("__last", "__start")


def identity_features(rows: DataFrame) -> DataFrame:
    start, end = F.col("from_stop_id"), F.col("to_stop_id")
    return rows.withColumn("segment_id", X.segment_id(start, end)).withColumn("from_station", X.station_code(start)).withColumn("to_station", X.station_code(end))


def safe_features(rows: DataFrame, settings: Settings = DEFAULT, holidays: DataFrame | None = None, with_calendar: bool = True, with_schedule: bool = True, with_identity: bool = True) -> DataFrame:
    rows = calendar(rows, holidays, settings) if with_calendar else rows
    rows = schedule_features(rows, settings) if with_schedule else rows
    return identity_features(rows) if with_identity else rows


def upstream_delay(rows: DataFrame) -> DataFrame:
    """Delay on strictly earlier segments of the same run, the last one's delay, and their number.

    Where the last segment has no delay the sum is null too; it goes on after it.
    """
    line = Window.partitionBy(*TRIP_KEY).orderBy("stop_sequence")
    before = line.rowsBetween(Window.unboundedPreceding, -1)
    last = F.lag("delay_sec").over(line)
    return rows.withColumn("upstream_delay_last_sec", last).withColumn("upstream_delay_sec", F.when(last.isNotNull(), F.sum("delay_sec").over(before))).withColumn("segments_completed", F.row_number().over(line) - 1)


def headway(rows: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Seconds since the previous departure from the stop on the same route and direction; long gaps are null.

    A stop's days run apart from each other; a day's first departure gets the last one before that day as a carry.
    """
    keys = ("route_id", "direction_id", "from_stop_id")
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    # rows without a key have no headway and need not meet
    sliced = rows.withColumn("__slice", F.when(known, slice_of(F.col("actual_departure_ts"))).otherwise(F.xxhash64(*_TIES)))
    before = carry(sliced.where(known).select(*keys, "__slice", "actual_departure_ts"), keys, F.max("actual_departure_ts"), "__before")
    line = Window.partitionBy(*keys, "__slice").orderBy("actual_departure_ts", *_TIES)
    last = F.coalesce(F.lag("actual_departure_ts").over(line), F.col("__before"))
    gap = F.unix_seconds("actual_departure_ts") - F.unix_seconds(last)
    found = sliced.join(before, [*keys, "__slice"], "left").withColumn("headway_sec", F.when(known & (gap <= settings.max_headway_sec), gap))
    return found.select(*rows.columns, "headway_sec")


def completions(rows: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Each segment's completions in order, with statistics of the last N up to and with each.

    roll_deviation averages how far each lay from the median of all before it. Medians come from a running histogram,
    a segment's days apart from each other; the last N from blocks of some thousand completions with a halo.
    """
    n = settings.rolling_traversals
    done = rows.where("actual_arrival_ts is not null").select(*SEGMENT_KEY, F.col("actual_arrival_ts").alias("completed_at"), "actual_duration_sec", "delay_sec", *_TIES).withColumn("__slice", slice_of(F.col("completed_at")))
    done = medians_before(done, SEGMENT_KEY, "__slice", ("completed_at", *_TIES), "actual_duration_sec").drop("__slice")
    done = with_halo(done.withColumn("deviation", F.col("actual_duration_sec") - F.col("__median")), "__place", n - 1)
    last = Window.partitionBy(*SEGMENT_KEY, "__block").orderBy("__place").rowsBetween(-(n - 1), 0)
    mean = lambda c: F.avg(c).over(last)
    rolled = done.select(
        *SEGMENT_KEY, "completed_at", *_TIES, "__halo", F.percentile("actual_duration_sec", F.lit(0.5)).over(last).alias("roll_median"), mean("actual_duration_sec").alias("roll_mean"), mean("delay_sec").alias("roll_delay_mean"),
        F.least(F.col("__place") + 1, F.lit(n)).cast("int").alias("roll_n"), mean("deviation").alias("roll_deviation"),
    )
    return rolled.where("not __halo").drop("__halo")


def _recent(rows: DataFrame, age: Column, settings: Settings, negative: bool) -> DataFrame:
    """Rolled columns (those that rows have) as recent ones, null where they are too old."""
    fresh = age.isNotNull() & (age <= settings.rolling_max_age_sec) & (F.lit(True) if negative else age >= 0)
    names = dict(zip(_ROLLED, ("recent_duration_median", "recent_duration_mean", "recent_delay_mean", "recent_traversals", "recent_deviation"), strict=True))
    for old, new in names.items():
        rows = rows.withColumn(new, F.when(fresh, F.col(old))) if old in rows.columns else rows
    rows = rows.withColumn("recent_age_sec", F.when(fresh, age))
    if "roll_median" in rows.columns:
        rows = rows.withColumn("recent_vs_scheduled", F.col("recent_duration_median") - F.col("scheduled_duration_sec"))
    return rows.drop(*_ROLLED, "completed_at")


def recent_conditions(rows: DataFrame, settings: Settings = DEFAULT, rolled: Sequence[str] = _ROLLED) -> DataFrame:
    """How the last N traversals of the segment went that were completed strictly before this one departed.

    ``rolled`` names the statistics of completions that are asked for; no others are made.
    """
    found = asof_backward(rows, completions(rows, settings), SEGMENT_KEY, "actual_departure_ts", "completed_at", rolled, _TIES)
    return _recent(found, F.unix_seconds("actual_departure_ts") - F.unix_seconds("completed_at"), settings, True)


def conditions_lookup(rows: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """One row per segment: the statistics as of its last completion.

    Only the last N completions have a deviation that counts, so each segment takes N medians, of all before the last,
    the last but one and so on, by one aggregate.
    """
    n = settings.rolling_traversals
    newest = Window.partitionBy(*SEGMENT_KEY).orderBy(F.desc("actual_arrival_ts"), *[F.desc(c) for c in _TIES])
    done = rows.where("actual_arrival_ts is not null").withColumn("age", F.row_number().over(newest)).select(*SEGMENT_KEY, *_TIES, "age", F.col("actual_arrival_ts").alias("completed_at"), "actual_duration_sec", "delay_sec")
    duration, last = F.col("actual_duration_sec"), F.col("age") <= n
    norms = [F.percentile(F.when(F.col("age") > i, duration), F.lit(0.5)).alias(f"norm{i}") for i in range(1, n + 1)]
    own = [F.max(F.when(F.col("age") == i, duration)).alias(f"own{i}") for i in range(1, n + 1)]
    one = done.groupBy(*SEGMENT_KEY).agg(
        F.max_by(F.struct("completed_at", *_TIES), -F.col("age")).alias("l"),
        F.percentile(F.when(last, duration), F.lit(0.5)).alias("roll_median"),
        F.avg(F.when(last, duration)).alias("roll_mean"),
        F.avg(F.when(last, F.col("delay_sec"))).alias("roll_delay_mean"),
        F.least(F.count("*"), F.lit(n)).alias("roll_n"),
        *norms,
        *own,
    )
    apart = F.array_compact(F.array(*[F.col(f"own{i}") - F.col(f"norm{i}") for i in range(1, n + 1)]))
    mean = F.when(F.size(apart) > 0, F.aggregate(apart, F.lit(0.0), lambda acc, v: acc + v) / F.size(apart))
    return one.select(*SEGMENT_KEY, F.col("l.completed_at").alias("completed_at"), *_ROLLED[:-1], mean.alias("roll_deviation"))


def with_lookup(rows: DataFrame, lookup: DataFrame, now: Column, settings: Settings = DEFAULT) -> DataFrame:
    """Recent conditions from a lookup for rows scored at ``now``; what is older than allowed, or from the future, is null."""
    return _recent(rows.join(lookup, list(SEGMENT_KEY), "left"), F.unix_seconds(now) - F.unix_seconds("completed_at"), settings, False)


def _narrowed(rows: DataFrame, only: Sequence[str] | None) -> DataFrame:
    return rows if only is None else rows.select(*[c for c in rows.columns if c in PAST or c in only])


def historical_features(rows: DataFrame, settings: Settings = DEFAULT, only: Sequence[str] | None = None) -> DataFrame:
    """With ``only``, shuffles carry what these are made of and nothing else."""
    rows = _narrowed(upstream_delay(_narrowed(rows, only)), only)
    if only is None:
        return headway(recent_conditions(rows, settings), settings)
    if any(c in RECENT for c in only):
        made_of = dict(zip(RECENT, _ROLLED, strict=False)) | {"recent_vs_scheduled": "roll_median"}
        rows = _narrowed(recent_conditions(rows, settings, [c for c in _ROLLED if any(made_of.get(x) == c for x in only)]), only)
    return headway(rows, settings) if "headway_sec" in only else rows


def all_features(rows: DataFrame, settings: Settings = DEFAULT, holidays: DataFrame | None = None, lookup: DataFrame | None = None, now: Column | None = None, only: Sequence[str] | None = None) -> DataFrame:
    """The one entry point for training and scoring, by the groups of features that the settings ask for.

    With a lookup, what only a trip's own past could tell is null. With ``only``, the result has these of the columns and
    PAST, and no feature is made or carried through the history that isn't asked for.
    """
    safe = safe_features(rows, settings, holidays, settings.calendar_features, settings.schedule_features, settings.identity_features)
    if not settings.historical_features:
        return _narrowed(safe, only)
    if lookup is None:
        return historical_features(safe, settings, only)
    scored = with_lookup(safe, lookup, F.col("actual_departure_ts") if now is None else now, settings)
    for name in TRIP_HISTORY:
        scored = scored.withColumn(name, F.lit(None).cast("double"))
    return _narrowed(scored, only)


def feature_summary(rows: DataFrame, columns: list[str] | tuple[str, ...]) -> DataFrame:
    """Of each column: share filled, distinct values, mean (numbers only) and whether it is sparse, in one pass."""
    numeric = {f.name for f in rows.schema if f.dataType.typeName() in ("byte", "short", "integer", "long", "float", "double")}
    aggs = []
    for c in columns:
        mean = F.avg(c).cast("double") if c in numeric else F.lit(None).cast("double")
        aggs.append(F.struct(F.lit(c).alias("feature"), F.avg(F.col(c).isNotNull().cast("double")).alias("fill"), F.countDistinct(c).alias("n_distinct"), mean.alias("mean")).alias(c))
    one = rows.agg(*aggs)
    return one.select(F.explode(F.array(*[F.col(f"`{c}`") for c in columns])).alias("s")).select("s.*", (F.col("s.fill") < 0.5).alias("sparse"))


def projected(rows: DataFrame, features: tuple[str, ...], target: str = "actual_duration_sec") -> DataFrame:
    """Keys, features and target, each column once."""
    keys = [c for c in (*TRIP_KEY, *SEGMENT_KEY, "stop_sequence", "from_stop_sequence", "actual_departure_ts", "actual_arrival_ts") if c not in features]
    return rows.select(*keys, *features, *([] if target in features else [target]))
