"""Plans that chain the operators as their users run them, over all of their dates at once.

What a plan reads more than once is written to the shared folder first, so that nothing is computed twice.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramloom.config import DEFAULT, Settings
from tramloom.functions import exprs as X
from tramloom.operators import arrivals, baselines, dates, encode, evaluate, explore, features, journeys, model, quality, schedule, segments, split
from tramloom.sources import observations, published, tables


def decoded(snapshots: DataFrame, kind: str, path: str, start: Column, end: Column, settings: Settings = DEFAULT) -> DataFrame:
    """Snapshots of a window, flattened and written by service date and window; returns the summary of what was written."""
    rows = observations.in_window(snapshots, start, end)
    flat = observations.vehicle_rows(rows, settings) if kind == "vehicles" else observations.trip_update_rows(rows, settings)
    tables.write_window(flat, path, start, end)
    schema = observations.VEHICLE_SCHEMA if kind == "vehicles" else observations.TRIP_UPDATE_SCHEMA
    own = observations.in_window(observations.read_observations(snapshots.sparkSession, path, schema), start, end)
    return observations.decode_summary(own.withColumn("feed", F.lit(kind)))


def segments_of(vehicles: DataFrame, updates: DataFrame, trips: DataFrame, stop_times: DataFrame, settings: Settings = DEFAULT, tie: Sequence[str] = (), mode: str = "rail", static_version: str = "unknown", bundle_version: str | None = None) -> DataFrame:
    """Observations and a timetable to segments. The timetable is never laid out by date."""
    own = [k for k in settings.trip_keys if k not in ("trip_id",)]
    seen = observations.one_of_each(vehicles, (*own, *observations.VEHICLE_KEY, *tie))
    said = observations.one_of_each(updates, (*own, *observations.TRIP_UPDATE_KEY, *tie))
    both = arrivals.combined_arrivals(arrivals.observed_arrivals(seen, settings, tie), arrivals.predicted_arrivals(said, settings, tie), settings)
    return segments.build_segments(both, schedule.scheduled_stop_times(trips, stop_times), mode, static_version, bundle_version, settings)


def run_window(vehicles: DataFrame, updates: DataFrame, trips: DataFrame, stop_times: DataFrame, start: Column, end: Column, path: str, settings: Settings = DEFAULT, tie: Sequence[str] = ()) -> DataFrame:
    """Segments of every service date that [start, end) covers, published by date; returns their quality, one row.

    Quality is observed by the job that writes, so that nothing is computed or read twice. Only observations of the window are read. Dates that it covers only in part are neither written nor touched; of a
    covered date that has no segments now, none are left.
    """
    spark = vehicles.sparkSession
    own = lambda df: observations.in_window(df, start, end)
    spine = dates.date_spine(spark, F.to_date(F.date_sub(start, 1)), F.to_date(end))
    targets = [r[0] for r in dates.fully_covered(spine, F.unix_seconds(start), F.unix_seconds(end), settings).select("service_date").collect()]
    rows = segments_of(own(vehicles), own(updates), trips, stop_times, settings, tie)
    return quality.observed_quality(spark, published.publish(rows, path, targets, measures=quality.quality_measures(settings)), settings)


def on_run_dates(rows: DataFrame, wanted: Sequence[str], settings: Settings = DEFAULT) -> DataFrame:
    """Each observation once for every wanted service day that it was captured in, with that day as run_date.

    A service day lasts some hours into the next, so an observation may belong to two. The bounds of all days together
    reach the scan.
    """
    at = F.unix_seconds("captured_at")
    ends = lambda d: (X.service_day_start(d, settings.zone), X.service_day_end(d, settings.zone, settings.overhang_hours))
    low, high = ends(F.lit(min(wanted)))[0], ends(F.lit(max(wanted)))[1]
    local = X.local_time(F.col("captured_at"), settings.zone)
    near = F.array(*[F.date_format(F.date_add(F.to_date(local), i), "yyyy-MM-dd") for i in (-1, 0, 1)])
    days = F.filter(near, lambda d: d.isin(list(wanted)) & (at >= ends(d)[0]) & (at < ends(d)[1]))
    return observations.in_window(rows, F.timestamp_seconds(low), F.timestamp_seconds(high)).withColumn("run_date", F.explode(days))


def catch_up(spark: SparkSession, vehicles: DataFrame, updates: DataFrame, trips: DataFrame, stop_times: DataFrame, done: DataFrame, now: Column, path: str, settings: Settings = DEFAULT, tie: Sequence[str] = (), force: bool = False, archive_start: Column | None = None) -> list[str]:
    """Write all outstanding dates in one job, each from the observations of its own service day; returns the dates.

    The result is that of one run for each date: runs are numbered within a date's day. With an empty archive nothing
    is outstanding.
    """
    first = vehicles.agg(F.min("captured_at").alias("t")).first()["t"] if archive_start is None else archive_start
    if first is None:
        return []
    start = F.lit(first) if not isinstance(first, Column) else first
    wanted = sorted(r[0] for r in dates.outstanding(spark, done, now, start, settings, force).collect())  # at most the days of the lookback
    if wanted:
        own = replace(settings, trip_keys=("run_date", *settings.trip_keys))
        rows = segments_of(*[on_run_dates(df, wanted, settings) for df in (vehicles, updates)], trips, stop_times, own, tie)
        rows = rows.where("service_date = run_date").drop("run_date")
        published.publish(rows, path, wanted)
    return wanted


def feature_table(rows: DataFrame, settings: Settings = DEFAULT, holidays: DataFrame | None = None, only: Sequence[str] | None = None) -> DataFrame:
    """Filtered segments with all features (or ``only`` some, and what history is made of) and the split they belong to."""
    made = tables.materialize(features.all_features(segments.filtered(rows, settings), settings, holidays, only=only), "features")
    return split.temporal_split(made, settings=settings)


def publish_features(rows: DataFrame, path: str, columns: Sequence[str], settings: Settings = DEFAULT, holidays: DataFrame | None = None) -> DataFrame:
    """Write the feature table by service date, its keys, features and target alone; returns its summary."""
    made = features.projected(features.all_features(segments.filtered(rows, settings), settings, holidays), tuple(columns))
    published.publish(made, path)
    return features.feature_summary(published.read(rows.sparkSession, path, made.schema), list(columns))


def publish_journeys(rows: DataFrame, path: str, settings: Settings = DEFAULT) -> DataFrame:
    """Write the journeys of filtered segments by service date; returns their summary by length."""
    made = journeys.build_journeys(segments.filtered(rows, settings), settings)
    published.publish(made, path)
    return journeys.journey_summary(published.read(rows.sparkSession, path, made.schema))


def publish_lookup(rows: DataFrame, path: str, settings: Settings = DEFAULT) -> DataFrame:
    """Publish the latest conditions of each segment in place of the former lookup, which its readers keep; returns it as read back."""
    made = features.conditions_lookup(segments.filtered(rows, settings), settings)
    published.publish(made, path, by=None)
    return published.read(rows.sparkSession, path, made.schema, by=None)


def compared(rows: DataFrame, predictions: Sequence[str], settings: Settings = DEFAULT, fitted: model.Model | None = None) -> DataFrame:
    """Validation journeys: their predictions against sums of segment medians (and of a saved segment model, if given).

    Medians are fitted on segments of no block that a validation journey belongs to, so that they never saw what they
    are held against. rows need local_hour, and the model's columns if there is one.
    """
    blocks = tables.materialize(journeys.with_blocks(rows, settings), "blocks")
    parts = tables.materialize(split.split_journeys(journeys.build_journeys(blocks, settings), settings), "journeys")
    valid = parts.where("split = 'validation'").withColumn("schedule", F.col("scheduled_duration_sec"))
    train = split.outside_blocks(blocks, valid)
    own = blocks.join(valid.select(*journeys.BLOCK_KEY).distinct(), list(journeys.BLOCK_KEY), "left_semi")
    scored = baselines.apply_medians(own, baselines.fitted_medians(train), name="segment_median")
    columns = ["segment_median"]
    if fitted is not None:
        scored = model.predict_calibrated(fitted, scored)
        columns += ["prediction", "calibrated"]
    return journeys.head_to_head(valid, scored, columns, ["schedule", *predictions], settings)


def _long(df: DataFrame, part: str, about: Column, names: Sequence[str]) -> DataFrame:
    """The named columns of df as rows of (part, about, measure, value)."""
    pairs = F.array(*[F.struct(F.lit(n).alias("measure"), F.col(n).cast("double").alias("value")) for n in names])
    return df.select(F.lit(part).alias("part"), about.cast("string").alias("about"), F.explode(pairs).alias("m")).select("part", "about", "m.*")


def evaluation_report(scored: DataFrame, prediction: str, settings: Settings = DEFAULT, codes: DataFrame | None = None, categories: Sequence[str] = ()) -> DataFrame:
    """(part, about, measure, value) in one table: errors of segments by model, of journeys by length and of groups, how
    blocks hold together, the offset that a calibration would add, and the share of each category that training never saw."""
    rows = tables.materialize(scored, "scored")
    blocks = journeys.with_blocks(rows, settings)
    level = evaluate.segment_level(rows, [prediction, "scheduled_duration_sec"])
    length = evaluate.journey_level(blocks, prediction, "scheduled_duration_sec", settings)
    group = evaluate.error_by_group(rows, "route_id", [prediction])
    parts = [
        _long(level, "segments", F.col("baseline"), ["n_rows", "mae", "rmse", "median_abs"]),
        _long(length, "journeys", F.col("n_segments"), ["n", "median_sec", "model_mae", "baseline_mae", "beats_pct"]),
        _long(group, "routes", F.col("route_id"), ["n", f"{prediction}_mae"]),
        _long(journeys.block_diagnostics(blocks), "blocks", F.lit(""), ["n_segments", "runs", "blocks", "pairs", "broken", "median_block", "contiguous_pct"]),
        _long(baselines.residual_offset(rows, prediction), "calibration", F.lit(prediction), ["offset"]),
    ]
    if codes is not None:
        parts.append(_long(encode.unseen_rate(rows, codes, categories), "unseen", F.col("column"), ["unseen_pct"]))
    return functools.reduce(DataFrame.unionByName, parts)


def quality_report(rows: DataFrame, realtime: DataFrame, trips: DataFrame, hours: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """(part, about, measure, value): of segments, of how the feed matches the timetable, of each feed's hours, and what blocks."""
    segment = tables.materialize(quality.segment_quality(rows, settings), "segment-quality")
    match = tables.materialize(schedule.match_report(realtime, trips, settings), "match")
    cover = tables.materialize(quality.coverage(hours), "coverage")

    def long(df: DataFrame, part: str, about: Column) -> DataFrame:
        return _long(df, part, about, [f.name for f in df.schema if f.dataType.typeName() in ("integer", "long", "double")])

    issues = quality.blocking_issues(match, segment, cover, settings).select(F.lit("blocking").alias("part"), "about", F.col("issue").alias("measure"), "value")
    return functools.reduce(DataFrame.unionByName, [long(segment, "segments", F.lit("")), long(match, "match", F.lit("")), long(cover, "coverage", F.col("feed")), issues])


def exploration_report(
    vehicles: DataFrame, updates: DataFrame, observed: DataFrame, settings: Settings = DEFAULT, hours: DataFrame | None = None, static: tuple[DataFrame, DataFrame, DataFrame, DataFrame] | None = None,
    lifetimes: DataFrame | None = None, k: int = 8,
) -> DataFrame:
    """(part, about, measure, value): fields set, statuses and commonest stops, relationships, ages of reports (where
    vehicle_ts is known), how predictions live and drift, whether arrivals can be had from a feed, and, where they are
    given, what each feed's hours lack (of quality.hour_status) and how ids meet the timetable's (realtime ids, trips,
    stop times and stops)."""
    parts = [_long(explore.field_census(df), name, F.col("field"), ["share"]) for name, df in (("vehicle_fields", vehicles), ("update_fields", updates))]
    parts += [_long(explore.value_counts(vehicles, c, most), "vehicles", F.concat_ws("=", F.lit(c), "value"), ["n"]) for c, most in (("status", None), ("stop_id", k))]
    parts.append(_long(explore.prediction_profile(updates, k), "updates", F.concat_ws("=", "measure", "value"), ["n"]))
    if "vehicle_ts" in vehicles.columns:
        parts.append(_long(explore.report_age(vehicles), "report_age", F.lit(""), ["n", "median", "p95", "longest"]))
    lived = arrivals.prediction_lifetimes(updates) if lifetimes is None else lifetimes
    parts.append(_long(explore.prediction_drift(updates, lived), "predictions", F.lit(""), ["pairs", "settled", "median_drift", "most_observations"]))
    can = explore.viability(observed, settings.max_bracket_sec)
    parts.append(_long(can, "arrivals", F.lit(""), can.columns))
    if hours is not None:
        lacking = explore.hour_shortfall(hours).groupBy("feed", "status").agg(F.count("*").alias("hours"), F.sum("n").alias("snapshots"), F.sum("shortfall").alias("shortfall"))
        parts.append(_long(lacking, "hours", F.concat_ws("=", "feed", "status"), ["hours", "snapshots", "shortfall"]))
    if static is not None:
        parts.append(_long(schedule.static_join_report(*static), "timetable", F.col("measure"), ["n"]).withColumn("measure", F.lit("n")))
    return functools.reduce(DataFrame.unionByName, parts)
