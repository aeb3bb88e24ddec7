"""Queries over features, baselines, splits, codes, journeys and models."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tramloom.operators import baselines, encode, evaluate, features, journeys, model, split
from tramloom.plans import pipelines
from tramloom.queries.base import S, built, dated, kept, r
from tramloom.queries.sql import Query, sql
from tramloom.sources import tables

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
_KEY = ["service_date", "trip_id", "trip_run", "stop_sequence"]
_K = "service_date, trip_id, trip_run, stop_sequence"


def add(name: str, run: Query, text: str | None = None) -> None:
    QUERIES[name] = run
    if text is not None:
        SQL[name] = text


# --- features ------------------------------------------------------------------------------------------------------
def _holidays(s, d):
    return s.read.parquet(f"{d}/events.parquet").select(F.to_date("ts").alias("date")).distinct().where(F.dayofmonth("date") % 10 == 5)


add(
    "features_calendar",
    lambda s, d: features.calendar(kept(s, d), _holidays(s, d), S).select(*_KEY, "local_hour", r("local_hour_frac"), "local_dow", "local_month", "is_weekend", *[r(c) for c in ("hour_sin", "hour_cos", "dow_sin", "dow_cos")], "is_holiday", "is_service_weekday", "fare_period"),
    sql(f"""SELECT {_K}, local_hour, round(hf, 4) AS local_hour_frac, dow AS local_dow, month(loc)::INT AS local_month, (dow >= 5)::INT AS is_weekend, round(sin(2 * pi() * hf / 24), 4) AS hour_sin, round(cos(2 * pi() * hf / 24), 4) AS hour_cos, round(sin(2 * pi() * dow / 7), 4) AS dow_sin, round(cos(2 * pi() * dow / 7), 4) AS dow_cos,
      h::INT AS is_holiday, (dow < 5 AND NOT h)::INT AS is_service_weekday, CASE WHEN dow >= 5 OR h THEN 'weekend' WHEN hf >= 21.5 THEN 'weekday_evening' ELSE 'weekday_daytime' END AS fare_period
      FROM (SELECT *, loc::DATE IN (SELECT ts::DATE FROM events WHERE day(ts) % 10 = 5) AS h FROM feat)""", "feat"),
)
add(
    "features_schedule",
    lambda s, d: features.schedule_features(kept(s, d), S).select(*_KEY, "stops_remaining", r("trip_progress", digits=6), r("minutes_into_trip"), "trip_start_hour", "scheduled_duration_implausible"),
    sql(f"""SELECT {_K}, (max(stop_sequence) OVER w - stop_sequence)::INT AS stops_remaining, round(stop_sequence / nullif(max(stop_sequence) OVER w, 0)::DOUBLE, 6) AS trip_progress, round((dep - min(dep) OVER w) / 60.0::DOUBLE, 4) AS minutes_into_trip,
      hour(make_timestamp((min(dep) OVER w - 18000) * 1000000))::INT AS trip_start_hour, (sdur > 900)::INT AS scheduled_duration_implausible FROM fseg WINDOW w AS (PARTITION BY service_date, trip_id, trip_run)""", "fseg"),
)
add(
    "features_identity",
    lambda s, d: features.identity_features(kept(s, d)).select(*_KEY, "segment_id", "from_station", "to_station"),
    sql(f"SELECT {_K}, from_stop_id || '>' || to_stop_id AS segment_id, substr(from_stop_id, 4, 3) AS from_station, substr(to_stop_id, 4, 3) AS to_station FROM fseg", "fseg"),
)
add(
    "features_upstream_delay",
    lambda s, d: features.upstream_delay(kept(s, d)).select(*_KEY, "upstream_delay_sec", "upstream_delay_last_sec", F.col("segments_completed").cast("int").alias("segments_completed")),
    sql(f"SELECT {_K}, (sum(delay) OVER (PARTITION BY service_date, trip_id, trip_run ORDER BY stop_sequence ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))::BIGINT AS upstream_delay_sec, lag(delay) OVER (PARTITION BY service_date, trip_id, trip_run ORDER BY stop_sequence) AS upstream_delay_last_sec, (row_number() OVER (PARTITION BY service_date, trip_id, trip_run ORDER BY stop_sequence) - 1)::INT AS segments_completed FROM fseg", "fseg"),
)
add(
    "features_headway",
    lambda s, d: features.headway(kept(s, d), S).select(*_KEY, "headway_sec"),
    sql(f"SELECT {_K}, CASE WHEN gap <= 86400 THEN gap END AS headway_sec FROM (SELECT *, dep - lag(dep) OVER (PARTITION BY route_id, direction_id, from_stop_id ORDER BY dep, service_date, trip_id, trip_run, stop_sequence) AS gap FROM fseg)", "fseg"),
)
_RECENT = "CASE WHEN age <= 604800 THEN {c} END"
_REC_SQL = (
    ", ".join(
        [f"round({_RECENT.format(c=c)}::DOUBLE, 4) AS {n}" for c, n in (("roll_median", "recent_duration_median"), ("roll_mean", "recent_duration_mean"), ("roll_delay_mean", "recent_delay_mean"), ("roll_deviation", "recent_deviation"), ("roll_median - sdur", "recent_vs_scheduled"))],
    )
    + f", {_RECENT.format(c='roll_n')}::INT AS recent_traversals, {_RECENT.format(c='age')}::BIGINT AS recent_age_sec"
)


def _recent_columns(df, *keys):
    return df.select(*keys, *[r(c) for c in ("recent_duration_median", "recent_duration_mean", "recent_delay_mean", "recent_deviation", "recent_vs_scheduled")], F.col("recent_traversals").cast("int").alias("recent_traversals"), F.col("recent_age_sec").cast("long").alias("recent_age_sec"))


add("features_recent_conditions", lambda s, d: _recent_columns(features.recent_conditions(kept(s, d), S), *_KEY), sql(f"SELECT {_K}, {_REC_SQL} FROM recent", "recent"))
add(
    "conditions_lookup",
    lambda s, d: features.conditions_lookup(kept(s, d), S).select("from_stop_id", "to_stop_id", F.unix_seconds("completed_at").alias("completed_sec"), *[r(c) for c in ("roll_median", "roll_mean", "roll_delay_mean", "roll_deviation")], F.col("roll_n").cast("int").alias("roll_n")),
    sql("SELECT from_stop_id, to_stop_id, arr AS completed_sec, round(roll_median::DOUBLE, 4) AS roll_median, round(roll_mean, 4) AS roll_mean, round(roll_delay_mean, 4) AS roll_delay_mean, round(roll_deviation, 4) AS roll_deviation, roll_n::INT AS roll_n FROM look", "look"),
)
_NOW = 1706745600  # 2024-02-01 00:00 UTC
add(
    "features_by_lookup",
    lambda s, d: (lambda rows: _recent_columns(features.all_features(rows, S, None, features.conditions_lookup(rows, S), F.timestamp_seconds(F.lit(_NOW))), *_KEY, "upstream_delay_sec"))(kept(s, d)),
    sql(f"SELECT {_K}, NULL::DOUBLE AS upstream_delay_sec, {_REC_SQL} FROM (SELECT f.*, {_NOW} - l.arr AS age, roll_median, roll_mean, roll_delay_mean, roll_n, roll_deviation FROM fseg f LEFT JOIN look l USING (from_stop_id, to_stop_id))", "fseg", "look"),
)
add(
    "feature_summary",
    lambda s, d: features.feature_summary(features.all_features(kept(s, d), S), ("local_hour", "fare_period", "headway_sec", "recent_duration_median", "upstream_delay_sec")).select("feature", r("fill", digits=6), "n_distinct", r("mean"), "sparse"),
)
SQL["feature_summary"] = (
    sql("", "recent").rstrip()
    + """, x AS (SELECT local_hour, CASE WHEN dow >= 5 THEN 'weekend' WHEN hf >= 21.5 THEN 'weekday_evening' ELSE 'weekday_daytime' END AS fare, CASE WHEN age <= 604800 THEN roll_median END AS rm,
  dep - lag(dep) OVER (PARTITION BY route_id, direction_id, from_stop_id ORDER BY dep, service_date, trip_id, trip_run, stop_sequence) AS gap, sum(delay) OVER (PARTITION BY service_date, trip_id, trip_run ORDER BY stop_sequence ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS up FROM recent),
  y AS (SELECT * REPLACE (CASE WHEN gap <= 86400 THEN gap END AS gap) FROM x),
  z AS (SELECT 'local_hour' AS feature, avg((local_hour IS NOT NULL)::INT) AS fill, count(DISTINCT local_hour) AS n_distinct, avg(local_hour)::DOUBLE AS mean FROM y UNION ALL SELECT 'fare_period', avg((fare IS NOT NULL)::INT), count(DISTINCT fare), NULL FROM y
    UNION ALL SELECT 'headway_sec', avg((gap IS NOT NULL)::INT), count(DISTINCT gap), avg(gap) FROM y UNION ALL SELECT 'recent_duration_median', avg((rm IS NOT NULL)::INT), count(DISTINCT rm), avg(rm) FROM y UNION ALL SELECT 'upstream_delay_sec', avg((up IS NOT NULL)::INT), count(DISTINCT up), avg(up) FROM y)
SELECT feature, round(fill, 6) AS fill, n_distinct, round(mean, 4) AS mean, fill < 0.5 AS sparse FROM z"""
)

def _for_model(s, d):
    """Summaries of just those columns that a model may see, as feature_columns picks them from a wider table."""
    rows = features.identity_features(kept(s, d))
    rows = rows.select(*_KEY, "from_stop_id", "to_stop_id", "actual_departure_ts", "actual_arrival_ts", "actual_duration_sec", "delay_sec", "arrival_source", "duration_plausible", "stop_span", "scheduled_duration_sec", "route_id", "segment_id", "from_station")
    return features.feature_summary(rows, encode.feature_columns(rows, ("route_id",))).select("feature", r("fill", digits=6), "n_distinct", r("mean"))


_SEEN = {"stop_sequence": "avg(stop_sequence)", "stop_span": "avg(stop_span)", "scheduled_duration_sec": "avg(sdur)", "segment_id": "NULL::DOUBLE", "from_station": "NULL::DOUBLE"}
_OF = {"scheduled_duration_sec": "sdur", "segment_id": "from_stop_id || '>' || to_stop_id", "from_station": "substr(from_stop_id, 4, 3)"}
add(
    "features_for_a_model",
    _for_model,
    sql(" UNION ALL ".join(f"SELECT '{c}' AS feature, round(avg(({_OF.get(c, c)} IS NOT NULL)::INT), 6) AS fill, count(DISTINCT {_OF.get(c, c)}) AS n_distinct, round({mean}::DOUBLE, 4) AS mean FROM fseg" for c, mean in _SEEN.items()), "fseg"),
)

# --- baselines -----------------------------------------------------------------------------------------------------
_SCORE = (
    "count(*) AS n_rows, round(avg(abs(dur - p))::DOUBLE, 4) AS mae, round(sqrt(avg((dur - p)::DOUBLE * (dur - p))), 4) AS rmse, "
    "round(quantile_cont(abs(dur - p), 0.5)::DOUBLE, 4) AS median_abs, round(avg((p IS NOT NULL)::INT), 6) AS coverage"
)
_BASE = f"""z AS (SELECT 'schedule' AS baseline, {_SCORE}, false AS in_sample FROM (SELECT dur, sdur AS p FROM feat)
  UNION ALL SELECT 'segment_median', {_SCORE}, true FROM (SELECT dur, quantile_cont(dur, 0.5) OVER (PARTITION BY from_stop_id, to_stop_id) AS p FROM feat)
  UNION ALL SELECT 'segment_hour_median', {_SCORE}, true FROM (SELECT dur, quantile_cont(dur, 0.5) OVER (PARTITION BY from_stop_id, to_stop_id, local_hour) AS p FROM feat)),
  fl AS (SELECT quantile_cont(bracket, 0.5) / 2 * sqrt(2) * 0.8 AS f FROM feat)"""
add(
    "baselines",
    lambda s, d: baselines.suite(dated(s, d), S).select("baseline", "n_rows", r("mae"), r("rmse"), r("median_abs"), r("coverage", digits=6), "in_sample", r("floor_sec"), "best", r("over_floor_sec", digits=2)),
    sql("", "feat").rstrip() + ", " + _BASE + "\nSELECT z.*, round(f, 4) AS floor_sec, mae = (SELECT min(mae) FROM z) AS best, round(mae - f, 2) AS over_floor_sec FROM z, fl",
)
add(
    "noise_floor",
    lambda s, d: baselines.noise_floor(dated(s, d)).select(r("bracket"), r("median_duration"), r("half_bracket"), r("floor_sec")),
    sql(
        (
            "SELECT round(quantile_cont(bracket, 0.5)::DOUBLE, 4) AS bracket, round(quantile_cont(dur, 0.5)::DOUBLE, 4) AS median_duration, "
            "round(quantile_cont(bracket, 0.5)::DOUBLE / 2, 4) AS half_bracket, round(quantile_cont(bracket, 0.5)::DOUBLE / 2 * sqrt(2) * 0.8, 4) AS floor_sec "
            "FROM feat"
        ),
        "feat",
    ),
)
_BUCKETS = ((0, 2400), (2400, 7200), (7200, 12000), (12000, 100000))
add(
    "residual_homogeneity",
    lambda s, d: baselines.residual_homogeneity(kept(s, d), _BUCKETS).select("bucket", "n", r("residual_sd"), r("median_sec"), F.round("relative_sd_pct", 1).alias("relative_sd_pct")),
    sql("""SELECT bucket, count(*) AS n, round(stddev_samp(dur - sdur), 4) AS residual_sd, round(quantile_cont(sdur, 0.5)::DOUBLE, 4) AS median_sec, round_even(100 * stddev_samp(dur - sdur) / quantile_cont(sdur, 0.5)::DOUBLE, 1) AS relative_sd_pct
      FROM (SELECT *, CASE WHEN sdur > 0 AND sdur <= 2400 THEN '(0, 2400]' WHEN sdur > 2400 AND sdur <= 7200 THEN '(2400, 7200]' WHEN sdur > 7200 AND sdur <= 12000 THEN '(7200, 12000]' WHEN sdur > 12000 AND sdur <= 100000 THEN '(12000, 100000]' END AS bucket FROM fseg) WHERE bucket IS NOT NULL GROUP BY 1""", "fseg"),
)


# --- splits --------------------------------------------------------------------------------------------------------
def split_of(s, d):
    return split.temporal_split(dated(s, d), settings=S)


def valid(s, d):
    return validated(split_of(s, d))


def validated(rows):
    """The validation part of a split with the medians of its training part as pred."""
    part = lambda n: rows.where(F.col("split") == n)
    return baselines.apply_medians(part("validation"), baselines.fitted_medians(part("train")), name="pred")


add("temporal_split", lambda s, d: split_of(s, d).select(*_KEY, "split"), sql(f"SELECT {_K}, split FROM split", "split"))
add(
    "split_report",
    lambda s, d: split.split_report(split_of(s, d)),
    sql("SELECT split, count(*) AS n_rows, count(DISTINCT service_date) AS dates, min(dep) AS first, max(dep) AS last FROM split GROUP BY 1", "split"),
)
add(
    "unseen_segments",
    lambda s, d: split.unseen_segments(split_of(s, d)),
    sql("SELECT from_stop_id, to_stop_id FROM split WHERE split = 'validation' EXCEPT SELECT from_stop_id, to_stop_id FROM split WHERE split = 'train'", "split"),
)
add(
    "split_warnings",
    lambda s, d: split.split_warnings(split_of(s, d), S),
    sql("""SELECT *, days < 14 AS too_few_days, validation_weekdays = 1 AS single_weekday, validation_days = 1 AS single_date, unseen_segments > 0 AS has_unseen FROM (SELECT count(DISTINCT service_date) AS days, count(DISTINCT service_date) FILTER (WHERE split = 'validation') AS validation_days, count(DISTINCT isodow(service_date::DATE)) FILTER (WHERE split = 'validation') AS validation_weekdays,
      (SELECT count(*) FROM (SELECT from_stop_id, to_stop_id FROM split WHERE split = 'validation' EXCEPT SELECT from_stop_id, to_stop_id FROM split WHERE split = 'train')) AS unseen_segments FROM split)""", "split"),
)
add("medians_applied", lambda s, d: valid(s, d).select(*_KEY, r("pred")), sql(f"SELECT {_K}, round(pred::DOUBLE, 4) AS pred FROM scored", "scored"))
add("residual_offset", lambda s, d: baselines.residual_offset(valid(s, d), "pred").select(r("offset")), sql("SELECT round(avg(dur - pred)::DOUBLE, 4) AS \"offset\" FROM scored", "scored"))
add(
    "calibrated",
    lambda s, d: (lambda v: baselines.score(baselines.calibrated(v, "pred", baselines.residual_offset(v, "pred")), "calibrated", F.col("calibrated"), True))(valid(s, d)).select("baseline", "n_rows", r("mae"), r("rmse")),
    sql(
        (
            "SELECT 'calibrated' AS baseline, count(*) AS n_rows, round(avg(abs(dur - pred - o))::DOUBLE, 4) AS mae, "
            "round(sqrt(avg((dur - pred - o)::DOUBLE * (dur - pred - o))), 4) AS rmse FROM scored, (SELECT avg(dur - pred) AS o FROM scored)"
        ),
        "scored",
    ),
)

# --- codes ---------------------------------------------------------------------------------------------------------
CATEGORIES = ["from_stop_id", "route_id"]
_CODES = (
    "SELECT 'from_stop_id' AS \"column\", from_stop_id AS value, (dense_rank() OVER (ORDER BY from_stop_id) - 1)::INT AS code "
    "FROM (SELECT DISTINCT from_stop_id FROM split WHERE split = 'train') UNION ALL SELECT 'route_id', route_id, (dense_rank() OVER (ORDER BY route_id) "
    "- 1)::INT FROM (SELECT DISTINCT route_id FROM split WHERE split = 'train')"
)


def codes(rows):
    return encode.fit_codes(rows.where("split = 'train'"), CATEGORIES)


def _strange(rows):
    """rows in which some routes are ones that training never saw."""
    return rows.withColumn("route_id", F.when(F.col("trip_run") % 3 == 0, F.lit("R9")).otherwise(F.col("route_id")))


def _codes_applied(s, d):
    rows = split_of(s, d)
    return encode.encode(_strange(rows).where("split = 'validation'").select(*_KEY, *CATEGORIES), codes(rows), CATEGORIES)


def _unseen(s, d):
    rows = split_of(s, d)
    return encode.unseen_rate(_strange(rows).select(*CATEGORIES), codes(rows), CATEGORIES).select("column", r("unseen_pct"))


add("codes", lambda s, d: codes(split_of(s, d)), sql(_CODES, "split"))
add(
    "codes_applied",
    _codes_applied,
    sql("", "split").rstrip() + f", codes AS ({_CODES})\nSELECT {_K}, coalesce(a.code, -1) AS from_stop_id, coalesce(b.code, -1) AS route_id FROM (SELECT {_K}, from_stop_id, CASE WHEN trip_run % 3 = 0 THEN 'R9' ELSE route_id END AS route_id FROM split WHERE split = 'validation') v LEFT JOIN codes a ON a.\"column\" = 'from_stop_id' AND a.value = v.from_stop_id LEFT JOIN codes b ON b.\"column\" = 'route_id' AND b.value = v.route_id",
)
add(
    "unseen_rate",
    _unseen,
    sql("", "split").rstrip() + f", codes AS ({_CODES}), v AS (SELECT from_stop_id, CASE WHEN trip_run % 3 = 0 THEN 'R9' ELSE route_id END AS route_id FROM split)\nSELECT 'from_stop_id' AS \"column\", round(100 * avg((from_stop_id NOT IN (SELECT value FROM codes WHERE \"column\" = 'from_stop_id'))::INT), 4) AS unseen_pct FROM v UNION ALL SELECT 'route_id', round(100 * avg((route_id NOT IN (SELECT value FROM codes WHERE \"column\" = 'route_id'))::INT), 4) FROM v",
)


# --- journeys ------------------------------------------------------------------------------------------------------
def _blocks(s, d):
    return journeys.with_blocks(dated(s, d), S)


def _journeys(s, d):
    return journeys.build_journeys(_blocks(s, d), S)


add("blocks", lambda s, d: _blocks(s, d).select(*_KEY, "block_no"), sql(f"SELECT {_K}, block_no FROM blocks", "blocks"))
add(
    "block_diagnostics",
    lambda s, d: journeys.block_diagnostics(_blocks(s, d)).select("n_segments", "runs", "blocks", "pairs", "broken", r("median_block"), r("contiguous_pct")),
    sql("", "blocks").rstrip() + ", b AS (SELECT service_date, trip_id, trip_run, block_no, count(*) AS n FROM blocks GROUP BY ALL), u AS (SELECT service_date, trip_id, trip_run, count(*) AS b, sum(n) AS n FROM b GROUP BY ALL)\nSELECT sum(n)::BIGINT AS n_segments, count(*) AS runs, sum(b)::BIGINT AS blocks, sum(n - 1)::BIGINT AS pairs, sum(b - 1)::BIGINT AS broken, (SELECT round(quantile_cont(n, 0.5)::DOUBLE, 4) FROM b) AS median_block, round(100 - 100 * sum(b - 1) / sum(n - 1)::DOUBLE, 4) AS contiguous_pct FROM u",
)
add(
    "journeys",
    lambda s, d: _journeys(s, d).select("service_date", "trip_id", "trip_run", "block_no", "n_segments", "route_id", "direction_id", "origin_stop_id", "origin_sequence", "dest_stop_id", "dest_sequence", "origin_station", "dest_station", F.unix_seconds("actual_departure_ts").alias("departure_sec"), "actual_duration_sec", "scheduled_duration_sec", "stop_span"),
    sql("SELECT service_date, trip_id, trip_run, block_no, n_segments, route_id, direction_id, origin_stop_id, origin_sequence, dest_stop_id, dest_sequence, substr(origin_stop_id, 4, 3) AS origin_station, substr(dest_stop_id, 4, 3) AS dest_station, dep AS departure_sec, dur AS actual_duration_sec, sdur AS scheduled_duration_sec, stop_span FROM journ", "journ"),
)
add(
    "journey_summary",
    lambda s, d: journeys.journey_summary(_journeys(s, d)).select("n_segments", "n_rows", r("p05"), r("median"), r("p95")),
    sql(
        (
            "SELECT n_segments, count(*) AS n_rows, round(quantile_cont(dur, 0.05)::DOUBLE, 4) AS p05, round(quantile_cont(dur, 0.5)::DOUBLE, 4) AS median, "
            "round(quantile_cont(dur, 0.95)::DOUBLE, 4) AS p95 FROM journ GROUP BY 1"
        ),
        "journ",
    ),
)
add(
    "journey_errors",
    lambda s, d: journeys.journey_errors(_blocks(s, d), "scheduled_duration_sec", S.lengths).select("n_segments", "n", r("mae"), r("rmse", digits=2), r("bias"), r("sd", digits=2), r("median_sec"), r("mae_pct", digits=3)),
    sql("SELECT n_segments, count(*) AS n, round(avg(abs(dur - sdur)), 4) AS mae, round(sqrt(avg((dur - sdur)::DOUBLE * (dur - sdur))), 2) AS rmse, round(avg(dur - sdur), 4) AS bias, round(stddev_samp(dur - sdur), 2) AS sd, round(quantile_cont(dur, 0.5)::DOUBLE, 4) AS median_sec, round(100 * avg(abs(dur - sdur)) / quantile_cont(dur, 0.5)::DOUBLE, 3) AS mae_pct FROM journ GROUP BY 1", "journ"),
)
add(
    "journey_split",
    lambda s, d: split.split_journeys(_journeys(s, d), S).groupBy("split", "n_segments").agg(F.count("*").alias("n")),
    sql("SELECT split, n_segments, count(*) AS n FROM jsplit GROUP BY 1, 2", "jsplit"),
)
add(
    "journey_shared_days",
    lambda s, d: split.shared_days(split.split_journeys(_journeys(s, d), S)),
    sql("SELECT service_date FROM jsplit WHERE split = 'train' INTERSECT SELECT service_date FROM jsplit WHERE split = 'validation'", "jsplit"),
)
_CMP = ", ".join(f"round(avg(abs(dur - {c}))::DOUBLE, 4) AS {n}_mae, round(avg(dur - {c})::DOUBLE, 4) AS {n}_bias" for c, n in (("sdur", "schedule"), ("pred", "summed")))


def _compared(s, d):
    return pipelines.compared(dated(s, d), [], S)


add(
    "journeys_compared",
    lambda s, d: _compared(s, d).select("n_segments", "n", *[r(c) for c in ("schedule_mae", "schedule_bias", "summed_mae", "summed_bias")]),
    sql(f"SELECT n_segments, count(*) AS n, {_CMP} FROM hsum GROUP BY 1", "hsum"),
)
add(
    "journeys_best",
    lambda s, d: journeys.best_by_length(_compared(s, d), ["schedule", "summed"]).select("n_segments", "best", r("mae")),
    sql(
        (
            "SELECT n_segments, CASE WHEN avg(abs(dur - sdur)) <= avg(abs(dur - pred)) THEN 'schedule' ELSE 'summed' END AS best, round(least(avg(abs(dur - sdur)), "
            "avg(abs(dur - pred)))::DOUBLE, 4) AS mae FROM hsum GROUP BY 1"
        ),
        "hsum",
    ),
)
add(
    "journey_level",
    lambda s, d: evaluate.journey_level(journeys.with_blocks(valid(s, d), S), "pred", "scheduled_duration_sec", S).select("n_segments", "n", r("median_sec"), r("model_mae"), r("baseline_mae"), r("floor_pct", digits=6), r("beats_pct")),
    sql("SELECT n_segments, count(*) AS n, round(quantile_cont(dur, 0.5)::DOUBLE, 4) AS median_sec, round(avg(abs(dur - pred))::DOUBLE, 4) AS model_mae, round(avg(abs(dur - sdur))::DOUBLE, 4) AS baseline_mae, round(2400 / quantile_cont(dur, 0.5)::DOUBLE, 6) AS floor_pct, round(100 * (1 - avg(abs(dur - pred)) / avg(abs(dur - sdur)))::DOUBLE, 4) AS beats_pct FROM ssum GROUP BY 1", "ssum"),
)

# --- evaluation ----------------------------------------------------------------------------------------------------
add(
    "segment_level",
    lambda s, d: evaluate.segment_level(valid(s, d), ["pred", "scheduled_duration_sec"]).select("baseline", "n_rows", r("mae"), r("rmse"), r("median_abs")),
    sql(
        (
            "SELECT 'pred' AS baseline, count(*) AS n_rows, round(avg(abs(dur - pred))::DOUBLE, 4) AS mae, round(sqrt(avg((dur - pred)::DOUBLE * (dur - pred))), 4) "
            "AS rmse, round(quantile_cont(abs(dur - pred), 0.5)::DOUBLE, 4) AS median_abs FROM scored UNION ALL SELECT 'scheduled_duration_sec', count(*), "
            "round(avg(abs(dur - sdur))::DOUBLE, 4), round(sqrt(avg((dur - sdur)::DOUBLE * (dur - sdur))), 4), round(quantile_cont(abs(dur - sdur), 0.5)::DOUBLE, "
            "4) FROM scored"
        ),
        "scored",
    ),
)
add(
    "error_by_group",
    lambda s, d: evaluate.error_by_group(valid(s, d), "route_id", ["pred"]).select("route_id", "n", r("pred_mae")),
    sql("SELECT route_id, count(*) AS n, round(avg(abs(dur - pred))::DOUBLE, 4) AS pred_mae FROM scored GROUP BY 1", "scored"),
)
add(
    "binned_predictions",
    lambda s, d: evaluate.binned(dated(s, d), "scheduled_duration_sec", bins=4, least=5).select("bin", "n", r("mean_prediction"), r("q25"), r("median"), r("q75")),
    sql("", "feat").rstrip() + ", e AS (SELECT list_distinct([quantile_cont(sdur, 0.25), quantile_cont(sdur, 0.5), quantile_cont(sdur, 0.75)]) AS e FROM feat), x AS (SELECT f.*, len(list_filter(e, lambda v: v < sdur))::INT AS bin FROM feat f, e)\nSELECT bin, count(*) AS n, round(avg(sdur), 4) AS mean_prediction, round(quantile_cont(dur, 0.25)::DOUBLE, 4) AS q25, round(quantile_cont(dur, 0.5)::DOUBLE, 4) AS median, round(quantile_cont(dur, 0.75)::DOUBLE, 4) AS q75 FROM x GROUP BY 1 HAVING count(*) >= 5",
)
add(
    "clipped_residuals",
    lambda s, d: evaluate.clipped_residuals(dated(s, d), "scheduled_duration_sec", bins=5).select("bin", "n", r("mean_residual"), r("median_residual")),
    sql("", "feat").rstrip() + ", e AS (SELECT quantile_cont((dur - sdur)::DOUBLE, 0.005) AS lo, quantile_cont((dur - sdur)::DOUBLE, 0.995) AS hi, quantile_cont((dur - sdur)::DOUBLE, 0.5) AS md, avg(dur - sdur) AS mn FROM feat), x AS (SELECT least(greatest(dur - sdur, lo), hi) AS c, e.* FROM feat, e)\nSELECT least(floor((c - lo) / greatest((hi - lo) / 5, 1e-9)), 4)::INT AS bin, count(*) AS n, round(any_value(mn), 4) AS mean_residual, round(any_value(md), 4) AS median_residual FROM x GROUP BY 1",
)

# --- models --------------------------------------------------------------------------------------------------------
_COLUMNS = ("local_hour", "local_dow", "stop_span", "scheduled_duration_sec", "from_station", "route_id", "upstream_delay_sec", "headway_sec", "recent_deviation")


def _table(s, d):
    return tables.materialize(pipelines.feature_table(built(s, d), S, only=_COLUMNS).select(*_KEY, "split", "actual_duration_sec", *_COLUMNS), "table")


def _fitted(s, d):
    rows = _table(s, d)
    part = lambda name: rows.where(F.col("split") == name)
    return rows, model.fit(part("train"), _COLUMNS, rounds=5, depth=4, bins=32, valid=part("embargo"))


def _trees_on_all(s, d):
    rows, fitted = _fitted(s, d)
    out = model.predict(fitted, rows.where("split = 'validation'"))
    return out.select(*_KEY, "prediction", F.array_join(model.scoring_warnings(F.col("stop_span"), settings=S), ",").alias("warnings"))


def _by_nodes(s, d):
    """The table of nodes scores every row, seen and unseen, as the trees do."""
    rows, fitted = _fitted(s, d)
    rows = rows.withColumn("route_id", F.when(F.col("trip_run") % 3 == 0, F.lit("R9")).when(F.col("trip_run") % 5 == 0, F.lit(None)).otherwise(F.col("route_id")))
    both = model.by_nodes(model.predict(fitted, rows), model.nodes(fitted), model.known_values(fitted), "by_nodes")
    return both.agg(F.count("*").alias("n_rows"), F.count_if(~F.coalesce(F.abs(F.col("by_nodes") - F.col("prediction")) < 1e-6, F.lit(False))).alias("different"))


#: Trees that are deep enough part all combinations of these, so that each has the mean of its training rows.
_FEW = ("route_id", "direction_id")


def _saturated(train):
    return model.fit(train, _FEW, rounds=3, depth=8, loss="squared")


def _scored(s, d):
    rows = split_of(s, d)
    train = rows.where("split = 'train'")
    fitted = _saturated(train)
    seen = rows.where("split = 'validation'").join(train.select(*_FEW).distinct(), list(_FEW), "left_semi")
    return model.by_nodes(seen, model.nodes(fitted), model.known_values(fitted)).select(*_KEY, r("prediction"))


def _compared_with_model(s, d):
    """A saved and loaded segment model beside sums of medians, over validation journeys."""
    rows = dated(s, d)
    blocks = tables.materialize(journeys.with_blocks(rows, S), "blocks")
    parts = split.split_journeys(journeys.build_journeys(blocks, S), S)
    train = split.outside_blocks(blocks, parts.where("split = 'validation'"))
    path = f"{tables.shared_folder(s)}/model-{uuid.uuid4().hex}"
    model.save(model.calibrate(_saturated(train), train), s, path)
    found = pipelines.compared(rows, [], S, model.load(s, path))
    return found.select("n_segments", "n", *[r(f"summed{c}_{m}") for c in ("", "_prediction", "_calibrated") for m in ("mae", "bias")])


def _saved(s, d):
    """A saved and loaded model scores every row as the fitted one does."""
    rows, fitted = _fitted(s, d)
    fitted = model.calibrate(fitted, rows.where("split = 'train'"))
    path = f"{tables.shared_folder(s)}/model-{uuid.uuid4().hex}"
    model.save(fitted, s, path)
    valid = rows.where("split = 'validation'")
    score = lambda m, name: model.predict_calibrated(m, valid).select(*_KEY, F.col("calibrated").alias(name))
    both = score(fitted, "a").join(score(model.load(s, path), "b"), _KEY)
    return both.agg(F.count("*").alias("n_rows"), F.count_if(~F.col("a").eqNullSafe(F.col("b"))).alias("different"))


add("model_saved_and_loaded", _saved, sql("SELECT count(*) AS n_rows, 0::BIGINT AS different FROM split WHERE split = 'validation'", "split"))
add("trees_by_nodes", _by_nodes, sql("SELECT count(*) AS n_rows, 0::BIGINT AS different FROM split", "split"))
add("trees_on_all_features", _trees_on_all)
add(
    "trees_scored",
    _scored,
    sql(f"SELECT {_K}, round(p, 4) AS prediction FROM split JOIN (SELECT route_id, direction_id, avg(dur) AS p FROM split WHERE split = 'train' GROUP BY ALL) USING (route_id, direction_id) WHERE split = 'validation'", "split"),
)
_SUMS = ", ".join(f"round(avg(abs(dur - {c}))::DOUBLE, 4) AS summed{n}_mae, round(avg(dur - {c})::DOUBLE, 4) AS summed{n}_bias" for n, c in (("", "pred"), ("_prediction", "p"), ("_calibrated", "p")))
add(
    "journeys_compared_with_model",
    _compared_with_model,
    sql("", "hscored", "tside").rstrip() + f""", means AS (SELECT route_id, direction_id, avg(dur) AS p FROM tside GROUP BY ALL),
  own AS (SELECT h.*, p FROM hscored h JOIN means m ON h.route_id IS NOT DISTINCT FROM m.route_id AND h.direction_id IS NOT DISTINCT FROM m.direction_id),
  sums AS (SELECT n::INT AS n_segments, sum(b.dur) AS dur, sum(b.pred) AS pred, sum(b.p) AS p FROM own a, (SELECT unnest([1, 2, 3, 4]) AS n) l
    JOIN own b ON b.service_date = a.service_date AND b.trip_id = a.trip_id AND b.trip_run = a.trip_run AND b.block_no = a.block_no AND b.place >= a.place AND b.place < a.place + n
    GROUP BY a.service_date, a.trip_id, a.trip_run, a.block_no, a.place, n HAVING count(*) = n)
SELECT n_segments, count(*) AS n, {_SUMS} FROM sums GROUP BY 1""",
)
_GAIN = ("route_id", "direction_id", "local_hour", "local_dow", "from_stop_id")
add(
    "importance_shares",
    lambda s, d: evaluate.importance(evaluate.group_gains(dated(s, d), _GAIN), 4).select("feature", r("gain", digits=2), r("share", digits=6)),
    sql("", "feat").rstrip() + ", p AS (" + " UNION ALL ".join(f"SELECT '{c}' AS feature, {{}} AS value, dur FROM feat".format({"local_dow": "dow::VARCHAR"}.get(c, f"{c}::VARCHAR")) for c in _GAIN) + """),
  q AS (SELECT feature, count(*) AS n, sum(dur)::DOUBLE AS s FROM p GROUP BY feature, value),
  g AS (SELECT feature, (sum(s * s / n) - sum(s) * sum(s) / sum(n)) / sum(n) AS gain FROM q GROUP BY feature)
SELECT feature, round(gain, 2) AS gain, round(gain / (SELECT sum(gain) FROM g), 6) AS share FROM g ORDER BY g.gain DESC, feature LIMIT 4""",
)
add("trees_importance", lambda s, d: evaluate.importance(model.gains(_fitted(s, d)[1])))
add(
    "scoring_warnings",
    lambda s, d: features.recent_conditions(kept(s, d), S).select(*_KEY, F.array_join(model.scoring_warnings(F.col("trip_run") + 12, settings=S), ",").alias("warnings")),
    sql(
        (
            f"SELECT {_K}, concat_ws(',', CASE WHEN trip_run + 12 > 17 THEN 'beyond_training' END, CASE WHEN NOT coalesce(age <= 604800, false) "
            f"OR roll_deviation IS NULL THEN 'no_recent_conditions' END) AS warnings FROM recent"
        ),
        "recent",
    ),
)
