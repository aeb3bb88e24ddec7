"""Baselines that a model has to beat, and how well anything predicts."""

from __future__ import annotations

import functools
import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tramloom.config import DEFAULT, SEGMENT_KEY, Settings
from tramloom.functions.quantiles import quantiles
from tramloom.sources.tables import materialize

TARGET = "actual_duration_sec"


def scores(rows: DataFrame, predictions: Mapping[str, tuple[Column, bool]], target: str = TARGET) -> DataFrame:
    """One row for each named (prediction, in_sample): mean and median absolute error, root mean squared error, and the
    share of rows with a prediction. All come from one aggregate; medians are selected exactly, in rounds."""
    names = list(predictions)
    used = materialize(rows.select(F.col(target).cast("double").alias("truth"), *[p.cast("double").alias(f"p{i}") for i, (p, _) in enumerate(predictions.values())]), "scored")
    error = [F.col("truth") - F.col(f"p{i}") for i in range(len(names))]
    middle = quantiles(used, {f"e{i}": (F.abs(e), (0.5,)) for i, e in enumerate(error)})
    each = [
        F.struct(
            F.lit(name).alias("baseline"), F.count("*").alias("n_rows"), F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"), F.lit(middle[f"e{i}"][0]).cast("double").alias("median_abs"),
            F.avg(e.isNotNull().cast("double")).alias("coverage"), F.lit(predictions[name][1]).alias("in_sample"),
        ).alias(f"s{i}")
        for i, (name, e) in enumerate(zip(names, error, strict=True))
    ]
    return used.agg(*each).select(F.explode(F.array(*[f"s{i}" for i in range(len(names))])).alias("s")).select("s.*")


def score(rows: DataFrame, name: str, prediction: Column, in_sample: bool, target: str = TARGET) -> DataFrame:
    """The one row of a single prediction."""
    return scores(rows, {name: (prediction, in_sample)}, target)


def _median_of(rows: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """rows with the median target of their keys. Keys are null-safe; targets are whole seconds, so a median's buffer is small."""
    medians = rows.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(F.percentile(TARGET, F.lit(0.5)).alias(name))
    same = functools.reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys))
    return rows.join(medians, same, "left").drop(*[f"__{k}" for k in keys])


def schedule_baseline(rows: DataFrame) -> DataFrame:
    return score(rows, "schedule", F.col("scheduled_duration_sec"), False)


def segment_median_baseline(rows: DataFrame) -> DataFrame:
    return score(_median_of(rows, SEGMENT_KEY, "__m"), "segment_median", F.col("__m"), True)


def segment_hour_median_baseline(rows: DataFrame) -> DataFrame:
    """rows need local_hour."""
    return score(_median_of(rows, (*SEGMENT_KEY, "local_hour"), "__m"), "segment_hour_median", F.col("__m"), True)


def suite(rows: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """All baselines, each with its distance from the noise floor and whether it is the best."""
    rows = materialize(rows.select(*SEGMENT_KEY, "local_hour", TARGET, "scheduled_duration_sec", "arrival_bracket_sec"), "suite")
    both = _median_of(_median_of(rows, SEGMENT_KEY, "__segment"), (*SEGMENT_KEY, "local_hour"), "__hour")
    every = scores(both, {"schedule": (F.col("scheduled_duration_sec"), False), "segment_median": (F.col("__segment"), True), "segment_hour_median": (F.col("__hour"), True)})
    floor = noise_floor(rows).select("floor_sec")
    every = every.join(F.broadcast(floor))  # one row
    least = F.min("mae").over(Window.partitionBy())  # of three rows
    return every.withColumn("best", F.col("mae") == least).withColumn("over_floor_sec", F.col("mae") - F.col("floor_sec"))


def noise_floor(rows: DataFrame) -> DataFrame:
    """The mean error that timing alone causes: half the median bracket at either end, as an error's mean size."""
    found = quantiles(rows, {"bracket": (F.col("arrival_bracket_sec"), (0.5,)), "duration": (F.col(TARGET), (0.5,))})
    half = F.col("bracket") / 2
    one = rows.sparkSession.range(1).select(F.lit(found["bracket"][0]).cast("double").alias("bracket"), F.lit(found["duration"][0]).cast("double").alias("median_duration"))
    return one.select("bracket", "median_duration", half.alias("half_bracket"), (half * math.sqrt(2) * 0.8).alias("floor_sec"))


BUCKETS = ((0, 90), (90, 150), (150, 240), (240, 10_000))


def residual_homogeneity(rows: DataFrame, buckets=BUCKETS) -> DataFrame:
    """Spread of actual less scheduled durations by scheduled duration, in right-closed buckets; what lies outside is left out."""
    s = F.col("scheduled_duration_sec")
    bucket = functools.reduce(lambda c, b: c.when((s > b[0]) & (s <= b[1]), F.lit(f"({b[0]}, {b[1]}]")), buckets[1:], F.when((s > buckets[0][0]) & (s <= buckets[0][1]), F.lit(f"({buckets[0][0]}, {buckets[0][1]}]")))
    known = rows.select(bucket.alias("bucket"), (F.col(TARGET) - s).alias("r"), s.alias("s")).where("bucket is not null")
    out = known.groupBy("bucket").agg(F.count("*").alias("n"), F.stddev_samp("r").alias("residual_sd"), F.percentile("s", F.lit(0.5)).alias("median_sec"))
    return out.withColumn("relative_sd_pct", F.bround(100 * F.col("residual_sd") / F.col("median_sec"), 1))


def fitted_medians(train: DataFrame, keys: tuple[str, ...] = SEGMENT_KEY) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Medians by segment and hour, by segment, and overall (one row)."""
    median = F.percentile(TARGET, F.lit(0.5))
    return train.groupBy(*keys, "local_hour").agg(median.alias("by_hour")), train.groupBy(*keys).agg(median.alias("by_segment")), train.agg(median.alias("overall"))


def apply_medians(rows: DataFrame, fitted: tuple[DataFrame, DataFrame, DataFrame], keys: tuple[str, ...] = SEGMENT_KEY, name: str = "median_prediction") -> DataFrame:
    """The median of segment and hour, else of the segment, else of all."""
    by_hour, by_segment, overall = fitted
    rows = rows.join(by_hour, [*keys, "local_hour"], "left").join(by_segment, list(keys), "left").join(F.broadcast(overall))
    return rows.withColumn(name, F.coalesce("by_hour", "by_segment", "overall")).drop("by_hour", "by_segment", "overall")


def residual_offset(rows: DataFrame, prediction: str, target: str = TARGET) -> DataFrame:
    """One row: the mean by which the target exceeds the prediction."""
    return rows.agg(F.avg(F.col(target) - F.col(prediction)).alias("offset"))


def calibrated(rows: DataFrame, prediction: str, offset: DataFrame, name: str = "calibrated") -> DataFrame:
    return rows.join(F.broadcast(offset)).withColumn(name, F.col(prediction) + F.col("offset")).drop("offset")
