"""Tables of how predictions compare: by segment, by journey, by bins and groups."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramloom.config import DEFAULT, Settings
from tramloom.functions.quantiles import quantiles
from tramloom.operators import baselines
from tramloom.operators.journeys import journey_errors


def segment_level(rows: DataFrame, predictions: Sequence[str]) -> DataFrame:
    """One row of errors for each prediction column."""
    return baselines.scores(rows, {p: (F.col(p), False) for p in predictions})


def journey_level(blocks: DataFrame, model: str, baseline: str, settings: Settings = DEFAULT) -> DataFrame:
    """Summed errors of model and baseline for each length, what the measurement itself allows, and what is gained."""
    own = journey_errors(blocks, model, settings.lengths).select("n_segments", "n", "median_sec", F.col("mae").alias("model_mae"), F.col("bias").alias("model_bias"))
    other = journey_errors(blocks, baseline, settings.lengths).select("n_segments", F.col("mae").alias("baseline_mae"))
    rows = own.join(other, "n_segments")
    floor = 100 * F.lit(settings.measurement_floor_sec) / F.col("median_sec")
    rows = rows.withColumn("model_pct", 100 * F.col("model_mae") / F.col("median_sec")).withColumn("floor_pct", floor)
    return rows.withColumn("headroom_pct", F.col("model_pct") - F.col("floor_pct")).withColumn("beats_pct", 100 * (1 - F.col("model_mae") / F.nullif("baseline_mae", F.lit(0.0))))


def binned(rows: DataFrame, prediction: str, target: str = "actual_duration_sec", bins: int = 40, least: int = 30) -> DataFrame:
    """Target quartiles within bins of equal share of the prediction; bins with few rows are left out.

    Edges are selected in rounds; targets are whole seconds, so a bin's buffer of distinct values is small.
    """
    found = quantiles(rows, {"p": (F.col(prediction), [i / bins for i in range(1, bins)])})["p"]
    edges = F.array(*[F.lit(e) for e in sorted({e for e in found if e is not None})]).cast("array<double>")
    place = F.when(F.col(prediction).isNotNull(), F.size(F.filter(edges, lambda e: e < F.col(prediction)))).otherwise(0)
    q = F.percentile(target, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    out = rows.withColumn("bin", place).groupBy("bin").agg(F.count("*").alias("n"), F.avg(prediction).alias("mean_prediction"), q.alias("q")).where(F.col("n") >= least)
    return out.select("bin", "n", "mean_prediction", *[F.col("q")[i].alias(n) for i, n in enumerate(("q25", "median", "q75"))])


def error_by_group(rows: DataFrame, group: str, predictions: Sequence[str], target: str = "actual_duration_sec") -> DataFrame:
    return rows.groupBy(group).agg(F.count("*").alias("n"), *[F.avg(F.abs(F.col(target) - F.col(p))).alias(f"{p}_mae") for p in predictions])


def clipped_residuals(rows: DataFrame, prediction: str, target: str = "actual_duration_sec", low: float = 0.005, high: float = 0.995, bins: int = 20) -> DataFrame:
    """Histogram of residuals between two of their quantiles, those beyond counted at the ends; with mean and median of all."""
    r = rows.where(F.col(prediction).isNotNull()).select((F.col(target) - F.col(prediction)).alias("r"))
    first, last, middle = quantiles(r, {"r": (F.col("r"), (low, high, 0.5))})["r"]
    if first is None:
        first = last = middle = math.nan
    mean = r.agg(F.avg("r").alias("mean_residual"))
    x = F.least(F.greatest(F.col("r"), F.lit(first)), F.lit(last)).cast("double")
    bin_of = F.least(F.floor((x - first) / max((last - first) / bins, 1e-9)), F.lit(bins - 1)).cast("int")
    counted = r.groupBy(bin_of.alias("bin")).agg(F.count("*").alias("n"))
    ends = [F.lit(v).cast("double").alias(name) for name, v in (("low", first), ("high", last), ("median_residual", middle))]
    return counted.join(F.broadcast(mean)).select("bin", "n", ends[0], ends[1], "mean_residual", ends[2])  # the mean is one row


def importance(gains: DataFrame, k: int = 20) -> DataFrame:
    """The k features (feature, gain) that count most, with their share of all."""
    total = gains.agg(F.sum("gain").alias("__total"))
    return gains.join(F.broadcast(total)).select("feature", "gain", (F.col("gain") / F.nullif("__total", F.lit(0.0))).alias("share")).orderBy(F.desc("gain"), "feature").limit(k)


def group_gains(rows: DataFrame, columns: Sequence[str], target: str = "actual_duration_sec") -> DataFrame:
    """(feature, gain): by how much each column's groups alone lessen the target's variance."""
    long = rows.where(F.col(target).isNotNull()).select(F.col(target).cast("double").alias("y"), F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in columns])).alias("p")).select("y", "p.*")
    each = long.groupBy("feature", "value").agg(F.count("*").alias("n"), F.sum("y").alias("s"))
    within = each.groupBy("feature").agg(F.sum(F.col("s") * F.col("s") / F.col("n")).alias("q"), F.sum("s").alias("s"), F.sum("n").alias("n"))
    return within.select("feature", ((F.col("q") - F.col("s") * F.col("s") / F.col("n")) / F.col("n")).alias("gain"))
