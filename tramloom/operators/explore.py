"""What a feed holds: fields set, values, delays of reports, and whether arrivals can be derived from it."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tramloom.functions import exprs as X


def field_census(rows: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """field, how often it is set, and the share; one pass."""
    columns = list(columns or rows.columns)
    one = rows.agg(F.count("*").alias("__n"), *[F.count(c).alias(c) for c in columns])
    return one.select("__n", F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("n_set")) for c in columns])).alias("f")).select("f.*", X.safe_share(F.col("f.n_set"), F.col("__n")).alias("share"))


def value_counts(rows: DataFrame, column: str, k: int | None = None) -> DataFrame:
    """value (null included), its count and share, most frequent first; the first k if asked for."""
    counted = rows.groupBy(F.col(column).cast("string").alias("value")).agg(F.count("*").alias("n"))
    total = counted.agg(F.sum("n").alias("__total"))
    out = counted.join(F.broadcast(total)).select("value", "n", X.safe_share(F.col("n"), F.col("__total")).alias("share"))
    return out if k is None else out.orderBy(F.desc("n"), "value").limit(k)


def report_age(vehicles: DataFrame) -> DataFrame:
    """One row: how old reports are at capture."""
    age = F.unix_seconds("captured_at") - F.unix_seconds("vehicle_ts")
    q = F.percentile(age, F.array(F.lit(0.5), F.lit(0.95)))
    return vehicles.agg(F.count(age).alias("n"), q.alias("q"), F.max(age).alias("longest")).select("n", F.col("q")[0].alias("median"), F.col("q")[1].alias("p95"), "longest")


def prediction_availability(updates: DataFrame) -> DataFrame:
    """By stop sequence: rows, and how many have an arrival, a departure, both or neither."""
    a, d = F.col("arrival_ts").isNotNull(), F.col("departure_ts").isNotNull()
    return updates.groupBy("stop_sequence").agg(F.count("*").alias("n"), X.count_where(a).alias("with_arrival"), X.count_where(d).alias("with_departure"), X.count_where(a & d).alias("with_both"), X.count_where(~a & ~d).alias("with_neither"))


def prediction_profile(updates: DataFrame, k: int = 8) -> DataFrame:
    """(measure, value, n, share): schedule relationships, and the k most frequent uncertainties and stop sequences with a departure.

    A feed without a column of that name has no rows of its measure.
    """
    kinds = (("relationship", "relationship", "true", None), ("uncertainty", "uncertainty", "uncertainty is not null", k), ("departs_at", "stop_sequence", "departure_ts is not null", k))
    parts = [value_counts(updates.where(where), column, most).select(F.lit(name).alias("measure"), "value", "n", "share") for name, column, where, most in kinds if column in updates.columns]
    return functools.reduce(DataFrame.unionByName, parts)


def jump_histogram(arrivals: DataFrame) -> DataFrame:
    """How many stops lie between successive sightings, and the brackets of each."""
    q = F.percentile("arrival_bracket_sec", F.lit(0.5))
    return arrivals.groupBy("sequence_jump").agg(F.count("*").alias("n"), q.alias("median_bracket"), F.max("arrival_bracket_sec").alias("longest_bracket"))


def viability(arrivals: DataFrame, within_sec: int) -> DataFrame:
    """One row: arrivals, the share with a bracket within the limit, one-stop advances, and stops passed unseen."""
    return arrivals.agg(F.count("*").alias("arrivals"), F.avg((F.col("arrival_bracket_sec") <= within_sec).cast("double")).alias("within_share"), F.avg((F.col("sequence_jump") == 1).cast("double")).alias("one_stop_share"), F.sum(F.col("sequence_jump") - 1).alias("unseen_stops"), F.percentile("arrival_bracket_sec", F.lit(0.5)).alias("median_bracket"))


def prediction_drift(updates: DataFrame, lifetimes: DataFrame, settled_before_sec: int = 120) -> DataFrame:
    """One row: (trip, stop) pairs no longer seen near the end of the window, and how far their predictions moved."""
    end = updates.agg(F.max(F.unix_seconds("captured_at")).alias("end"))
    rows = lifetimes.join(F.broadcast(end))
    settled = F.unix_seconds("last_seen") < F.col("end") - settled_before_sec
    drift = F.unix_seconds("final_arrival_ts") - F.unix_seconds("first_arrival_ts")
    return rows.agg(F.count("*").alias("pairs"), X.count_where(settled).alias("settled"), F.percentile(F.when(settled, drift), F.lit(0.5)).alias("median_drift"), F.max("observations").alias("most_observations"))


def hour_shortfall(hours: DataFrame) -> DataFrame:
    """Each hour's count and what it lacks."""
    return hours.select("feed", "hour", "n", "status", F.greatest(F.col("expected").cast("long") - F.col("n"), F.lit(0)).alias("shortfall"))


def longest_gaps(rows: DataFrame, k: int = 10, by: Sequence[str] = ("feed",)) -> DataFrame:
    """The k longest silences of each feed (a report of the top k)."""
    line = Window.partitionBy(*by).orderBy("captured_at")
    gaps = rows.select(*by, "captured_at").distinct().withColumn("gap", F.unix_seconds("captured_at") - F.unix_seconds(F.lag("captured_at").over(line))).where("gap is not null")
    return gaps.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("gap"), "captured_at"))).where(F.col("rank") <= k)
