"""Journeys: sums over contiguous segments of a run, and errors of their predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tramloom.config import DEFAULT, TRIP_KEY, Settings
from tramloom.functions import exprs as X

BLOCK_KEY = (*TRIP_KEY, "block_no")


def _line() -> WindowSpec:
    return Window.partitionBy(*TRIP_KEY).orderBy("from_stop_sequence", "stop_sequence")


def with_blocks(rows: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """block_no: a new block begins where a segment does not start where and when the one before it ended.

    The label is (run, number within the run): numbering over all runs would need all rows in one task.
    """
    before = F.lag(F.struct("stop_sequence", (F.unix_seconds("actual_departure_ts") + F.col("actual_duration_sec")).alias("end"))).over(_line())
    joined = (F.abs(F.unix_seconds("actual_departure_ts") - F.col("__b.end")) <= settings.block_tolerance_sec) & (F.col("from_stop_sequence") == F.col("__b.stop_sequence"))
    rows = rows.withColumn("__b", before).withColumn("__new", F.when(F.col("__b").isNotNull() & ~F.coalesce(joined, F.lit(False)), 1).otherwise(0))
    return rows.withColumn("block_no", F.sum("__new").over(_line().rowsBetween(Window.unboundedPreceding, 0)).cast("int")).drop("__b", "__new")


def block_diagnostics(blocks: DataFrame) -> DataFrame:
    """One row: segments, runs, blocks, the share of neighbouring segments that join, and the median block length."""
    per_block = blocks.groupBy(*BLOCK_KEY).agg(F.count("*").alias("n"))
    per_run = per_block.groupBy(*TRIP_KEY).agg(F.count("*").alias("b"), F.sum("n").alias("n"))
    one = per_run.agg(F.sum("n").alias("n_segments"), F.count("*").alias("runs"), F.sum("b").alias("blocks"), F.sum(F.col("n") - 1).alias("pairs"), F.sum(F.col("b") - 1).alias("broken"))
    middle = per_block.agg(F.percentile("n", F.lit(0.5)).alias("median_block"))
    return one.join(F.broadcast(middle)).withColumn("contiguous_pct", 100 - 100 * F.col("broken") / F.nullif("pairs", F.lit(0)))


def window_sums(blocks: DataFrame, columns: Sequence[str], lengths: Sequence[int], carry: Sequence[str] = (), ahead: Sequence[str] = ()) -> DataFrame:
    """From each segment on, sums of columns over the next n of its block, one row for each n that the block has room for.

    carry is taken from the first segment; ahead from the last, with the prefix last_. All lengths come from one
    pass over one sort.
    """
    line = Window.partitionBy(*BLOCK_KEY).orderBy("from_stop_sequence", "stop_sequence")
    pieces = []
    for n in lengths:
        frame = line.rowsBetween(0, n - 1)
        sums = [F.sum(c).over(frame).alias(f"sum_{c}") for c in columns]
        lasts = [F.lead(c, n - 1).over(line).alias(f"last_{c}") for c in ahead]
        pieces.append(F.struct(F.lit(n).alias("n_segments"), F.count("*").over(frame).alias("held"), *sums, *lasts).alias(f"__w{n}"))
    rows = blocks.select(*BLOCK_KEY, *[c for c in carry if c not in BLOCK_KEY], *pieces)
    rows = rows.select(*[c for c in rows.columns if not c.startswith("__w")], F.explode(F.array(*[f"__w{n}" for n in lengths])).alias("w")).where("w.held = w.n_segments")
    return rows.select(*[c for c in rows.columns if c != "w"], "w.n_segments", *[f"w.sum_{c}" for c in columns], *[f"w.last_{c}" for c in ahead])


def build_journeys(rows: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Every run of 1 to n contiguous segments: origin, destination and summed durations."""
    blocks = rows if "block_no" in rows.columns else with_blocks(rows, settings)
    summed = window_sums(blocks, ("actual_duration_sec", "scheduled_duration_sec", "stop_span"), settings.lengths, ("from_stop_id", "from_stop_sequence", "route_id", "direction_id", "actual_departure_ts"), ("to_stop_id", "stop_sequence"))
    return summed.select(
        *BLOCK_KEY, "n_segments", "route_id", "direction_id", F.col("from_stop_id").alias("origin_stop_id"), F.col("from_stop_sequence").alias("origin_sequence"), F.col("last_to_stop_id").alias("dest_stop_id"), F.col("last_stop_sequence").alias("dest_sequence"),
        X.station_code(F.col("from_stop_id")).alias("origin_station"), X.station_code_or_null(F.col("last_to_stop_id")).alias("dest_station"), "actual_departure_ts", F.col("sum_actual_duration_sec").alias("actual_duration_sec"), F.col("sum_scheduled_duration_sec").alias("scheduled_duration_sec"), F.col("sum_stop_span").alias("stop_span"),
    )


def journey_summary(journeys: DataFrame) -> DataFrame:
    q = F.percentile("actual_duration_sec", F.array(F.lit(0.05), F.lit(0.5), F.lit(0.95)))
    return journeys.groupBy("n_segments").agg(F.count("*").alias("n_rows"), q.alias("q")).select("n_segments", "n_rows", *[F.col("q")[i].alias(n) for i, n in enumerate(("p05", "median", "p95"))])


def journey_errors(blocks: DataFrame, prediction: str, lengths: Sequence[int], target: str = "actual_duration_sec") -> DataFrame:
    """Errors of summed predictions for each number of segments: size, bias, spread, and share of the median."""
    summed = window_sums(blocks.where(F.col(prediction).isNotNull()), (target, prediction), lengths)
    error = F.col(f"sum_{target}").cast("double") - F.col(f"sum_{prediction}")
    out = summed.groupBy("n_segments").agg(F.count("*").alias("n"), F.avg(F.abs(error)).alias("mae"), F.sqrt(F.avg(error * error)).alias("rmse"), F.avg(error).alias("bias"), F.stddev_samp(error).alias("sd"), F.percentile(f"sum_{target}", F.lit(0.5)).alias("median_sec"))
    return out.withColumn("mae_pct", 100 * F.col("mae") / F.col("median_sec"))


def by_length(rows: DataFrame, predictions: Sequence[str], target: str = "actual_duration_sec") -> DataFrame:
    """Mean absolute error, bias and share of the median of several predictions, for each number of segments."""
    aggs = [F.count("*").alias("n"), F.percentile(target, F.lit(0.5)).alias("median_sec")]
    for p in predictions:
        error = F.col(target) - F.col(p)
        aggs += [F.avg(F.abs(error)).alias(f"{p}_mae"), F.avg(error).alias(f"{p}_bias")]
    out = rows.groupBy("n_segments").agg(*aggs)
    for p in predictions:
        out = out.withColumn(f"{p}_pct", 100 * F.col(f"{p}_mae") / F.col("median_sec"))
    return out


def best_by_length(errors: DataFrame, predictions: Sequence[str]) -> DataFrame:
    """The prediction with the least error for each number of segments; of equals the one named first."""
    ranked = F.array_min(F.array(*[F.struct(F.col(f"{p}_mae").alias("mae"), F.lit(i).alias("i"), F.lit(p).alias("name")) for i, p in enumerate(predictions)]))
    return errors.select("n_segments", ranked["name"].alias("best"), ranked["mae"].alias("mae"))


def head_to_head(journeys: DataFrame, segments: DataFrame, columns: str | Sequence[str], predictions: Sequence[str], settings: Settings = DEFAULT) -> DataFrame:
    """Journey predictions and sums of segment predictions over the same windows, joined on run, origin and length.

    The sum of one column is named summed; of more, summed_ and the column's name.
    """
    columns = [columns] if isinstance(columns, str) else list(columns)
    names = {c: "summed" if i == 0 else f"summed_{c}" for i, c in enumerate(columns)}
    blocks = segments if "block_no" in segments.columns else with_blocks(segments, settings)
    summed = window_sums(blocks, columns, settings.lengths, ("from_stop_id",)).withColumnRenamed("from_stop_id", "origin_stop_id")
    keys = [*TRIP_KEY, "origin_stop_id", "n_segments"]
    both = journeys.join(summed.select(*keys, *[F.col(f"sum_{c}").alias(n) for c, n in names.items()]), keys)
    return by_length(both, [*predictions, *names.values()])
