"""Categories as numbers, fitted on training rows only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tramloom.config import SEGMENT_KEY, TRIP_KEY
from tramloom.sources.tables import materialize

#: What a model must never see: keys of the label's side and measurements of it. Fixed names of the data model.
LABEL_SIDE = ("actual_duration_sec", "actual_arrival_ts", "delay_sec", "arrival_source", "arrival_bracket_sec", "arrival_confident", "duration_plausible", "observed_at_utc")
CATEGORIES = ("route_id", "direction_id", "mode", "segment_id", "from_station", "to_station", "fare_period")


def feature_columns(rows: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Columns a model may see, in the table's order. Stop ids are keys of a row; segment and station tell a model of places."""
    hidden = {*TRIP_KEY, *SEGMENT_KEY, *LABEL_SIDE, *exclude, "actual_departure_ts", "split", "block_no"}
    return [c for c in rows.columns if c not in hidden]


def categorical_columns(rows: DataFrame, columns: Sequence[str], declared: Sequence[str] = CATEGORIES) -> list[str]:
    """Those declared, and whatever is not a number."""
    numbers = ("byte", "short", "integer", "long", "float", "double", "boolean")
    return [c for c in columns if c in declared or rows.schema[c].dataType.typeName() not in numbers]


def fit_codes(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, code): codes count the distinct values of each column in order, from 0; nulls have none. Written once."""
    long = train.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])).alias("p")).select("p.*")
    known = long.where("value is not null").distinct()
    return materialize(known.withColumn("code", F.dense_rank().over(Window.partitionBy("column").orderBy("value")) - 1), "codes")


def encode(rows: DataFrame, codes: DataFrame, columns: Sequence[str], prefix: str = "", few: int = 100_000) -> DataFrame:
    """Columns replaced (or, with a prefix, joined) by their codes; -1 for null and for what training never saw.

    Up to ``few`` codes in all are broadcast, so that a column's commonest value is no hot key; more are joined by shuffle.
    """
    hint = F.broadcast if codes.limit(few + 1).count() <= few else lambda df: df
    for c in columns:
        own = codes.where(F.col("column") == c).select(F.col("value").alias("__v"), F.col("code").alias("__c"))
        rows = rows.join(hint(own), F.col(c).cast("string") == F.col("__v"), "left").withColumn(prefix + c, F.coalesce("__c", F.lit(-1))).drop("__v", "__c")
    return rows


def unseen_rate(rows: DataFrame, codes: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Percentage of each column's rows whose value has no code."""
    long = rows.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])).alias("p")).select("p.*")
    each = long.groupBy("column", "value").agg(F.count("*").alias("n")).join(codes, ["column", "value"], "left")  # distinct values alone meet codes
    return each.groupBy("column").agg((100 * (F.sum(F.when(F.col("code").isNull(), F.col("n")).otherwise(0)) / F.sum("n"))).alias("unseen_pct"))


def matrix(rows: DataFrame, codes: DataFrame | None, columns: Sequence[str], categories: Sequence[str], prefix: str = "") -> DataFrame:
    """Columns in the stated order with categories encoded (or, with a prefix, rows joined by them); a missing column is an error."""
    if missing := [c for c in columns if c not in rows.columns]:
        raise ValueError(f"columns are missing: {', '.join(missing)}")
    coded = encode(rows, codes, categories, prefix) if categories else rows
    if not prefix:
        return coded.select(*columns)
    return coded.select(*[c for c in coded.columns if not (c.startswith(prefix) and c[len(prefix) :] in columns)], *[F.col(prefix + c if c in categories else c).alias(prefix + c) for c in columns])
