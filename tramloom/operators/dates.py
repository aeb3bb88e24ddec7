"""Service dates: which a window covers, which are outstanding, which staged ones can go."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramloom.config import DEFAULT, Settings
from tramloom.functions import exprs as X


def date_spine(spark: SparkSession, first: Column, last: Column) -> DataFrame:
    """service_date (text) of every day from first to last, both included."""
    days = spark.range(1).select(F.explode(F.sequence(first.cast("date"), last.cast("date"), F.expr("interval 1 day"))).alias("d"))
    return days.select(F.date_format("d", "yyyy-MM-dd").alias("service_date"))


def with_bounds(dates: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """day_start and day_end (epoch seconds): a service day lasts from its start to some hours into the next."""
    d = F.col("service_date")
    return dates.withColumn("day_start", X.service_day_start(d, settings.zone)).withColumn("day_end", X.service_day_end(d, settings.zone, settings.overhang_hours))


def fully_covered(dates: DataFrame, start: Column, end: Column, settings: Settings = DEFAULT) -> DataFrame:
    """Dates whose whole service day lies in [start, end], in epoch seconds."""
    return with_bounds(dates, settings).where((F.col("day_start") >= start) & (F.col("day_end") <= end))


def keep_targets(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """Rows of target dates; none if there are none."""
    return rows.join(targets.select("service_date"), "service_date", "left_semi")


def skipped(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """Dates seen that are not targets."""
    return rows.select("service_date").distinct().exceptAll(targets.select("service_date").distinct())


def outstanding(spark: SparkSession, done: DataFrame, now: Column, archive_start: Column | None = None, settings: Settings = DEFAULT, force: bool = False) -> DataFrame:
    """Closed service dates within the lookback, wholly within the archive, that are not done (all, if forced)."""
    today = F.to_date(X.local_time(now, settings.zone))
    spine = with_bounds(date_spine(spark, F.date_sub(today, settings.lookback_days), today), settings).where(F.col("day_end") <= F.unix_seconds(now))
    if archive_start is not None:
        spine = spine.where(F.col("day_start") >= F.unix_seconds(archive_start))
    dates = spine.select("service_date")
    return dates if force else dates.join(done.select("service_date").distinct(), "service_date", "left_anti")


def prunable(staged: DataFrame, now: Column, settings: Settings = DEFAULT) -> DataFrame:
    """Staged dates past their retention; none if retention is off."""
    keep = settings.staging_retention_days
    oldest = F.date_format(F.date_sub(F.to_date(X.local_time(now, settings.zone)), keep), "yyyy-MM-dd")
    return staged.select("service_date").distinct().where((F.col("service_date") < oldest) & F.lit(keep > 0))
