"""Writers that replace only their own partitions, readers that prune, and the layout and checks of archives."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Sequence
from datetime import datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tramloom.functions import exprs as X

#: What a bundle of static tables must hold. Fixed names of the public timetable format.
REQUIRED_MEMBERS = ("feed_info.txt", "routes.txt", "stop_times.txt", "stops.txt", "trips.txt")


def write_partitions(df: DataFrame, path: str, by: Sequence[str] = ("service_date",)) -> None:
    """Replace the partitions that df has rows for; all others stay. A rerun gives the same table.

    Rows are rebalanced by partition: small ones become one file, and adaptive execution splits large ones by size.
    """
    df.hint("rebalance", *[F.col(c) for c in by]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """df written into the folder that driver and executors share, and read back: for what a plan reads more than once."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``. Only a local session may do without it."""
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not found:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tramloom-"))
        found = sc.getCheckpointDir()
    return found.rstrip("/")


def write_window(observations: DataFrame, path: str, start: Column, end: Column) -> None:
    """Replace what an earlier run for the same window wrote, and nothing of neighbouring windows on the same date."""
    write_partitions(observations.withColumn("window_id", X.window_id(start, end)), path, ("service_date", "window_id"))


def read_partitions(spark: SparkSession, path: str, schema, dates: Sequence[str] | None = None) -> DataFrame:
    """The table, or some of its service dates, which prunes partitions. The stated schema keeps dates as text."""
    rows = spark.read.schema(schema).parquet(path)
    return rows if dates is None else rows.where(F.col("service_date").isin(list(dates)))


def between_dates(rows: DataFrame, first: str, last: str) -> DataFrame:
    """Both ends included."""
    return rows.where(F.col("service_date").between(first, last))


def completed_dates(rows: DataFrame) -> DataFrame:
    return rows.select("service_date").distinct()


def fingerprint(rows: DataFrame) -> DataFrame:
    """Row count and a hash that does not depend on order, to hold a written table against what was written."""
    return rows.agg(F.count("*").alias("n_rows"), F.sum(F.xxhash64(*sorted(rows.columns)).cast("decimal(38,0)")).cast("string").alias("hash"))


def read_static_table(spark: SparkSession, path: str) -> DataFrame:
    """A member of a static bundle; all columns are text. An empty field is the empty text whether quoted or not, as the
    public format knows no null; a row that ends early has empty fields too."""
    return spark.read.csv(path, header=True, inferSchema=False, mode="PERMISSIVE", escape='"', nullValue="\u0000", emptyValue="").na.fill("")


#: The folders of an archive. Fixed names of its layout.
ARCHIVE = ("feed", "year", "month", "day", "hour")


def archive_columns(captured_at: Column) -> list[Column]:
    """year, month, day and hour in UTC, by which raw snapshots are partitioned."""
    return [F.date_format(captured_at, form).alias(name) for name, form in (("year", "yyyy"), ("month", "MM"), ("day", "dd"), ("hour", "HH"))]


def archive_path(feed: Column, captured_at: Column) -> Column:
    stamp = F.struct(*archive_columns(captured_at))
    return F.concat_ws("/", feed, *[F.concat(F.lit(f"{c}="), stamp[c]) for c in ARCHIVE[1:]])


def write_archive(snapshots: DataFrame, path: str, feed: str, captured_at: str = "captured_at") -> None:
    """Add raw snapshots of a feed to its archive, by the hour of their capture; what is there stays."""
    stamp = F.struct(*archive_columns(F.col(captured_at)))
    rows = snapshots.withColumn("feed", F.lit(feed)).select("*", *[stamp[c].alias(c) for c in ARCHIVE[1:]])
    rows.hint("rebalance", *[F.col(c) for c in ARCHIVE]).write.mode("append").partitionBy(*ARCHIVE).parquet(path)


def read_archive(spark: SparkSession, path: str, schema: StructType, feed: str, start: datetime, end: datetime, captured_at: str = "captured_at") -> DataFrame:
    """Snapshots captured within [start, end): only the folders of the days that it touches are listed, only its hours read."""
    first, last = (t.astimezone(timezone.utc) if t.tzinfo else t.replace(tzinfo=timezone.utc) for t in (start, end))
    days = [first + timedelta(days=i) for i in range((last.date() - first.date()).days + 1)]
    wanted = "{" + ",".join(f"year={d:%Y}/month={d:%m}/day={d:%d}" for d in days) + "}"
    shape = StructType([f for f in schema if f.name not in ARCHIVE])
    try:
        rows = spark.read.schema(StructType([*shape, *[StructField(c, StringType()) for c in ARCHIVE]])).option("basePath", path).parquet(f"{path}/feed={feed}/{wanted}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], shape)
    hour = F.concat(*ARCHIVE[1:])
    within = (F.col(captured_at) >= F.lit(first)) & (F.col(captured_at) < F.lit(last))
    return rows.where((hour >= f"{first:%Y%m%d%H}") & (hour <= f"{last:%Y%m%d%H}")).where(within).select(*shape.names)


def content_addressed(files: DataFrame, content: str = "content", keys: Sequence[str] = ("mode",)) -> DataFrame:
    """One row for each different content and key, named by its SHA-256: archiving again adds nothing."""
    return files.withColumn("sha256", F.sha2(F.col(content).cast("binary"), 256)).dropDuplicates([*keys, "sha256"])


def bundle_problems(members: DataFrame, info: DataFrame) -> DataFrame:
    """For each bundle of (bundle, member): what it lacks, its window and version, and whether it can be used.

    info has bundle, feed_start_date, feed_end_date and feed_version as text; an empty end is open, an empty version null.
    """
    have = members.groupBy("bundle").agg(F.collect_set("member").alias("have"))
    text = lambda c: F.nullif(F.trim(F.col(c)), F.lit(""))
    rows = have.join(info, "bundle", "left")
    missing = F.array_sort(F.array_except(F.array(*map(F.lit, REQUIRED_MEMBERS)), "have"))
    return rows.select("bundle", missing.alias("missing"), text("feed_start_date").alias("feed_start"), F.coalesce(text("feed_end_date"), F.lit("unknown")).alias("feed_end"), text("feed_version").alias("version"), ((F.size(missing) == 0) & text("feed_start_date").isNotNull()).alias("valid"))
