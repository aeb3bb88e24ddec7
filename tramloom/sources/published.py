"""Tables that change as a whole: every publication is a folder of its own and one manifest that makes it the table.

    path/data/commit=<id>/service_date=<date>/...    what one publication wrote
    path/manifest/<one file each>                    version, parent, commit, and for every date the commit that holds it

A manifest is one file, which appears at once when its writer's job commits. Until then readers see the table of before,
whole; afterwards the new one, whole. A publication that dies leaves a folder that no manifest names. A version names
all dates, so a reader takes a snapshot, and older ones stay readable until they are cleared away.

Two writers that begin from one version both write the next; the one with the larger commit is that version, and the
other finds so and puts its dates on top of it. Needs nothing of the store but that a finished file appears whole.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

MANIFEST = "version long, parent long, commit string, part string, holder string"


def manifests(spark: SparkSession, path: str) -> DataFrame:
    """All versions: a head row (no holder) for each, and a row for each date with the commit that holds it."""
    try:
        return spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)


def _newest(spark: SparkSession, path: str, version: int | None = None) -> tuple[int, str]:
    rows = manifests(spark, path).where("holder is null")
    rows = rows if version is None else rows.where(F.col("version") == version)
    found = rows.agg(F.max(F.struct("version", "commit")).alias("h")).first()["h"]
    if found is None and version is not None:
        raise ValueError(f"there is no version {version} of {path}")
    return (found["version"], found["commit"]) if found else (0, "")


def holders(spark: SparkSession, path: str, version: int | None = None) -> dict[str | None, str]:
    """Of each date (None: of a table without) the commit that holds it, in the newest version or the one given."""
    number, commit = _newest(spark, path, version)
    rows = manifests(spark, path).where((F.col("version") == number) & (F.col("commit") == commit) & F.col("holder").isNotNull())
    return {r["part"]: r["holder"] for r in rows.select("part", "holder").collect()}


def _announce(spark: SparkSession, path: str, commit: str, written: Sequence[str | None], dates: Sequence[str | None] | None) -> int:
    """Make what a commit wrote part of the table; returns the version."""
    while True:
        parent, before = _newest(spark, path)
        held = {} if not before else {part: holder for part, holder in holders(spark, path, parent).items() if dates is not None and part not in dates}
        held |= dict.fromkeys(written, commit)
        rows = [(parent + 1, parent, commit, None, None), *[(parent + 1, parent, commit, part, holder) for part, holder in held.items()]]
        spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").parquet(f"{path}/manifest")
        if _newest(spark, path, parent + 1)[1] == commit:
            return parent + 1


def publish(df: DataFrame, path: str, dates: Sequence[str] | None = None, by: str | None = "service_date", measures: Mapping[str, Column] | None = None) -> dict[str, Any]:
    """Replace the given dates (by default the whole table) by the rows of df; of a date without rows nothing stays.

    Returns the version and the measures: aggregates over what was written, taken in the job that wrote it. They are
    observed behind the shuffle that gathers a date's rows, so that a map task that runs twice doesn't count twice.
    """
    spark, commit, seen = df.sparkSession, uuid.uuid4().hex, Observation(f"published-{uuid.uuid4().hex}")
    rows = df if dates is None or by is None else df.where(F.col(by).isin(list(dates)))
    rows = rows.hint("rebalance", *[F.col(by)] if by else [])
    parts = {"parts": F.collect_set(by)} if by else {}
    rows = rows.observe(seen, *[c.alias(name) for name, c in ({"n": F.count("*")} | parts | dict(measures or {})).items()])
    writer = rows.write.partitionBy(by) if by else rows.write
    writer.parquet(f"{path}/data/commit={commit}")
    found = seen.get
    written = found.pop("parts") if by else [None]
    return {"version": _announce(spark, path, commit, written, dates if by else None), **found}


def read(spark: SparkSession, path: str, schema: StructType, dates: Sequence[str] | None = None, version: int | None = None, by: str | None = "service_date") -> DataFrame:
    """A snapshot of the table, or of some of its dates, whose folders alone are listed."""
    held = {part: holder for part, holder in holders(spark, path, version).items() if dates is None or part in dates}
    folders = [f"{path}/data/commit={holder}" + (f"/{by}={part}" if by else "") for part, holder in sorted(held.items(), key=str)]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{path}/data").parquet(*folders).select(*schema.names)


def clear_old(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete what only versions before the last ``keep`` hold, and what dead publications left; returns the commits.

    Not to be run beside a publication, whose folder no manifest names yet.
    """
    rows = manifests(spark, path)
    newest = rows.agg(F.max("version")).first()[0] or 0
    kept = {r[0] for r in rows.where((F.col("version") > newest - keep) & F.col("holder").isNotNull()).select("holder").distinct().collect()}
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/data")
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    gone = [s.getPath() for s in files.listStatus(folder) if s.getPath().getName().removeprefix("commit=") not in kept]
    for p in gone:
        files.delete(p, True)
    return sorted(p.getName().removeprefix("commit=") for p in gone)
