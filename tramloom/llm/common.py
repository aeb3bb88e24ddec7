"""Helpers that the corpus operators share: the shared folder, written tables, words, row keys."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word, wherever a contract does not say otherwise: a run without space, tab, LF, VT, FF, CR.
WORD = r"[^\x20\x09-\x0D]+"
#: Columns that operators add for their own use; no table column may start so.
OWN = "__tl_"
#: Rows and bytes that may be broadcast; beyond either the join is left to a shuffle.
BROADCAST_ROWS, BROADCAST_BYTES = 100_000, 8_000_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``. Only a local session may do without it."""
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not found:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tramloom-"))
        found = sc.getCheckpointDir()
    return found.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet into the shared folder and read it back: lineage ends there and survives a lost executor."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Delete a table that materialize wrote and that nothing reads any more."""
    spark = df.sparkSession
    own = shared_dir(spark).split("://")[-1]
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if own in folder:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def col(name: str) -> Column:
    """A column by its plain name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def without(docs: DataFrame, *own: str) -> DataFrame:
    """docs without columns named like an operator's own outputs, in either case: those take their place."""
    taken = {c.lower() for c in own}
    if bad := [c for c in docs.columns if c.lower().startswith(OWN)]:
        raise ValueError(f"columns named {OWN}... are reserved: {bad}")
    return docs.select(*[col(c) for c in docs.columns if c.lower() not in taken])


def small(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """df with a broadcast hint if it has at most ``rows`` rows and ``size`` bytes, else df as it is, for a shuffle join. df should be materialized."""
    n, held = df.select(F.octet_length(F.to_json(F.struct(*map(col, df.columns)))).alias("b")).agg(F.count("*"), F.sum("b")).first()
    return F.broadcast(df) if n <= rows and (held or 0) <= size else df


def spread_join(left: DataFrame, right: DataFrame, keys: str | Sequence[str], n: str, how: str = "inner", by: Sequence[str] = (), sizes: DataFrame | None = None, total: int | None = None) -> DataFrame:
    """left joined with right (by key, with the number of left's rows of the key in ``n``), no task getting a hot key whole.

    A key with over twice the rows of an average partition is dealt into parts, and its row of right goes to each of
    them. Such keys are fewer than half the partitions, so their broadcast is bounded. Rows of left are dealt by a hash
    of the columns ``by``; without any, by their place in the files that left must then be read from. The numbers of
    rows are taken from ``sizes`` (keys, n) where right itself is not written yet and has no such column; their sum is
    counted at once unless ``total`` says about how many there are.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    counted = (right if sizes is None else sizes).select(*keys, n)
    total = (counted.agg(F.sum(n)).first()[0] or 0) if total is None else total
    if total <= 1024 or left.sparkSession.conf.get("spark.sql.shuffle.partitions") == "1":
        return left.join(right.drop(n), keys, how)
    room = max(1024, 2 * total // int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    hot = F.broadcast(counted.where(F.col(n) > room).select(*keys, F.ceil(F.col(n) / F.lit(room)).cast("int").alias(f"{OWN}parts")).distinct())
    deal = F.xxhash64(*by) if by else F.monotonically_increasing_id()
    left = left.join(hot, keys, "left").withColumn(f"{OWN}part", F.pmod(deal, F.coalesce(f"{OWN}parts", F.lit(1))).cast("int")).drop(f"{OWN}parts")
    right = right.drop(n).join(hot, keys, "left").withColumn(f"{OWN}part", F.explode(F.sequence(F.lit(0), F.coalesce(f"{OWN}parts", F.lit(1)) - 1))).drop(f"{OWN}parts")
    return left.join(right, [*keys, f"{OWN}part"], how).drop(f"{OWN}part")


def n_words(text: Column | str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def text_hash(text: Column | str) -> Column:
    """With the id, the key by which a row finds its own decisions again; rows alike in both get like decisions."""
    return F.xxhash64(text)


def binary(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """The texts of a batch in UTF-8; null becomes empty."""
    return [x or b"" for x in batch.column(name).cast(pa.binary()).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``, which bounds what a task holds."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def map_rows(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], names: Sequence[str], added: dict[str, str]) -> DataFrame:
    """mapInArrow that gives the columns ``names`` of df and ``added`` (name to type), whatever characters names have."""
    every, result = df.columns, [*names, *added]
    plain = df.toDF(*[f"c{i}" for i in range(len(every))])
    shape = plain.select(*[f"c{every.index(c)}" for c in names]).schema
    for i, kind in enumerate(added.values()):
        shape = shape.add(f"a{i}", kind)

    def inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in run(b.rename_columns(every) for b in batches):
            yield b.rename_columns(shape.names)

    return plain.mapInArrow(inner, shape).toDF(*result)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: Sequence[str], room: int) -> Iterator[pa.Table]:
    """Tables of whole groups of a partition sorted by ``keys``, about ``room`` rows at a time."""
    held, rows, wait = [], 0, room
    for b in batches:
        held += [b] if b.num_rows else []
        rows += b.num_rows
        if rows < wait:
            continue
        table = pa.Table.from_batches(held)
        last = np.logical_and.reduce([(x := table[k].to_numpy()) == x[-1] for k in keys])
        cut = 0 if last.all() else rows - int(np.argmin(last[::-1]))
        wait = room if cut else 2 * rows  # one group so far
        if cut:
            yield table.slice(0, cut)
            held, rows = table.slice(cut).to_batches(), rows - cut
    if rows:
        yield pa.Table.from_batches(held)


def mix64(x: np.ndarray) -> np.ndarray:
    """The SplitMix64 finaliser: spreads uint64 values evenly."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))
