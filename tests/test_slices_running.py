import random
import time
from statistics import median

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tramloom.functions.running import Fenwick, History, medians_before
from tramloom.functions.slices import carry, slice_of, with_halo
from tramloom.operators import features
from test_features_journeys import frame, seg


def _medians(spark, rows, width):
    df = spark.createDataFrame(rows, "k string, t long, v double").withColumn("s", F.floor(F.col("t") / width).cast("long"))
    return {(r["k"], r["t"]): (r["__median"], r["__place"]) for r in medians_before(df.repartition(3), ["k"], "s", ["t"], "v").collect()}


@pytest.mark.parametrize("width", [1, 7, 50, 10_000])
def test_running_medians_against_brute_force(spark, width):
    rng = random.Random(width)
    rows = [(k, t, None if rng.random() < 0.1 else float(rng.choice([3, 4, 5, 5, 60, rng.randrange(1000), -2.5]))) for k in "abc" for t in range(150) if rng.random() < 0.8]
    got = _medians(spark, rows, width)
    for k in "abc":
        own = sorted((t, v) for kk, t, v in rows if kk == k)
        for i, (t, _) in enumerate(own):
            before = [v for _, v in own[:i] if v is not None]
            assert got[k, t] == (median(before) if before else None, i)


def test_no_rows(spark):
    assert _medians(spark, [], 5) == {}


def test_carry_of_a_slice_is_no_larger_than_the_slice_asks():
    history = History()
    values = np.arange(10_000, dtype=float)
    history.take(values, np.ones(10_000, np.int64), 10_000)
    below, every, before = history.carry(np.array([-5.0, 20_000.0]), np.array([2, 1]))
    assert len(every) <= 12 and below + before.sum() > 5000 and below < 5000


def test_fenwick_finds_ranks():
    rng = random.Random(3)
    counts = [rng.randrange(4) for _ in range(37)]
    tree = Fenwick(np.array(counts))
    for i in range(200):
        flat = [j for j, n in enumerate(counts) for _ in range(n)]
        rank = rng.randrange(len(flat))
        assert tree.at_rank(rank) == flat[rank]
        tree.add(i % 37)
        counts[i % 37] += 1


def test_time_grows_with_the_rows_of_one_key(spark):
    """A million completions of one segment, an eighth of them for comparison."""
    seconds = {}
    for n in (125_000, 1_000_000):
        df = spark.range(n).select(F.lit("k").alias("k"), F.col("id").alias("t"), (F.xxhash64("id") % 1800).cast("double").alias("v"), F.floor(F.col("id") / 2000).alias("s"))
        began = time.perf_counter()
        row = medians_before(df, ["k"], "s", ["t"], "v").agg(F.count("*").alias("n"), F.max("__place").alias("last"), F.max_by("__median", "__place").alias("m")).first()
        seconds[n] = time.perf_counter() - began
        assert (row["n"], row["last"]) == (n, n - 1) and abs(row["m"]) < 20
    assert seconds[1_000_000] < 16 * seconds[125_000]


def test_carry_is_the_nearest_slice_before(spark):
    rows = spark.createDataFrame([("a", 5, 1), ("a", 17, 2), ("a", 18, None), ("a", 25, None), ("a", 41, 4), ("b", 9, 9)], "k string, t long, v int").withColumn("__slice", slice_of(F.col("t"), 10))
    got = {(r["k"], r["__slice"]): r["v"] for r in carry(rows, ["k"], F.max("v"), "v").collect()}
    assert got == {("a", 0): None, ("a", 1): 1, ("a", 2): 2, ("a", 4): 2, ("b", 0): None}


@pytest.mark.parametrize("block", [1, 4, 5, 64])
def test_halo_windows_are_those_of_the_whole_line(spark, block):
    df = spark.range(50).select((F.col("id") % 3).alias("k"), F.floor(F.col("id") / 3).alias("p"), F.xxhash64("id").alias("v"))
    line = lambda *more: Window.partitionBy("k", *more).orderBy("p").rowsBetween(-3, 0)
    want = {(r["k"], r["p"]): r["s"] for r in df.withColumn("s", F.min("v").over(line())).collect()}
    cut = with_halo(df, "p", 3, block).withColumn("s", F.min("v").over(line("__block"))).where("not __halo")
    rows = cut.collect()
    assert len(rows) == 50 and {(r["k"], r["p"]): r["s"] for r in rows} == want


def test_headway_and_recent_conditions_reach_over_days(spark):
    day = 86_400
    rows = [seg(0, trip="A"), seg(200, trip="B"), seg(3 * day, trip="C"), seg(3 * day + 50, trip="D")]
    from dataclasses import replace

    from tramloom.config import DEFAULT

    wide = replace(DEFAULT, max_headway_sec=9 * day, rolling_max_age_sec=9 * day)
    got = {r["trip_id"]: (r["headway_sec"], r["recent_traversals"], r["recent_deviation"]) for r in features.historical_features(frame(spark, rows), wide).collect()}
    assert got == {"A": (None, None, None), "B": (200, 1, None), "C": (3 * day - 200, 2, 0.0), "D": (50, 2, 0.0)}


def test_tasks_follow_days_not_keys(spark):
    """One stop and one segment over forty days: no partition of the shuffle gets the whole history."""
    rows = frame(spark, [seg(i * 86_400, trip=f"T{i}") for i in range(40)])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        held = features.headway(rows).select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(held) == 4 and max(r["count"] for r in held) < 30
