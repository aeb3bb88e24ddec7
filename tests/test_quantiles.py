import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tramloom.functions.quantiles import quantiles
from tramloom.operators import evaluate

SHARES = (0.0, 0.005, 0.25, 1 / 3, 0.5, 0.8, 0.999, 1.0)


@pytest.mark.parametrize("limit", [3, 50, 10_000])
@pytest.mark.parametrize("kind", ["spread", "ties", "two", "tails", "one"])
def test_against_sorted_values(spark, kind, limit):
    rng = random.Random(7)
    make = {"spread": lambda: rng.gauss(0, 1), "ties": lambda: float(rng.randrange(5)), "two": lambda: rng.choice([1.0, 2.0, 2.0]), "tails": lambda: 10 ** rng.uniform(-300, 300), "one": lambda: -4.25}[kind]
    x = [make() for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in x] + [(None,)] * 40, "v double").repartition(4)
    got = quantiles(df, {"v": (F.col("v"), SHARES), "w": (-F.col("v"), (0.5,))}, limit=limit, accuracy=100)
    y = np.sort(x)
    for p, value in zip(SHARES, got["v"]):
        at = (len(y) - 1) * p
        low, high = y[int(np.floor(at))], y[int(np.ceil(at))]
        assert value == (low + (at - np.floor(at)) * (high - low) if at % 1 else low)
    assert got["w"] == [pytest.approx(-np.median(y))]


def test_of_nothing_and_of_one(spark):
    df = spark.createDataFrame([(None,), (None,)], "v double")
    assert quantiles(df, {"v": (F.col("v"), (0.5, 1.0))}) == {"v": [None, None]}
    assert quantiles(df.where("false"), {"v": (F.col("v"), (0.5,))}) == {"v": [None]}
    assert quantiles(spark.createDataFrame([(3,), (None,)], "v int"), {"v": (F.col("v"), (0.0, 0.5, 1.0))}) == {"v": [3.0, 3.0, 3.0]}


def test_as_percentile_on_many_rows(spark):
    df = spark.range(300_000).select((F.xxhash64("id") / 1e12).alias("v"))
    want = df.agg(F.percentile("v", F.array(*map(F.lit, SHARES))).alias("q")).first()["q"]
    assert quantiles(df, {"v": (F.col("v"), SHARES)})["v"] == pytest.approx(want, rel=1e-12)


def test_tables_of_no_rows(spark):
    none = spark.createDataFrame([], "p double, actual_duration_sec double")
    assert evaluate.binned(none, "p").collect() == [] and evaluate.clipped_residuals(none, "p").collect() == []
    row = evaluate.segment_level(none, ["p"]).first()
    assert (row["n_rows"], row["mae"], row["median_abs"]) == (0, None, None)
