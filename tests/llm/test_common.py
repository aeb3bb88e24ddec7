from types import SimpleNamespace

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tramloom.llm import common


def _session(master, setting=None, folder=None):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: folder)
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: setting))


def test_only_a_local_session_may_do_without_a_shared_folder():
    for master in ("spark://host:7077", "yarn", "k8s://x", "local-cluster[2,1,512]"):
        with pytest.raises(RuntimeError, match="checkpoint"):
            common.shared_dir(_session(master))
    assert common.shared_dir(_session("yarn", "hdfs://x/shared/")) == "hdfs://x/shared"


def test_hot_keys_are_dealt_into_parts_and_nothing_is_lost(spark):
    left = common.materialize(spark.range(9000).select(F.when(F.col("id") < 7000, 0).otherwise(F.col("id") % 50).alias("k"), F.col("id").alias("x")), "left")
    right = left.groupBy("k").agg(F.count("*").alias("n"), F.min("x").alias("least")).where("k < 30")
    want = sorted(map(tuple, left.join(right.drop("n"), "k").select("k", "x", "least").collect()))
    for by in ((), ("x",)):
        joined = common.spread_join(left, right, "k", "n", by=by)
        assert sorted(map(tuple, joined.select("k", "x", "least").collect())) == want
        assert "__tl_parts" in joined._jdf.queryExecution().toString()
    sized = common.spread_join(left, right.drop("n"), ["k"], "n", "left", by=["x"], sizes=right)
    assert sized.count() == 9000 and sized.where("least is null").count() == left.where("k >= 30").count()


def test_whole_groups_are_never_cut():
    keys = [0] * 5 + [1] * 40 + [2] + [3] * 7 + [4] * 3
    table = pa.table({"k": pa.array(keys, pa.int64()), "x": pa.array(range(len(keys)), pa.int64())})
    for size in (1, 3, 10, 100):
        for room in (1, 4, 30):
            parts = [t["k"].to_pylist() for t in common.whole_groups(iter(table.to_batches(size)), ["k"], room)]
            assert sum(parts, []) == keys and all(not set(a) & set(b) for a, b in zip(parts, parts[1:]))


def test_forget_deletes_only_written_tables(spark, sf):
    df = common.materialize(spark.range(10), "gone")
    common.forget(df)
    with pytest.raises(Exception):  # noqa: B017
        df.count()
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    common.forget(docs)
    assert docs.count() > 0
