import random
import re

from tramloom.llm import mixing


def test_targets_stop_at_three_times_and_excess_is_reshared():
    targets = mixing.source_targets({"a": 1000, "b": 10, None: 500})
    assert targets["b"] == 30  # weight 2 of 6 would be 503
    assert abs(targets["a"] - (1510 - 30) / 4) < 1e-9 and abs(targets[None] - (1510 - 30) * 3 / 4) < 1e-9
    assert mixing.source_targets({}) == {} and mixing.source_targets({"z": 0}) == {"z": 0}


def test_flight_keeps_both_totals():
    rng = random.Random(1)
    size = [rng.randrange(1, 900) for _ in range(500)]
    prob = [0.37] * 500
    out = mixing.flight(prob, size, random.Random(2))
    assert sum(0 < p < 1 for p in out) <= 2
    assert abs(sum(out) - sum(prob)) < 1e-6
    assert abs(sum(p * s for p, s in zip(out, size)) - 0.37 * sum(size)) < 1e-5
    same = mixing.flight([0.5] * 9, [4] * 9, random.Random(3))
    assert sum(0 < p < 1 for p in same) <= 2 and abs(sum(same) - 4.5) < 1e-9


def test_inclusion_probabilities_hold_on_average():
    hits = [0] * 12
    for seed in range(3000):
        for i, p in enumerate(mixing.flight([0.3] * 12, list(range(1, 13)), random.Random(seed))):
            hits[i] += p
    assert all(abs(h / 3000 - 0.3) < 0.05 for h in hits)


def _check(rows):
    by = {}
    for r in rows:
        by.setdefault(r["source"], []).append(r)
    for own in by.values():
        assert {r["source_size"] for r in own} == {sum(r["size"] for r in own)}
        target = own[0]["target"]
        taken = sum(r["taken"] for r in own)
        assert abs(taken - target) <= max(0.02 * target, min((r["size"] for r in own if r["size"]), default=0), 2)
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in rows)


def test_mix_of_a_table_and_its_rerun(spark):
    rng = random.Random(9)
    rows = [(i, "w " * rng.randrange(0, 300), ["a", "b", "c", None][min(3, rng.randrange(9))]) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    first = mixing.mix_sources(docs).collect()
    assert len(first) == 4000
    _check(first)
    again = {r["doc_id"]: r["taken"] for r in mixing.mix_sources(docs.repartition(7)).collect()}
    assert again == {r["doc_id"]: r["taken"] for r in first}


def test_odd_rows(odd, nothing, odd_rows):
    rows = mixing.mix_sources(odd).collect()
    assert len(rows) == len(odd_rows)
    assert all(r["taken"] == 0 for r in rows if r["size"] == 0) and all(0 <= r["taken"] <= 3 * r["size"] for r in rows)
    assert mixing.mix_sources(nothing).collect() == []


def test_rows_alike_are_numbered_and_taken_evenly(spark):
    rows = [(None, "one two three", "a")] * 3000 + [(i, "w " * (i % 50), "ab"[i % 2]) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mix = mixing.mix_sources(docs)
    found = mix.collect()
    assert len(found) == 5000
    _check(found)
    again = mixing.mix_sources(docs.repartition(5)).groupBy("doc_id", "copies").count().collect()
    assert sorted(map(str, again)) == sorted(map(str, mix.groupBy("doc_id", "copies").count().collect()))
    kept = mixing.take(docs)
    assert kept.columns == ["doc_id", "text", "source", "size", "source_size", "target", "copies", "taken"]
    assert kept.where("doc_id is null").agg({"copies": "sum"}).first()[0] == sum(r["copies"] for r in found if r["doc_id"] is None)
    assert sum(r["taken"] for r in kept.collect()) == sum(r["taken"] for r in found)


def test_which_of_rows_alike_are_taken_does_not_change(spark):
    """Thousands of rows of one id and text that differ elsewhere, in portions: reruns and other partitions take the same ones."""
    rows = [(1, "one two three", "a", i) for i in range(9000)] + [(2, "one two three", "a", 5)] * 700 + [(3, "w " * 900, "b", 1), (4, "w " * 2000, "c", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n int")
    taken = lambda df: sorted(map(str, mixing.take(df).groupBy("doc_id", "n", "copies").count().collect()))
    one = taken(docs.repartition(2))
    assert one == taken(docs.repartition(7)) and len(one) > 2000
    mix = mixing.mix_sources(docs).where("doc_id = 1").agg({"copies": "sum"}).first()[0]
    found = mixing.take(docs).where("doc_id = 1")
    assert found.agg({"copies": "sum"}).first()[0] == mix and found.select("copies").distinct().count() <= 2


def test_whole_table_sizes_and_targets(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    words = {r["doc_id"]: (r["source"], len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))) for r in docs.collect()}
    totals = {}
    for source, n in words.values():
        totals[source] = totals.get(source, 0) + n
    targets = mixing.source_targets(totals)
    rows = mixing.mix_sources(docs).collect()
    assert {r["doc_id"]: (r["source"], r["size"]) for r in rows} == words
    assert all(r["source_size"] == totals[r["source"]] and abs(r["target"] - targets[r["source"]]) < 1e-6 for r in rows)
    _check(rows)
