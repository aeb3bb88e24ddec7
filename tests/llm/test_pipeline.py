import random
import re

import corpus_pipeline
from pyspark.sql import functions as F
from tramloom.llm import decontamination, lines, toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_one_by_one(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    n = docs.count()
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf).cache()
        rows = out.count()
        seen[name] = (n, rows)
        if name != "mixing":
            assert out.columns == COLUMNS
            assert out.join(docs, "doc_id", "left_anti").count() == 0
        if name == "toxicity":
            scored = toxicity.score_toxicity(docs, spark.read.parquet(f"{sf}/labels.parquet"))
            assert rows == scored.where("score < 0.5").count()
        if name == "line dedup":
            want = lines.dedup_lines(docs).select("doc_id", F.col("text").alias("want"))
            assert rows == n and out.join(want, "doc_id").where("not (text <=> want) or n_chars <> length(text)").count() == 0
        if name == "benchmark decontamination":
            found = decontamination.contamination(docs, spark.read.parquet(f"{sf}/benchmark.parquet"))
            assert rows == found.where("not contaminated").count()
        docs, n = out, rows
    mix = docs
    assert {"copies", "taken", "target"} <= set(mix.columns)
    assert mix.where("copies < 1 or copies > 3 or taken <> copies * size").count() == 0
    assert seen["mixing"][1] <= seen["mixing"][0]
    assert corpus_pipeline.run(spark, sf).count() == n


def test_planted_documents(spark, sf):
    """Toxic, copied, leaked and repeated texts are caught; clean ones stay."""
    rng = random.Random(3)
    item = spark.read.parquet(f"{sf}/benchmark.parquet").orderBy(F.desc(F.length("text"))).first()["text"]
    words = lambda k: " ".join(f"q{rng.randrange(20000)}" for _ in range(k))
    base = words(250)
    line = "a line of boilerplate that is found in many of these documents"
    rows = [(10**6, base), (10**6 + 1, base), (10**6 + 2, base + " and three more"), (10**6 + 3, words(100) + " " + item + " " + words(50))]
    rows += [(10**6 + 10 + i, words(150) + "\n" + line) for i in range(6)]
    docs = spark.createDataFrame([(i, t, "en", "srcX", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs = spark.read.parquet(f"{sf}/documents.parquet").unionByName(docs)
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["simhash near-dedup"](spark, docs, sf)
    assert sorted(r["doc_id"] for r in kept.where("doc_id between 1000000 and 1000002").collect()) == [10**6]
    clean = stages["benchmark decontamination"](spark, docs, sf)
    assert clean.where(f"doc_id = {10**6 + 3}").count() == 0 and clean.where(f"doc_id = {10**6}").count() == 1
    lined = {r["doc_id"]: r["text"] for r in stages["line dedup"](spark, docs, sf).where("doc_id >= 1000010").collect()}
    assert [line in lined[10**6 + 10 + i] for i in range(6)] == [False] * 5 + [True]


def test_stages_against_brute_force(spark, sf):
    """Each stage but the learnt one on its own input, by the brute force of its operator's tests."""
    from test_decontamination import brute as brute_items
    from test_mixing import _check
    from test_simhash import exact_classes
    from test_text_dedup import brute_lines

    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    lined = stages["line dedup"](spark, docs, sf)
    want = {i: (None if t is None else text, n if t is None else len(text)) for (i, t), (_, _, text), n in zip(rows, brute_lines(rows), [r["n_chars"] for r in docs.collect()])}
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in lined.collect()} == want
    kept = stages["simhash near-dedup"](spark, docs, sf)
    assert {r["doc_id"] for r in kept.collect()} == set(exact_classes(rows).values())
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    leaked = {key[1] for key, *_, hit in brute_items(rows, items) if hit}
    assert {r["doc_id"] for r in stages["benchmark decontamination"](spark, docs, sf).collect()} == {i for i, _ in rows} - leaked
    mix = [r.asDict() for r in stages["mixing"](spark, docs, sf).collect()]
    sources = {r["doc_id"]: r for r in docs.collect()}
    assert all(r["text"] == sources[r["doc_id"]]["text"] and r["taken"] == r["copies"] * r["size"] for r in mix)
    left = [{"source": s["source"], "size": len(re.findall(r"[^\x20\x09-\x0D]+", s["text"] or "")), "taken": 0} for i, s in sources.items() if i not in {r["doc_id"] for r in mix}]
    of = {r["source"]: r for r in mix}
    _check(mix + [x | {"source_size": of[x["source"]]["source_size"], "target": of[x["source"]]["target"]} for x in left])
