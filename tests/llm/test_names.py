"""Tables that already have columns named like an operator's outputs, its inner names, or with a dot."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from tramloom.llm import balltree, decontamination, html, lines, mixing, secrets, simhash, substrings, toxicity, warc

NAMES = ["id", "th", "n", "size", "order", "prob", "copies", "taken", "target", "source_size", "mix_key", "Score", "n_words", "n_removed", "n_hit", "n_items", "items", "contaminated", "n_lines", "n_dropped", "drops", "digest", "anchor", "content", "place", "windows", "main_text", "host", "path", "h", "hit_id", "names", "spans", "base", "random", "tokens", "fp", "item", "key", "node", "component", "component_id", "class_id", "bands", "record_type", "bytes", "refers_to", "asked", "v", "a.b", "with space", "n_chars"]


@pytest.fixture(scope="module")
def wide(odd, spark):
    df = odd.select("doc_id", "text", "source", F.lit("en").alias("lang"), *[F.lit(7).alias(n) for n in NAMES])
    return df


@pytest.fixture(scope="module")
def folder(spark, sf, tmp_path_factory, wide):
    path = str(tmp_path_factory.mktemp("wide"))
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id")
    more = [F.lit(3).alias(c) for c in ("id", "y", "least", "text", "n_words", "item", "words", "token")]
    labels = docs.limit(100).select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"), *more)
    labels.write.parquet(f"{path}/labels.parquet")
    spark.read.parquet(f"{sf}/benchmark.parquet").select("*", *[F.lit(1).alias(c) for c in ("id", "item", "words", "token", "n", "place")]).write.parquet(f"{path}/benchmark.parquet")
    return path


def test_operators(wide, odd_rows, spark, folder):
    rows = len(odd_rows)
    rest = lambda *own: [c for c in wide.columns if c.lower() not in own]
    bench, labels = spark.read.parquet(f"{folder}/benchmark.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    assert len(mixing.mix_sources(wide).collect()) == rows
    assert len(simhash.simhash_classes(wide).collect()) == rows
    assert len(secrets.scan_secrets(wide).collect()) == rows
    assert len(decontamination.contamination(wide, bench).collect()) == rows
    cut = substrings.dedup_substrings(wide)
    assert cut.columns == [*rest("n_words", "n_removed"), "n_words", "n_removed"] and len(cut.collect()) == rows
    kept = lines.dedup_lines(wide)
    assert kept.columns == [*rest("n_lines", "n_dropped"), "n_lines", "n_dropped"] and len(kept.collect()) == rows
    scored = toxicity.score_toxicity(wide, labels)
    assert scored.columns == [*rest("score"), "score"] and len(scored.collect()) == rows
    pages = wide.withColumnsRenamed({"doc_id": "page_id", "text": "html"}).withColumn("url", F.lit("http://x/"))
    found = html.extract_main_text(pages)
    assert found.columns[-2:] == ["main_text", "n_chars"] and found.columns.count("n_chars") == 1 and len(found.collect()) == rows
    assert len(warc.archived_pages(pages).collect()) == rows
    vectors = wide.select(F.monotonically_increasing_id().alias("vec_id"), F.array(F.lit(1.0), F.rand(1)).alias("embedding"), *[F.col(f"`{n}`") for n in NAMES])
    assert len(balltree.top_k(vectors, F.col("n") == 7, k=2).collect()) == 2 * rows


def test_stages_keep_all_columns(wide, spark, folder):
    docs = wide
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, wide, folder)
        assert docs.columns == wide.columns, name
        assert 0 < docs.count() <= wide.count()
        assert docs.where("id <> 7 or `a.b` <> 7 or Score <> 7").count() == 0
    mix = corpus_pipeline.mix(spark, wide, folder)
    assert set(wide.columns) <= set(mix.columns) and len(set(mix.columns)) == len(mix.columns) and mix.where("size = 7 and source_size = 7").count() == 0


def test_reserved_names_are_refused(wide, spark):
    with pytest.raises(ValueError, match="reserved"):
        lines.dedup_lines(wide.withColumn("__tl_x", F.lit(1)))
