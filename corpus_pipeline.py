"""A corpus pipeline of five stages, each calling one operator of tramloom.llm.

Every stage takes (spark, docs, sf_dir); docs has the columns of ``documents``. Each but the last returns them too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramloom.llm import decontamination, lines, mixing, simhash, toxicity
from tramloom.llm.common import OWN, col, materialize, without

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A stage of learnt scores and random balancing has no SQL; tests hold the pipeline against its stages by brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under 0.5 stay."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.score_toxicity(without(docs), labels, score=f"{OWN}score").where(f"{OWN}score < 0.5").drop(f"{OWN}score")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose lines that five documents or more hold, but for one keeper; n_chars follows."""
    kept = lines.dedup_lines(without(docs), counts=(f"{OWN}lines", f"{OWN}dropped")).drop(f"{OWN}lines", f"{OWN}dropped")
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")))
    return kept.select(*map(col, docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: shingles of five words, similarity of 0.8 or more."""
    return simhash.keep_one(docs)


def drop_leaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window stay."""
    return decontamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with size, source_size, target, copies and taken, which columns of these names give way to."""
    return mixing.take(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("simhash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_leaked),
    ("mixing", mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, "stage")
    return docs
