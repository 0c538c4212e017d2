"""The corpus pipeline: every stage takes (spark, docs, sf_dir) and returns what it keeps.

All stages but the last return the columns of ``documents``; each result is written as Parquet
and read again as the next stage's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from plumbline.llm import jaccard, packing, pii, quality, toxicity
from plumbline.llm.common import small_batches, written
from plumbline.llm.lm import fold


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak supervision of quality rules rejects go."""
    return quality.keep_good(docs)


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go; labels of one fold are never learnt."""
    small_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(fold(F.col("doc_id")) != 0).select("doc_id", "toxic")
    return toxicity.drop_toxic(docs, toxicity.train(docs, labels))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones stays."""
    small_batches(spark)
    return jaccard.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked; n_chars follows the text."""
    small_batches(spark)
    return pii.mask(docs).withColumn("n_chars", F.length("text").cast("long"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token windows of what is left, with their ids."""
    import public_tokenizers

    small_batches(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("toxicity", toxic_documents),
    ("n-gram Jaccard join", near_copies),
    ("personal data", personal_data),
    ("packing", packed),
]

# Estimated models, a trained field and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
