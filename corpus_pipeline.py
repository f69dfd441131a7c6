"""From raw documents to a packing plan: five stages, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bytesift.llm import jaccard, mixing, packing, suffixes, toxicity
from bytesift.llm.store import documents, stored


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, fitted on the labels, does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.accepted(docs, toxicity.fit(docs, labels))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group linked by similarity."""
    return jaccard.first_of_each(docs)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 50 words or more that stand earlier already."""
    return suffixes.without_repeats(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The runs of words that the mix takes, each as often as it takes them."""
    return mixing.mixed_documents(docs, mixing.mix(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The plan of batches: doc_id, source, n_tokens, bucket, batch, slot, padding."""
    key = F.xxhash64("doc_id", "text")
    sized = docs.select("doc_id", "source", packing.word_count().alias("_words"), key.alias("_hash"))
    plan, _ = packing.pack(sized, F.col("_words"), F.col("_hash"))
    return plan.drop("_words", "_hash")


STAGES = [
    ("toxicity", without_toxic),
    ("jaccard", without_near_copies),
    ("repeats", without_repeated_passages),
    ("mixing", mixed),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each reading what the one before has stored."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


# Learned scores, seeded draws and dynamic programming are not SQL: the stages are
# tested against brute force instead.
ORACLE_SQL = None
