"""A training corpus from ``documents``, in five stages.

Each stage takes the documents that its predecessor kept, written as Parquet and read again,
and returns them with the columns of ``documents``; the last returns their tokens. Toxic
documents go, one document of each group of near-duplicates stays, documents contaminated by
``benchmark`` go, secrets in texts are masked, and texts are encoded and decoded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.llm import bpe, decontaminate, near_dup, secrets, toxicity
from ledgerloom.session import settled

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn from all labels, then leave out the documents that score as toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.remove_toxic(docs, toxicity.learn_toxicity(docs, labels)).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class stays: the one with the smallest id."""
    return near_dup.keep_one_per_class(docs).select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave out the documents of which a twentieth or more is in benchmark passages."""
    return decontaminate.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*COLUMNS)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Put a mask in the place of each secret; all documents stay."""
    masked = secrets.mask_secrets(docs, secrets.learn_from_documents(docs), path="source")
    return masked.withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian unsigned 32-bit) and the text they decode to."""
    return bpe.bpe_round_trip(docs).select("row.doc_id", "row.lang", "row.source", "n_tokens", "ids", "decoded")


STAGES = [
    ("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates), ("decontamination", drop_contaminated),
    ("secrets", mask_secrets), ("bpe", encode),
]

#: SQL can express none of the learned stages; the pipeline is tested against its parts by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS)
    for _, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
