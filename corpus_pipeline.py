"""Documents to mixed, encoded training text, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; it is written as Parquet
and read again as the next one's ``docs``. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weirgate.llm import bpe, exact_dedup, jaccard_join, mixing, toxicity
from weirgate.session import materialise

# Near copies are texts whose sets of five-word shingles have a similarity of 0.8 or more.
NEAR_WIDTH = 5
NEAR_PERCENT = 80

# Rows that go to a Python worker at a time. A row is a whole text, so the usual ten thousand would
# be held several times over, in the executor and in the worker.
BATCH_ROWS = "1024"


def _prepared(spark: SparkSession) -> SparkSession:
    """The session with settings for rows that are whole texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity network does not reject."""
    return toxicity.keep_clean(docs, _prepared(spark).read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id."""
    _prepared(spark)
    return exact_dedup.keep_one(docs)


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the document with the smallest id."""
    _prepared(spark)
    return jaccard_join.keep_one(docs, width=NEAR_WIDTH, percent=NEAR_PERCENT)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document, a row for each time it goes through it."""
    _prepared(spark)
    return mixing.mixed_documents(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the decoded text of every row of the mix."""
    _prepared(spark)
    return bpe.digests(bpe.encode_decode(docs))


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_dedup_stage),
    ("jaccard_join", jaccard_stage),
    ("mixing", mixing_stage),
    ("bpe", encoding_stage),
]

# SQL can state neither the network nor the seeded mix; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialise(docs)
    return docs
