"""JSON-lines pages in and out, rejected rows, merged frames and split datasets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PAGE_SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("raw", T.StringType())])


def read_pages(spark: SparkSession, path: str, text_key: str = "raw", schema: T.StructType = PAGE_SCHEMA) -> DataFrame:
    """JSON lines with the field ``text_key`` as ``text``; a missing field reads as null."""
    if text_key not in schema.fieldNames():
        schema = T.StructType([*schema.fields, T.StructField(text_key, T.StringType())])
    return spark.read.schema(schema).json(path).withColumnRenamed(text_key, "text")


def write_jsonl(df: DataFrame, path: str, archive: bool = False, mode: str = "errorifexists") -> None:
    """JSON lines, one object per row with its nulls, gzip-compressed if ``archive``."""
    writer = df.write.mode(mode).option("ignoreNullFields", "false")
    (writer.option("compression", "gzip") if archive else writer).json(path)


def write_rejected(verdicts: DataFrame, path: str, stages: tuple[str, ...] = ("repetition", "quality")) -> None:
    """Rejected rows, one folder per stage and reason. The line-structure stage keeps no
    rejects unless asked."""
    rejected = verdicts.where(F.col("reason").isNotNull() & F.col("stage").isin(*stages))
    _balanced(rejected, "stage", "reason").write.partitionBy("stage", "reason").option("compression", "gzip").json(path)


def write_duplicates(verdicts: DataFrame, path: str, stages: tuple[str, ...] = ("dedup_scope", "dedup_all")) -> None:
    """Documents that dedup removed, with the cluster they lost to, one folder per stage."""
    lost = verdicts.where(F.col("stage").isin(*stages) & F.col("cluster_id").isNotNull())
    _balanced(lost, "stage").write.partitionBy("stage").option("compression", "gzip").json(path)


def _balanced(df: DataFrame, *folders: str) -> DataFrame:
    """Rows of a folder together, by size: adaptive execution splits a folder larger than its
    advisory partition size over tasks, and gives several small ones to one task."""
    return df.hint("rebalance", *[F.col(c) for c in folders])


def merge_frames(frames: list[DataFrame]) -> DataFrame:
    """All rows of all frames; a column one lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def merge_files(spark: SparkSession, pattern: str, output: str) -> None:
    """Parquet files matching ``pattern`` as one table."""
    spark.read.option("mergeSchema", "true").parquet(pattern).write.parquet(output)


def write_splits(df: DataFrame, path: str, split: str = "split") -> None:
    """One folder per named part."""
    _balanced(df, split).write.partitionBy(split).parquet(path)


def read_split(spark: SparkSession, path: str, name: str, split: str = "split") -> DataFrame:
    return spark.read.parquet(path).where(F.col(split) == name).drop(split)
