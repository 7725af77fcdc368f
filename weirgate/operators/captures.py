"""From capture rows to a list of pages worth fetching."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def usable_captures(cdx: DataFrame, min_length: int = 10_000, mime: str = "text/html", below_status: int = 300) -> DataFrame:
    """Captures longer than ``min_length`` of one type with a successful status.

    A missing status counts as 0 and passes; a missing length or type does not.
    """
    return cdx.where((F.col("length") > min_length) & (F.col("mime-detected") == mime)).fillna({"status": 0}).where(
        F.col("status") < below_status
    )


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the first by ``order``, which must be total. Null keys are one key.

    Because only row 1 is asked for, Spark limits each key before the shuffle
    (``WindowGroupLimit Partial`` in the plan): every task sends at most one row per key,
    so a key with a third of all rows does not reach one task whole.
    """
    first = F.row_number().over(W.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*order))
    return df.withColumn("_first", first).where("_first = 1").drop("_first")


def unique_captures(usable: DataFrame, order: list[Column]) -> DataFrame:
    """Keep-first by ``urlkey``, then by ``digest`` among the survivors, then by ``url``.

    The steps are not one combined key: a row whose digest equals that of a row already
    removed for its ``urlkey`` survives.
    """
    for key in ("urlkey", "digest", "url"):
        usable = keep_first(usable, [key], order)
    return usable


def fetch_requests(captures: DataFrame) -> DataFrame:
    return captures.select("url", "filename", "offset", "length")


def duplicate_urls(requests: DataFrame) -> DataFrame:
    """URLs listed more than once; empty for a valid list."""
    return requests.groupBy("url").agg(F.count("*").alias("n")).where("n > 1")
