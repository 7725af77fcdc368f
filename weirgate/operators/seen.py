"""A persistent set of keys, kept as a Parquet table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirgate.sources.commits import Commits


def not_seen(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose key is not in ``keys``; rows without a key count as not seen.

    With one row per key in a stored table, both sides of the join are plain shuffles, so
    adaptive execution can split a key that many rows share.
    """
    return df.join(keys.select(on), on, "left_anti")


def seen(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    return df.join(keys.select(on), on, "left_semi")


class SeenKeys:
    """Keys under ``path``, each once, laid out by slices of their hash.

    ``add`` and the tests read only the slices that the keys at hand fall into. Every ``add``
    is a part of its own; ``compact`` joins them, so that a slice is one folder again.
    """

    def __init__(self, spark: SparkSession, path: str, column: str = "key", slices: int = 64) -> None:
        self.spark, self.column, self.slices = spark, column, slices
        self.commits = Commits(spark, path)
        self.schema = f"{column} string, slice int"

    def _sliced(self, df: DataFrame) -> DataFrame:
        key = F.col(self.column).cast("string")
        return df.withColumn("slice", F.pmod(F.xxhash64(key), F.lit(self.slices)).cast("int"))

    def table(self, slices: list[int] | None = None) -> DataFrame:
        """All keys, or those of some slices."""
        return self._stored(slices).select(self.column)

    def _stored(self, slices: list[int] | None) -> DataFrame:
        snapshot, tail, _ = self.commits.live()
        folders = [*([snapshot] if snapshot else []), *tail]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        parts = [self.spark.read.schema(self.schema).parquet(f) for f in folders]
        if slices is not None:
            parts = [p.where(F.col("slice").isin(slices)) for p in parts]
        return reduce(DataFrame.unionByName, parts)

    def _touched(self, sliced: DataFrame) -> list[int]:
        return [r["slice"] for r in sliced.select("slice").distinct().collect()]  # at most ``slices`` rows

    def _held(self, df: DataFrame) -> DataFrame:
        """The stored keys of the slices that ``df`` touches."""
        return self.table(self._touched(self._sliced(df)))

    def add(self, keys: DataFrame) -> None:
        fresh = keys.select(F.col(self.column).cast("string")).where(F.col(self.column).isNotNull()).distinct()
        new = self._sliced(not_seen(fresh, self._held(fresh), self.column))
        folder = self.commits.folder()
        new.repartition(F.col("slice")).write.partitionBy("slice").parquet(folder)
        self.commits.commit(folder)

    def compact(self) -> None:
        """Rewrite the stored keys as one folder a slice."""
        snapshot, tail, last = self.commits.live()
        if len(tail) + (snapshot is not None) < 2:
            return
        folder = self.commits.folder()
        self._stored(None).repartition(F.col("slice")).write.partitionBy("slice").parquet(folder)
        self.commits.commit(folder, snapshot_of=last)

    def missing(self, df: DataFrame) -> DataFrame:
        return not_seen(df, self._held(df), self.column)

    def contained(self, df: DataFrame) -> DataFrame:
        return seen(df, self._held(df), self.column)
