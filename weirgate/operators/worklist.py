"""The fetch list: a table of requests plus an append-only log of results and labels.

The list itself is written once. ``result`` and ``label`` come from the log, where the
latest entry per row and field wins, so marking rows never rewrites the list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirgate.session import scratch_path
from weirgate.sources.commits import Commits

WORKLIST_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("filename", T.StringType()),
        T.StructField("offset", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("result", T.BooleanType()),
        T.StructField("label", T.BooleanType()),
        T.StructField("created", T.TimestampType()),
        T.StructField("updated", T.TimestampType()),
    ]
)
LOG_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("field", T.StringType()),
        T.StructField("value", T.BooleanType()),
        T.StructField("updated", T.TimestampType()),
        T.StructField("batch", T.LongType()),
    ]
)


def number_rows(df: DataFrame, order: list[Column], start: int = 1, out: str = "id") -> DataFrame:
    """Add a dense number ``out`` that follows ``order``, which must be total.

    The rows are range-sorted into files; a row's number is its place in its file plus the
    rows of the files before it. Only one count per file meets in one place.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "sorted")
    df.orderBy(*order).write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path).select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    # By the part's number: as text, part 100000 would come before part 99999.
    part = F.regexp_extract("_file", r"part-(\d+)", 1).cast("long")
    files = stored.groupBy("_file").agg(F.count("*").alias("_n"))
    before = W.partitionBy(F.lit(1)).orderBy(part, "_file").rowsBetween(W.unboundedPreceding, -1)
    starts = files.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return stored.join(F.broadcast(starts), "_file").select((F.col("_before") + F.col("_row") + F.lit(start)).alias(out), *df.columns)


def build_worklist(requests: DataFrame, order: list[Column], now: Column) -> DataFrame:
    """Number the requests; nothing is processed or labelled yet. ``now`` stamps the rows."""
    numbered = number_rows(requests, order)
    return numbered.select(
        "id", "url", "filename", "offset", "length",
        F.lit(None).cast("boolean").alias("result"), F.lit(None).cast("boolean").alias("label"),
        now.cast("timestamp").alias("created"), now.cast("timestamp").alias("updated"),
    )


def incomplete(worklist: DataFrame, limit: int | None = 10_000, offset: int | None = None) -> DataFrame:
    """The next unprocessed requests in id order; ``None`` takes all of them.

    With an offset the requests are numbered first, so that neither the skipped nor the
    remaining ones pass through one task.
    """
    todo = worklist.where(F.col("result").isNull()).select("id", "url", "filename", "offset", "length")
    if offset:
        todo = number_rows(todo, [F.asc("id")], out="_place").where(F.col("_place") > offset).drop("_place")
    todo = todo.orderBy("id")
    return todo if limit is None else todo.limit(limit)


def run_slices(worklist: DataFrame, slices: int) -> DataFrame:
    """All unprocessed requests with a ``slice`` number, for runs that share the work.

    Consecutive ids go to slices in turn, so every slice gets its share of every range.
    """
    todo = worklist.where(F.col("result").isNull()).select("id", "url", "filename", "offset", "length")
    return todo.withColumn("slice", F.pmod("id", F.lit(slices)))


def result_log(pages: DataFrame, now: Column, batch: Column) -> DataFrame:
    """Log entries for fetched pages: success means there is markup. Failures stay failed."""
    return pages.select("id", F.lit("result").alias("field"), F.col("raw").isNotNull().alias("value"), now.alias("updated"), batch.cast("long").alias("batch"))


def label_log(labels: DataFrame, now: Column, batch: Column) -> DataFrame:
    """Log entries for ``(id, label)``."""
    return labels.select("id", F.lit("label").alias("field"), F.col("label").alias("value"), now.alias("updated"), batch.cast("long").alias("batch"))


def label_log_by_url(worklist: DataFrame, labels: DataFrame, now: Column, batch: Column) -> DataFrame:
    """Log entries for ``(url, label)``; unknown URLs are ignored."""
    return label_log(worklist.select("id", "url").join(labels.select("url", "label"), "url").select("id", "label"), now, batch)


LATEST_DDL = "id long, _r struct<updated: timestamp, batch: bigint, value: boolean>, _l struct<updated: timestamp, batch: bigint, value: boolean>"


def latest_entries(log: DataFrame) -> DataFrame:
    """The latest result ``_r`` and label ``_l`` of each id."""
    entry = F.struct("updated", "batch", "value")
    return log.groupBy("id").agg(
        F.max(F.when(F.col("field") == "result", entry)).alias("_r"), F.max(F.when(F.col("field") == "label", entry)).alias("_l")
    )


def current_worklist(worklist: DataFrame, log: DataFrame) -> DataFrame:
    """The list with the latest result and label of each row."""
    return with_latest(worklist, latest_entries(log))


def with_latest(worklist: DataFrame, latest: DataFrame) -> DataFrame:
    """The list with results and labels from :func:`latest_entries`."""
    joined = worklist.join(latest, "id", "left")
    pick = lambda name, e: F.when(F.col(e).isNotNull(), F.col(f"{e}.value")).otherwise(F.col(name)).alias(name)
    return joined.select(
        "id", "url", "filename", "offset", "length", pick("result", "_r"), pick("label", "_l"), "created",
        F.greatest("updated", "_r.updated", "_l.updated").alias("updated"),
    )


class WorkLog:
    """A stored log under ``path``: appended entries, and snapshots of the latest of each id.

    Readers take the newest snapshot and the entries committed after it, so what they read does
    not grow with the age of the list. A snapshot is made from committed folders and is committed
    itself when it is whole; a crash before leaves the older one in force.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.commits = spark, Commits(spark, path)

    def append(self, log: DataFrame) -> None:
        folder = self.commits.folder()
        log.select(*[F.col(f.name).cast(f.dataType) for f in LOG_SCHEMA]).write.parquet(folder)
        self.commits.commit(folder)

    def latest(self) -> DataFrame:
        """The latest result and label of each id that has any."""
        snapshot, tail, _ = self.commits.live()
        return self._merged(snapshot, tail)

    def _merged(self, snapshot: str | None, tail: list[str]) -> DataFrame:
        read = self.spark.read
        parts = read.schema(LOG_SCHEMA).parquet(*tail) if tail else self.spark.createDataFrame([], LOG_SCHEMA)
        latest = latest_entries(parts)
        if snapshot is None:
            return latest
        both = read.schema(LATEST_DDL).parquet(snapshot).unionByName(latest)
        return both.groupBy("id").agg(F.max("_r").alias("_r"), F.max("_l").alias("_l"))

    def compact(self) -> None:
        """Write a snapshot of everything committed so far."""
        snapshot, tail, last = self.commits.live()
        if not tail:
            return
        folder = self.commits.folder()
        self._merged(snapshot, tail).write.parquet(folder)
        self.commits.commit(folder, snapshot_of=last)

    def current(self, worklist: DataFrame) -> DataFrame:
        return with_latest(worklist, self.latest())


def unlabelled(worklist: DataFrame) -> DataFrame:
    return worklist.where(F.col("label").isNull()).select("id", "url")


def by_url(worklist: DataFrame, url: str) -> DataFrame:
    return worklist.where(F.col("url") == url)


def with_markup(pages: DataFrame) -> DataFrame:
    """Fetched pages that have markup."""
    return pages.where(F.col("raw").isNotNull())
