"""The resumable fetch run: a file stream over the fetch list, in micro-batches bounded by bytes."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from weirgate.functions.text import strip_markup_noise
from weirgate.operators.worklist import LOG_SCHEMA, WORKLIST_SCHEMA, with_markup
from weirgate.sources.files import write_jsonl
from weirgate.sources.warc import TASK_BYTES, read_slices

# Archive bytes of one micro-batch: enough for a thousand tasks.
BATCH_BYTES = 1_000 * TASK_BYTES

OUTCOME_SCHEMA = "id long, url string, raw string, result boolean, updated timestamp, batch long"


def write_chunks(worklist: DataFrame, path: str, chunk_bytes: int = TASK_BYTES, chunk_size: int | None = None) -> None:
    """The fetch list as files of neighbouring ids, the unit a run advances by.

    A file stands for about ``chunk_bytes`` of archives, and has at most ``chunk_size`` rows if
    that is given.
    """
    total = worklist.agg(F.sum("length")).first()[0] or 0
    writer = worklist.repartitionByRange(max(1, -(-total // chunk_bytes)), "id").write
    (writer.option("maxRecordsPerFile", str(chunk_size)) if chunk_size else writer).parquet(path)


def from_archives(archive_root: str) -> Callable[[DataFrame], DataFrame]:
    """Fetch by reading slices of archives and cleaning the markup."""
    return lambda requests: read_slices(requests, archive_root).withColumn("raw", strip_markup_noise(F.col("raw")))


def list_bytes(spark: SparkSession, worklist_path: str, batch_bytes: int) -> int:
    """How many bytes of the list's files stand for ``batch_bytes`` of archives."""
    rows = spark.read.schema(WORKLIST_SCHEMA).parquet(worklist_path)
    files = rows.groupBy("_metadata.file_path").agg(F.sum("length").alias("pages"), F.first("_metadata.file_size").alias("size"))
    pages, size = files.agg(F.sum("pages"), F.sum("size")).first()
    return max(1, math.floor(batch_bytes * (size or 1) / (pages or 1)))


def run_fetch(
    spark: SparkSession,
    worklist_path: str,
    output: str,
    checkpoint: str,
    fetch: Callable[[DataFrame], DataFrame],
    batch_bytes: int = BATCH_BYTES,
    max_rows: int | None = None,
    run_slice: tuple[int, int] | None = None,
) -> int:
    """Fetch every listed page not yet fetched and return how many rows this run handled.

    ``fetch`` gives ``(id, url, raw)``, one row per request, ``raw`` null where it failed. A batch
    is one write: its requests with their pages and the time, in ``output/outcomes/batch=n``. Pages
    and log are columns of that table, so no page is read back; rows are counted as they are
    written. A batch takes list files for about ``batch_bytes`` of archives, one at least. One that
    failed runs again with its number and overwrites its own folder, so nothing is lost or
    doubled. ``max_rows`` is checked between batches. ``run_slice=(i, n)`` handles the rows with
    ``id % n = i``, with its own output and checkpoint.
    """
    done = 0
    limit_reached = False

    def handle(batch: DataFrame, number: int) -> None:
        nonlocal done, limit_reached
        if max_rows is not None and done >= max_rows:
            limit_reached = True
            raise RuntimeError("row limit reached; the batch stays for the next run")
        todo = batch.where(F.col("result").isNull())
        if run_slice is not None:
            todo = todo.where(F.pmod("id", F.lit(run_slice[1])) == run_slice[0])
        written = Observation()
        outcomes = fetch(todo).select("id", "url", "raw", F.col("raw").isNotNull().alias("result"), F.current_timestamp().alias("updated"))
        outcomes.observe(written, F.count("*").alias("rows")).write.mode("overwrite").parquet(f"{output}/outcomes/batch={number}")
        done += written.get["rows"]

    per_batch = list_bytes(spark, worklist_path, batch_bytes)
    stream = spark.readStream.schema(WORKLIST_SCHEMA).option("maxBytesPerTrigger", per_batch).parquet(worklist_path)
    query = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    try:
        query.awaitTermination()
    except StreamingQueryException:
        if not limit_reached:
            raise
    return done


def read_outcomes(spark: SparkSession, output: str) -> DataFrame:
    return spark.read.schema(OUTCOME_SCHEMA).parquet(f"{output}/outcomes")


def read_log(spark: SparkSession, output: str) -> DataFrame:
    """What the run says of each request: success means there is markup. No page is read for it."""
    entry = {"field": F.lit("result"), "value": F.col("result")}
    return read_outcomes(spark, output).select(*[entry.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in LOG_SCHEMA])


def read_fetched(spark: SparkSession, output: str) -> DataFrame:
    return with_markup(read_outcomes(spark, output).where("result")).select("id", "url", "raw")


def export_pages(spark: SparkSession, output: str, path: str, archive: bool = False) -> None:
    """The fetched pages of a run as JSON lines, gzip-compressed if ``archive``."""
    write_jsonl(read_fetched(spark, output), path, archive)
