"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weirgate.session import materialise

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Rows are handed back to Spark in batches of about this many bytes, so that a batch of long
# texts never fills a task's memory.
BATCH_BYTES = 4 << 20


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z lower-cased and every other character left alone."""
    return F.translate(text, UPPER, UPPER.lower())


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or with underscores before it, such that no column of ``df`` has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = "_" + name
    return name


def partitions(spark: SparkSession) -> int:
    """The configured number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in slices of a few rows, so that few texts are Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def in_batches(rows: Iterator[tuple], schema: pa.Schema, weight: int, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Rows as record batches of at most ``most`` bytes in column ``weight``, or one longer row."""
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += 64 + len(row[weight] or "")
        if size >= most:
            yield as_batch(held, schema)
            held, size = [], 0
    if held:
        yield as_batch(held, schema)


def as_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.record_batch([pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)


def released(batches: Iterator, *caches: Callable[[], None]) -> Iterator:
    """The batches; after the last one the caches are emptied and freed memory goes back to the
    system, for Spark keeps a task's worker, and its memory, for the tasks of later stages."""
    try:
        yield from batches
    finally:
        for clear in caches:
            clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the C library may have none
        if trim is not None:
            trim(0)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (shifts and odd multipliers, modulo 2^64)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def positioned(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """``rows`` with ``pos``, the place from 0 in their group by ``order``, and ``total``, its size.

    Rows are range-sorted once by group and order, so a large group lies in many partitions; a
    count for each partition and group gives every partition its first place. Groups and order
    columns may hold nulls, which come first. ``rows`` is read twice: write it where it is dear.
    """
    keys = [*group, *order]
    ranged = rows.repartitionByRange(partitions(rows.sparkSession), *keys).sortWithinPartitions(*keys)
    ranged = materialise(ranged.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}))
    own = Window.partitionBy(*(group or [F.lit(0)]))
    counts = ranged.groupBy("_part", *group).agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    before = F.coalesce(F.sum("_n").over(own.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.withColumns({"_before": before, "_total": F.sum("_n").over(own)})
    starts = starts.select(*[F.col(c).alias(f"_of_{c}") for c in ["_part", *group]], "_first", "_before", "_total")
    same = ranged["_part"] == starts["_of__part"]
    for c in group:
        same &= F.equal_null(ranged[c], starts[f"_of_{c}"])
    place = (F.col("_at") - F.col("_first") + F.col("_before")).cast("long")
    return ranged.join(starts, same).select(*rows.columns, place.alias("pos"), F.col("_total").cast("long").alias("total"))


def crc_table() -> list[int]:
    """The 256 remainders of the CRC-32 polynomial, reflected."""
    found = []
    for x in range(256):
        for _ in range(8):
            x = (x >> 1) ^ (0xEDB88320 * (x & 1))
        found.append(x)
    return found


def crc32_list_sql(listed: str) -> str:
    """DuckDB's expression for the CRC-32 of a list of bytes."""
    step = f"xor(c >> 8, {crc_table()}[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce([4294967295] || {listed}, lambda c, b: {step}), 4294967295)"
