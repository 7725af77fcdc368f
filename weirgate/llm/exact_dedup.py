"""Operator 10: exact dedup by an extendible-hash index written to shared files.

Keys are 64-bit hashes of the normalised text. The directory starts as one bucket and doubles
while a bucket holds more bytes than its capacity; each bucket then has a local depth, and
every leading key pattern points at one bucket. Owner tasks take the entries of their buckets
in key order, chain the different texts of one key by comparing bytes, and the index is
written to the shared folder, where every document looks up its class.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirgate.llm.common import free_name, in_batches, lower_ascii, partitions, released, slices, table
from weirgate.session import materialise

# The directory has at most 2^MAX_DEPTH slots, so its counts stay small at any input size.
MAX_DEPTH = 14
CAPACITY = 8 << 20

ENTRY = pa.schema([("bucket", pa.int32()), ("key", pa.int64()), ("text", pa.string()), ("top", pa.int64()), ("n", pa.int64())])
INDEX = pa.schema([("bucket", pa.int32()), ("key", pa.int64()), ("chain", pa.int32()), ("sha", pa.binary()), ("keep_id", pa.int64()), ("group_size", pa.int64())])
ENTRY_DDL = "bucket int, key long, text string, top long, n long"
INDEX_DDL = "bucket int, key long, chain int, sha binary, keep_id long, group_size long"

# A task's table of texts it has seen is emptied beyond this size.
HELD_BYTES = 16 << 20


def grow_directory(held: np.ndarray, capacity: int) -> np.ndarray:
    """Bucket number of every slot of the directory, given the bytes held below each slot.

    ``held`` has 2^d entries. A bucket at depth k covers 2^(d-k) neighbouring slots; it splits
    while it holds more than ``capacity``, to depth d at most, where it overflows instead.
    """
    depth = int(len(held)).bit_length() - 1
    local = np.zeros(len(held), dtype=np.int64)
    for d in range(depth):
        full = held.reshape(1 << d, -1).sum(axis=1) > capacity
        local[np.repeat(full, len(held) >> d) & (local == d)] = d + 1
    first = (np.arange(len(held)) >> (depth - local)) << (depth - local)
    return np.unique(first, return_inverse=True)[1].astype(np.int32)


def _directory(keyed: DataFrame, depth: int, capacity: int) -> np.ndarray:
    slot = F.shiftrightunsigned("key", 64 - depth).alias("slot")
    counts = keyed.select(slot, (F.octet_length("text") + 64).alias("size")).groupBy("slot").agg(F.sum("size").alias("held"))
    held = np.zeros(1 << depth, dtype=np.int64)
    for slot_no, size in counts.collect():  # at most 2^depth rows
        held[slot_no] = size
    return grow_directory(held, capacity)


def _entries(batches: Iterator[pa.RecordBatch], directory: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One entry for each text a task has seen, so a hot text sends one row per task."""
    shift = np.uint64(64 - (len(directory).bit_length() - 1))

    def flush(seen: dict) -> Iterator[tuple]:
        keys = np.fromiter((e[0] for e in seen.values()), np.int64, len(seen))
        for bucket, (text, (key, top, n)) in zip(directory[keys.view(np.uint64) >> shift].tolist(), seen.items()):
            yield bucket, key, text, top, n

    def rows() -> Iterator[tuple]:
        seen: dict[str, list] = {}
        size = 0
        for batch in slices(batches):
            for doc, key, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "key", "text"))):
                entry = seen.get(text)
                if entry is None:
                    seen[text] = [key, doc, 1]
                    size += 200 + len(text)
                else:
                    entry[2] += 1
                    if entry[1] is None or (doc is not None and doc > entry[1]):
                        entry[1] = doc
            if size > HELD_BYTES:
                yield from flush(seen)
                seen, size = {}, 0
        yield from flush(seen)

    yield from in_batches(rows(), ENTRY, 2)


def _own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The index pages of entries in key order; a chain holds the different texts of one key."""

    def page(bucket, key, chain) -> Iterator[tuple]:
        for i, (text, top, n) in enumerate(chain):
            yield bucket, key, i, hashlib.sha256(text.encode()).digest(), top, n

    def rows() -> Iterator[tuple]:
        at, chain = None, []
        for batch in slices(batches):
            for bucket, key, text, top, n in zip(*(c.to_pylist() for c in batch.columns)):
                if (bucket, key) != at:
                    if at is not None:
                        yield from page(*at, chain)
                    at, chain = (bucket, key), []
                for link in chain:
                    if link[0] == text:
                        link[1] = top if link[1] is None else link[1] if top is None else max(top, link[1])
                        link[2] += n
                        break
                else:
                    chain.append([text, top, n])
        if at is not None:
            yield from page(*at, chain)

    yield from in_batches(rows(), INDEX, 3)


def build_index(docs: DataFrame, max_depth: int = MAX_DEPTH, capacity: int = CAPACITY) -> DataFrame:
    """The written index ``(bucket, key, chain, sha, keep_id, group_size)`` of ``docs(doc_id, text)``."""
    keyed = docs.select("doc_id", F.xxhash64("text").alias("key"), "text")
    directory = _directory(keyed, max_depth, capacity)
    entries = keyed.mapInArrow(lambda batches: released(_entries(batches, directory)), ENTRY_DDL)
    owned = entries.repartition(partitions(docs.sparkSession), "bucket").sortWithinPartitions("bucket", "key")
    return materialise(owned.mapInArrow(lambda batches: released(_own(batches)), INDEX_DDL))


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_depth: int = MAX_DEPTH,
    capacity: int = CAPACITY,
) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)``, one row per input row.

    Texts are equal if identical after lower-casing A-Z. The largest id of a group stays.
    Only the two named columns are read, so others may clash with ours.

    Nulls: a null text is an empty text; a null id counts in its group's size and never stays
    unless the group has no other id, in which case ``keep_id`` is null and all of it stays.
    Empty texts form a group of their own. Repeated rows count each, and all rows with the
    largest id stay, since they are one document. Texts of any length are compared whole. An
    empty table gives an empty result.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), lower_ascii(F.coalesce(F.col(text_col), F.lit(""))).alias("text"))
    index = build_index(base, max_depth, capacity).select("key", "sha", "keep_id", "group_size")
    looked = base.select("doc_id", F.xxhash64("text").alias("key"), F.unhex(F.sha2("text", 256)).alias("sha"))
    return looked.join(index, ["key", "sha"]).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.equal_null("doc_id", "keep_id").alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that :func:`exact_dedup` keeps, with their own columns.

    A row goes by its id and its text, so rows that share an id with another text, or have
    none, each follow their own verdict.
    """
    sha = free_name(docs, "sha")
    gone = exact_dedup(docs).where("NOT kept").select(F.col("doc_id").alias("_gone_id"), F.unhex("text_sha256").alias("_gone_sha")).distinct()
    named = docs.withColumn(sha, F.unhex(F.sha2(lower_ascii(F.coalesce("text", F.lit(""))), 256)))
    same = F.equal_null(named["doc_id"].cast("long"), gone["_gone_id"]) & (named[sha] == gone["_gone_sha"])
    return named.join(gone, same, "left_anti").select(*docs.columns)


def query(spark, folder: str) -> DataFrame:
    return exact_dedup(table(spark, folder, "documents"))


SQL = """
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), g AS (
  SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text
)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.text) AS text_sha256 FROM t JOIN g USING (text)
"""
