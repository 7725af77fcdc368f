"""Page records read by offset and length from archives on a shared file system."""

from __future__ import annotations

import gzip
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (lower-case names) and body of each record in a slice, gzip members or plain."""
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    at = 0
    while at < len(data):
        if data[at : at + 2] == b"\r\n":
            at += 2
            continue
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/", at):
            return
        fields = (line.partition(":") for line in data[at:end].decode("utf-8", "replace").split("\r\n")[1:])
        headers = {name.strip().lower(): value.strip() for name, _, value in fields}
        size = int(headers.get("content-length", "0"))
        yield headers, data[end + 4 : end + 4 + size]
        at = end + 4 + size


def http_body(message: bytes) -> bytes:
    """Body of an HTTP response, with chunked transfer and compression undone.

    Some archives keep the headers of a body that is stored decoded; it is returned as it is.
    """
    head, _, body = message.partition(b"\r\n\r\n")
    fields = (line.partition(":") for line in head.decode("latin-1").lower().split("\r\n")[1:])
    headers = {name.strip(): value.strip() for name, _, value in fields}
    if "chunked" in headers.get("transfer-encoding", ""):
        body = _joined_chunks(body)
    if headers.get("content-encoding") in ("gzip", "x-gzip") and body[:2] == b"\x1f\x8b":
        body = zlib.decompress(body, 31)
    return body


def _joined_chunks(body: bytes) -> bytes:
    joined, rest = [], body
    while rest:
        size, mark, after = rest.partition(b"\r\n")
        digits = size.split(b";")[0].strip()
        if not mark or not re.fullmatch(rb"[0-9A-Fa-f]{1,8}", digits):
            return body
        n = int(digits, 16)
        if n == 0:
            break
        joined.append(after[:n])
        rest = after[n + 2 :]
    return b"".join(joined)


def first_response(data: bytes) -> str | None:
    """Text of the first ``response`` record; null without one or if it is not UTF-8."""
    try:
        for headers, block in records(data):
            if headers.get("warc-type") == "response":
                return http_body(block).decode("utf-8")
    except (UnicodeDecodeError, ValueError, OSError, EOFError, zlib.error):
        return None
    return None


# Bytes of archives a task reads.
TASK_BYTES = 128 << 20


def open_root(archive_root: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(archive_root) if ":/" in archive_root else (fs.LocalFileSystem(), archive_root)


def qualified_root(spark: SparkSession, archive_root: str) -> str:
    """The folder with its scheme; one without lies where Spark itself would look for it."""
    if ":/" in archive_root:
        return archive_root
    path = spark._jvm.org.apache.hadoop.fs.Path(archive_root)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toUri().toString()


def read_slices(requests: DataFrame, archive_root: str, slices: int | None = None) -> DataFrame:
    """``(id, url, raw)`` for requests ``(id, url, filename, offset, length)``.

    ``archive_root`` is any location Arrow's file systems open; without a scheme it is taken in
    Spark's default file system, the same for all executors. Requests are range-split by
    file and offset into tasks of about ``TASK_BYTES``, so a task reads neighbouring slices,
    and one archive with most of the requests is shared by many tasks. A missing file and a
    record without a readable response give null pages: they fail for good. A missing root
    or a denied read raises, so that Spark tries again and no list is marked as failed.
    """
    spark = requests.sparkSession
    archive_root = qualified_root(spark, archive_root)
    total = 0 if slices else requests.agg(F.sum("length")).first()[0] or 0
    n = slices or max(spark.sparkContext.defaultParallelism, -(-total // TASK_BYTES))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = open_root(archive_root)
        if system.get_file_info(root).type != fs.FileType.Directory:
            raise FileNotFoundError(f"no folder of archives at {archive_root}")
        name, handle = None, None
        for batch in batches:
            rows = batch.to_pylist()
            for at in range(0, len(rows), 64):  # pages are large next to requests
                part, raw = rows[at : at + 64], []
                for r in part:
                    if r["filename"] != name:
                        if handle is not None:
                            handle.close()
                        name = r["filename"]
                        try:
                            handle = system.open_input_file(f"{root}/{name}")
                        except FileNotFoundError:
                            handle = None
                    raw.append(_slice(handle, r["offset"], r["length"]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["id"] for r in part], pa.int64()), pa.array([r["url"] for r in part], pa.string()), pa.array(raw, pa.string())],
                    names=["id", "url", "raw"],
                )

    placed = requests.select("id", "url", "filename", "offset", "length").repartitionByRange(n, "filename", "offset").sortWithinPartitions("filename", "offset")
    return placed.mapInArrow(read, "id long, url string, raw string")


def _slice(handle: pa.NativeFile | None, offset: int, length: int) -> str | None:
    if handle is None or offset >= handle.size():
        return None
    return first_response(handle.read_at(length, offset))
