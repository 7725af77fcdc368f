"""Inputs the given tables stand in for: a crawl-index table and page archives.

Both are derived from ``pages``, so they grow with it.
"""

from __future__ import annotations

import gzip
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirgate.functions.text import host_key
from weirgate.sources.warc import open_root, qualified_root


def cdx_table(pages: DataFrame) -> DataFrame:
    """A crawl index over ``pages`` with repeated keys, repeated digests and gaps."""
    n = F.col("page_id")
    host = F.substring_index(host_key(F.col("url")), "/", 1)
    return pages.select(
        F.when(n % 8 == 7, host).otherwise(host_key(F.col("url"))).alias("urlkey"),
        "url",
        F.when(n % 17 == 0, F.lit(None)).when(n % 11 == 0, "application/pdf").otherwise("text/html").alias("mime-detected"),
        F.when(n % 7 == 0, F.lit(None)).when(n % 13 == 0, 404).otherwise(200).cast("int").alias("status"),
        F.md5(F.when(n % 5 == 4, n - 1).otherwise(n).cast("string")).alias("digest"),
        F.length("html").cast("long").alias("length"),
        (n * 100000).alias("offset"),
        F.concat(F.lit("crawl-"), (n % 3).cast("string"), F.lit(".warc.gz")).alias("filename"),
        F.concat(F.lit("C"), (n % 3).cast("string")).alias("collection"),
        "page_id",
    )


def cdx_order() -> list:
    """Newest collection first, then row order."""
    return [F.desc("collection"), F.asc("page_id")]


# The same table for the SQL checks.
CDX_SQL = r"""
cdx AS (
  SELECT CASE WHEN page_id % 8 = 7 THEN split_part(k, '/', 1) ELSE k END AS urlkey, url,
    CASE WHEN page_id % 17 = 0 THEN NULL WHEN page_id % 11 = 0 THEN 'application/pdf' ELSE 'text/html' END AS mime,
    CASE WHEN page_id % 7 = 0 THEN NULL WHEN page_id % 13 = 0 THEN 404 ELSE 200 END::INTEGER AS status,
    md5((CASE WHEN page_id % 5 = 4 THEN page_id - 1 ELSE page_id END)::VARCHAR) AS digest,
    length(html)::BIGINT AS length, page_id * 100000 AS "offset",
    'crawl-' || (page_id % 3)::VARCHAR || '.warc.gz' AS filename,
    'C' || (page_id % 3)::VARCHAR AS collection, page_id
  FROM (SELECT *, regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(url),
      '^[a-z][a-z0-9+.-]*://', ''), '^(www|m)\.', ''), '[?#].*$', ''), '/$', '') AS k FROM pages)
)"""


def write_archives(pages: DataFrame, archive_root: str, file_column: str = "filename", flaws: bool = False) -> DataFrame:
    """Re-encode ``(id, url, raw, filename)`` as archives; returns ``(id, url, filename, offset, length)``.

    Each task writes its own file per name (a task number is added), so a name that most
    pages share is still written by many tasks. With ``flaws``, every tenth id (those that
    leave 4) has a record without a response, and every tenth (7) one of bytes that are not
    UTF-8, so that reading them fails. A null page has a record without a response, too.
    """
    archive_root = qualified_root(pages.sparkSession, archive_root)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        system, root = open_root(archive_root)
        system.create_dir(root, recursive=True)
        sinks: dict[str, pa.NativeFile] = {}
        try:
            for batch in batches:
                out = []
                for r in batch.to_pylist():
                    name = f"{r[file_column]}-{part:05d}.warc.gz"
                    if name not in sinks:
                        sinks[name] = system.open_output_stream(f"{root}/{name}", compression=None)
                    flaw = r["id"] % 10 if flaws else None
                    at = sinks[name].tell()
                    kind = "request" if flaw == 4 or r["raw"] is None else "response"
                    data = encode_record(r["url"], r["raw"] or "", kind, b"\xff\xfe" if flaw == 7 else b"")
                    sinks[name].write(data)
                    out.append({"id": r["id"], "url": r["url"], "filename": name, "offset": at, "length": len(data)})
                yield pa.RecordBatch.from_pylist(out, schema=pa.schema(_REQUEST))
        finally:
            for sink in sinks.values():
                sink.close()

    return pages.select("id", "url", "raw", F.col(file_column).alias(file_column)).mapInArrow(
        write, "id long, url string, filename string, offset long, length long"
    )


_REQUEST = [("id", pa.int64()), ("url", pa.string()), ("filename", pa.string()), ("offset", pa.int64()), ("length", pa.int64())]


def encode_record(url: str, html: str, kind: str = "response", extra: bytes = b"") -> bytes:
    """One gzip member holding one record."""
    message = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n" + html.encode() + extra
    head = f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Target-URI: {url}\r\nContent-Length: {len(message)}\r\n\r\n"
    return gzip.compress(head.encode() + message + b"\r\n\r\n", mtime=0)
