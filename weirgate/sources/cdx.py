"""Crawl-index tables: scanning, looking up URL patterns, choosing fields and collections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirgate.functions.text import host_key, surt_key, url_host

CDX_SCHEMA = T.StructType(
    [
        T.StructField("urlkey", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("mime-detected", T.StringType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("digest", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("offset", T.LongType()),
        T.StructField("filename", T.StringType()),
    ]
)

# Published indexes write numbers bare or in quotes, so they are read as text and cast.
NUMBERS = ("status", "length", "offset")

# Newest capture first: later index files first, and rows of a file in their order.
CAPTURE_ORDER = ["capture_file", "capture_block", "capture_row"]


CORRUPT = "_corrupt_record"


def readable_number(text: Column, kind: T.DataType) -> Column:
    """A number written as an integer, or as a decimal without a fraction (``404.0``); else null."""
    wide = text.try_cast("double")
    whole = F.when((wide == F.floor(wide)) & (F.abs(wide) < float(1 << 53)), wide.cast("long"))
    return F.coalesce(text.try_cast(kind), whole.try_cast(kind))


def _scan(spark: SparkSession, pattern: str, schema: T.StructType) -> DataFrame:
    """Index lines with the columns of ``CAPTURE_ORDER`` and ``reason``, why a line is rejected."""
    as_text = T.StructType([T.StructField(f.name, T.StringType() if f.name in NUMBERS else f.dataType) for f in schema])
    lines = spark.read.schema(as_text.add(CORRUPT, T.StringType())).option("columnNameOfCorruptRecord", CORRUPT).json(pattern)
    numbers = {f.name: readable_number(F.trim(f"`{f.name}`"), f.dataType) for f in schema if f.name in NUMBERS}
    reason = F.when(F.col(CORRUPT).isNotNull(), F.lit("line"))
    for name, number in numbers.items():
        reason = reason.when((F.trim(f"`{name}`") != "") & number.isNull(), F.lit(name))
    return lines.select(
        *[numbers.get(f.name, F.col(f"`{f.name}`")).alias(f.name) for f in schema],
        *[F.col(f"`{name}`").alias(f"raw_{name}") for name in numbers],
        CORRUPT,
        reason.alias("reason"),
        F.col("_metadata.file_path").alias("capture_file"),
        F.col("_metadata.file_block_start").alias("capture_block"),
        F.monotonically_increasing_id().alias("capture_row"),
    )


def read_cdx(spark: SparkSession, pattern: str, schema: T.StructType = CDX_SCHEMA) -> DataFrame:
    """JSON-lines index files, with the columns of ``CAPTURE_ORDER`` to order captures by.

    ``capture_row`` grows within one block of one file; it is taken at the scan, before any
    shuffle, so a lost task that runs again gives the same numbers. A missing or empty number is
    null. Lines that are not JSON, or have a number that cannot be read, are left out: see
    :func:`read_cdx_rejects`.
    """
    return _scan(spark, pattern, schema).where("reason IS NULL").select(*[f"`{f.name}`" for f in schema], *CAPTURE_ORDER)


def read_cdx_rejects(spark: SparkSession, pattern: str, schema: T.StructType = CDX_SCHEMA) -> DataFrame:
    """The lines that :func:`read_cdx` leaves out: ``reason`` is ``line`` or the first number that
    cannot be read, ``value`` the line or that number as it was written."""
    found = _scan(spark, pattern, schema).where("reason IS NOT NULL")
    value = F.coalesce(CORRUPT, *[F.when(F.col("reason") == f.name, F.col(f"raw_{f.name}")) for f in schema if f.name in NUMBERS])
    return found.select("url", "reason", value.alias("value"), *CAPTURE_ORDER)


def newest_first() -> list[Column]:
    return [F.desc("capture_file"), F.asc("capture_block"), F.asc("capture_row")]


def matches_url(pattern: str, key_form: str = "surt") -> Column:
    """Condition on ``urlkey`` (and ``url`` for host keys) for one lookup pattern.

    ``http://example.com/path/*`` is a prefix, ``*.example.com`` a domain with its
    subdomains, anything else one URL. ``key_form`` says how the table spells its keys:
    ``surt`` (``com,example)/path``) or ``host`` (``example.com/path``). With ``surt`` every
    kind is a comparison on the stored key that reaches the file scan.
    """
    key = F.col("urlkey")
    to_key = {"surt": surt_key, "host": host_key}[key_form]
    if pattern.startswith("*."):
        domain = pattern[2:].lower().rstrip("/")
        if key_form == "surt":
            labels = ",".join(reversed(domain.split(".")))
            return key.startswith(labels + ")") | key.startswith(labels + ",")
        host = url_host(F.col("url"))
        return (host == domain) | host.endswith("." + domain)
    if pattern.endswith("*"):
        prefix = to_key(F.lit(pattern[:-1]))
        if key_form == "host" and pattern.endswith("/*"):
            prefix = F.concat(prefix, F.lit("/"))  # the key of a folder has lost its slash
            return key.startswith(prefix) | (key == to_key(F.lit(pattern[:-1])))
        return key.startswith(prefix)
    return key == to_key(F.lit(pattern))


def select_fields(cdx: DataFrame, fields: str) -> DataFrame:
    """The named columns of a comma-separated list, in its order."""
    return cdx.select(*[F.col(f"`{name.strip()}`") for name in fields.split(",")])


def choose_collection(cdx: DataFrame, collection: str | None = None, column: str = "collection") -> DataFrame:
    """Rows of one collection; ``None`` is the newest by name, ``all`` is everything."""
    if collection == "all":
        return cdx
    if collection is not None:
        return cdx.where(F.col(column) == collection)
    newest = cdx.agg(F.max(column).alias("_newest"))
    return cdx.join(F.broadcast(newest), F.col(column) == F.col("_newest")).drop("_newest")
