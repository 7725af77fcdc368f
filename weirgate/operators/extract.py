"""Main-text extraction from page markup."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from weirgate.functions import pagetext
from weirgate.functions.maintext import ExtractConfig, main_text


def timed(html: Column, config: ExtractConfig) -> Column:
    """The struct ``(text, timed_out)`` of a page, read by a parser that stops after a time."""

    def batch(pages: pa.Array) -> pa.Array:
        found = [main_text(page.as_py(), config) for page in pages]
        return pa.StructArray.from_arrays([pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.bool_())], names=["text", "timed_out"])

    # Declared non-deterministic so that a filter on the text is not pushed below it, which
    # would parse every page twice.
    return arrow_udf(batch, "text string, timed_out boolean").asNondeterministic()(html)


def extract_text(pages: DataFrame, raw: str = "raw", text: str = "text", config: ExtractConfig = ExtractConfig()) -> DataFrame:
    """Replace the markup column by its main text. Pages without any get a null.

    The work is one expression. Only with a time limit, which an expression cannot keep, a parser
    reads page by page, and a column ``timed_out`` tells pages that ran out of time from empty ones.
    """
    kept = [c for c in pages.columns if c != raw]
    if config.time_limit_s is not None:
        found = pages.select(*kept, timed(F.col(raw), config).alias("_found"))
        return found.select(*kept, F.col("_found.text").alias(text), F.col("_found.timed_out").alias("timed_out"))
    body = pagetext.main_text(F.col(raw), config.min_block_chars, config.max_link_share)
    # Going through a generator keeps later filters on the text above it, so it is made once.
    return pages.select(*kept, F.inline(F.array(F.struct(body.alias(text)))))
