"""Fetched pages to a clean, deduplicated corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirgate.functions.maintext import ExtractConfig
from weirgate.functions.text import straighten_quotes
from weirgate.operators.dedup import MinHashConfig, dedup_by_scope_then_all
from weirgate.operators.extract import extract_text
from weirgate.operators.quality import FilterConfig, filter_documents
from weirgate.session import materialise

STAGES = ("extract", "repetition", "quality", "fineweb", "dedup_scope", "dedup_all")


def judged_pages(pages: DataFrame, extract: ExtractConfig = ExtractConfig(), filters: FilterConfig = FilterConfig()) -> DataFrame:
    """Pages ``(id, source, lang, raw)`` as text with the stage and reason that dropped them."""
    texts = extract_text(pages, config=extract).withColumn("text", straighten_quotes(F.col("text")))
    judged = filter_documents(texts, filters)
    lost = F.col("text").isNull()
    why = F.when(F.col("timed_out"), "timed_out").otherwise("no_text") if "timed_out" in judged.columns else F.lit("no_text")
    return (
        judged.withColumn("stage", F.when(lost, "extract").otherwise(F.col("stage")))
        .withColumn("reason", F.when(lost, why).otherwise(F.col("reason")))
        .drop("timed_out")
    )


def corpus(
    pages: DataFrame,
    extract: ExtractConfig = ExtractConfig(),
    filters: FilterConfig = FilterConfig(),
    minhash: MinHashConfig = MinHashConfig(),
) -> DataFrame:
    """Every page with its text and the stage that dropped it; ``stage`` is null for the corpus."""
    judged = materialise(judged_pages(pages, extract, filters))
    kept = judged.where(F.col("stage").isNull()).drop("stage", "reason")
    deduplicated = dedup_by_scope_then_all(kept, "source", minhash, doc_id="id").withColumn("reason", F.when(F.col("stage").isNotNull(), "duplicate"))
    return judged.where(F.col("stage").isNotNull()).unionByName(deduplicated, allowMissingColumns=True)
