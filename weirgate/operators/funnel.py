"""How many documents each step keeps and drops, per source and in total."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weirgate.operators.quality import STAGES


def stage_counts(verdicts: DataFrame, source: str = "source", length: str = "doc_len", stages: tuple[str, ...] = STAGES) -> DataFrame:
    """Per source and stage: total, forwarded, dropped, and lengths of forwarded documents.

    One pass over the verdicts; a stage's total is what the stage before it forwarded.
    """
    rank = F.coalesce(*[F.when(F.col("stage") == s, F.lit(i)) for i, s in enumerate(stages)], F.lit(len(stages)))
    ranked = verdicts.select(F.col(source).alias("source"), rank.alias("_rank"), F.col(length).alias("_len"))
    aggs = []
    for i, s in enumerate(stages):
        forwarded = F.col("_rank") > i
        seen = F.when(forwarded, F.col("_len"))
        aggs += [
            F.count_if(F.col("_rank") >= i).alias(f"{s}_total"),
            F.count_if(forwarded).alias(f"{s}_forwarded"),
            F.count_if(F.col("_rank") == i).alias(f"{s}_dropped"),
            F.min(seen).alias(f"{s}_min"),
            F.max(seen).alias(f"{s}_max"),
            F.avg(seen).alias(f"{s}_avg"),
        ]
    wide = ranked.groupBy("source").agg(*aggs)
    rows = [
        F.struct(
            F.lit(s).alias("stage"),
            F.col(f"{s}_total").alias("total"),
            F.col(f"{s}_forwarded").alias("forwarded"),
            F.col(f"{s}_dropped").alias("dropped"),
            F.col(f"{s}_min").alias("doc_len_min"),
            F.col(f"{s}_max").alias("doc_len_max"),
            F.col(f"{s}_avg").alias("doc_len_avg"),
        )
        for s in stages
    ]
    return wide.select("source", F.inline(F.array(*rows)))


def reason_counts(verdicts: DataFrame, source: str = "source") -> DataFrame:
    """Per source, stage and reason: dropped documents."""
    return (
        verdicts.where(F.col("reason").isNotNull())
        .groupBy(F.col(source).alias("source"), "stage", "reason")
        .agg(F.count("*").alias("n"))
    )


def stage_totals(counts: DataFrame) -> DataFrame:
    """Totals over sources per stage, from :func:`stage_counts`."""
    return counts.groupBy("stage").agg(*[F.sum(c).cast("long").alias(c) for c in ("total", "forwarded", "dropped")])


def nested_counts(counts: DataFrame, reasons: DataFrame) -> DataFrame:
    """One row per source and stage with the reasons as a map."""
    maps = reasons.groupBy("source", "stage").agg(
        F.map_from_entries(F.collect_list(F.struct(F.concat(F.lit("dropped_"), "reason"), "n"))).alias("dropped_by")
    )
    return counts.join(maps, ["source", "stage"], "left")


def drop_shares(totals: DataFrame, remained: str = "remained") -> DataFrame:
    """Share of each stage's drops, and of what remained after the last, in the whole.

    ``totals`` is the small per-stage table; every document is in exactly one part.
    """
    dropped = totals.select("stage", F.col("dropped").alias("n"))
    last = totals.agg(F.min("forwarded").alias("n")).select(F.lit(remained).alias("stage"), "n")
    whole = W.partitionBy(F.lit(1))
    return dropped.unionByName(last).select("stage", "n", (F.col("n") / F.sum("n").over(whole)).alias("share"))


def all_counts(verdicts: DataFrame, source: str = "source", length: str = "doc_len", stages: tuple[str, ...] = STAGES) -> DataFrame:
    """``(source, stage, reason, total, forwarded, dropped, doc_len_min, doc_len_max, doc_len_avg)``.

    The rows of :func:`stage_counts`, :func:`reason_counts` and :func:`stage_totals`, and drops
    by reason over all sources, from one aggregation over grouping sets. A row counts documents
    of a ``source``, of all if that is null and ``all_sources``; ``reason`` is null in rows that
    count a stage's whole input.
    """
    rank = F.coalesce(*[F.when(F.col("stage") == s, F.lit(i)) for i, s in enumerate(stages)], F.lit(len(stages)))
    ranked = verdicts.select(F.col(source).alias("source"), "reason", rank.alias("rank"), F.col(length).alias("len"))
    # What a document contributes to each stage it reached: dropped in its own, forwarded before.
    reached = F.explode(F.sequence(F.lit(0), F.least("rank", F.lit(len(stages) - 1)))).alias("at")
    steps = ranked.select("source", "rank", "len", reached, "reason").select(
        "source", F.element_at(F.array(*[F.lit(s) for s in stages]), F.col("at") + 1).alias("stage"),
        F.when(F.col("at") == F.col("rank"), F.col("reason")).alias("reason"), (F.col("at") < F.col("rank")).alias("on"), "len",
    )
    sets = [["source", "stage", "reason"], ["source", "stage"], ["stage", "reason"], ["stage"]]
    on = F.when(F.col("on"), F.col("len"))
    counted = steps.groupingSets([[F.col(c) for c in s] for s in sets], "source", "stage", "reason").agg(
        F.grouping("source").alias("no_source"), F.grouping("reason").alias("no_reason"), F.count("*").alias("total"),
        F.count_if("on").alias("forwarded"), F.count_if(~F.col("on")).alias("dropped"),
        F.min(on).alias("doc_len_min"), F.max(on).alias("doc_len_max"), F.avg(on).alias("doc_len_avg"),
    )
    counted = counted.where((F.col("no_reason") == 1) | F.col("reason").isNotNull())
    return counted.select("source", (F.col("no_source") == 1).alias("all_sources"), "stage", "reason", "total", "forwarded", "dropped", "doc_len_min", "doc_len_max", "doc_len_avg")
