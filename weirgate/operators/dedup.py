"""Near-duplicate removal: MinHash signatures, bucket matches, clusters, filter.

All steps take an optional scope column; documents only match within one scope.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from weirgate.functions import kernels
from weirgate.functions import text as tx
from weirgate.functions.kernels import MinHasher
from weirgate.operators.components import connected_components
from weirgate.operators.skew import attach_group_value, hot_threshold
from weirgate.session import materialise, materialise_by


@dataclass(frozen=True)
class MinHashConfig:
    buckets: int = 450
    rows: int = 20
    shingle_words: int = 5
    seed: int = 1


def _keyed(docs: DataFrame, doc_id: str, text: str, scope: str | None) -> DataFrame:
    # A null scope is one of its own, apart from the empty one.
    scope_key = F.coalesce(F.concat(F.lit("="), F.col(scope).cast("string")), F.lit("")) if scope else F.lit("")
    return docs.where(F.col(text).isNotNull()).select(F.col(doc_id).alias("doc_id"), scope_key.alias("scope"), F.col(text).alias("text"))


def _band_hashes(config: MinHashConfig) -> Callable[[Column], Column]:
    hasher: list[MinHasher] = []

    def bands(words: pa.Array) -> pa.Array:
        if not hasher:  # built once per Python worker, not shipped
            hasher.append(MinHasher(config.buckets, config.rows, config.seed))
        return hasher[0].batch(words, config.shingle_words)

    # Declared non-deterministic so that filters on the bands stay above it and neither the
    # hashing nor the word lists below are computed twice.
    return arrow_udf(bands, "array<bigint>").asNondeterministic()


def signatures(
    docs: DataFrame, config: MinHashConfig = MinHashConfig(), doc_id: str = "doc_id", text: str = "text", scope: str | None = None
) -> DataFrame:
    """``(doc_id, scope, bands)`` with one band hash per bucket.

    Text is lower-cased and reduced to its words; documents with fewer words than one
    shingle have no signature and are left out.
    """
    worded = _keyed(docs, doc_id, text, scope).select("doc_id", "scope", F.array_join(tx.words(F.lower("text")), " ").alias("_words"))
    return worded.select("doc_id", "scope", _band_hashes(config)("_words").alias("bands")).where(F.col("bands").isNotNull())


def exact_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", scope: str | None = None) -> DataFrame:
    """``(doc_id, first_id)`` for every document whose exact text has a smaller ``doc_id``."""
    digests = materialise(_keyed(docs, doc_id, text, scope).select("doc_id", "scope", F.sha2("text", 256).alias("digest")))
    return _star(digests, ["scope", "digest"], digests.count())


def bucket_matches(sigs: DataFrame, config: MinHashConfig = MinHashConfig()) -> DataFrame:
    """``(doc_id, first_id)`` for documents that share a band with a smaller ``doc_id``.

    Most bands are alone; a pass over slices of packed bands tells which are not, and only those
    become rows. Each bucket group becomes a star around its smallest id, so a group of k documents
    costs k rows, and matches seen in several buckets are kept once. ``sigs`` is read twice.
    """
    total = sigs.count() * config.buckets
    rows = materialise(shared_bands(sigs, total, config.buckets))
    return _star(rows, ["scope", "bucket", "band_hash"], total).distinct()


def shared_bands(sigs: DataFrame, total: int, buckets: int | None = None) -> DataFrame:
    """``(doc_id, scope, bucket, band_hash)`` of all bands that two documents of a scope share, and no others.

    The ``total`` bands, of ``buckets`` a document, travel once, as arrays: a slice has a few
    buckets of all documents, or a part of one bucket's if they are many, and is sorted by a task
    of its own. A band takes 8 bytes there, and its document 10 for all buckets of the slice.
    """
    if buckets is None:
        first = sigs.select(F.size("bands").alias("n")).first()
        buckets = first["n"] if first else 1
    # Two slices a core keep all busy; more would only carry the documents more often.
    tasks = 2 * sigs.sparkSession.sparkContext.defaultParallelism
    doc_id = dict(sigs.dtypes)["doc_id"]
    packed = sigs.select("doc_id", "scope", "bands").mapInArrow(
        lambda b: kernels.slice_bands(b, total, tasks), f"slice int, docs array<{doc_id}>, scopes array<string>, scope binary, bands binary"
    )
    n = int(sigs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = packed.repartition(n, "slice").sortWithinPartitions("slice")
    return placed.mapInArrow(lambda b: kernels.repeated_bands(b, total, tasks, buckets), f"doc_id {doc_id}, scope string, bucket int, band_hash long")


def long_bands(sigs: DataFrame) -> DataFrame:
    return sigs.select("doc_id", "scope", F.posexplode("bands").alias("bucket", "band_hash"))


def _star(rows: DataFrame, keys: list[str], total: int) -> DataFrame:
    # Counting first keeps a key held by a third of the rows from reaching one task: the
    # minimum is combined before its shuffle, and only groups of two or more are joined.
    # A group of two is known from its minimum and maximum.
    sizes = [F.min("doc_id").alias("first_id"), F.max("doc_id").alias("doc_id"), F.count("*").alias("n")]
    groups = materialise(rows.groupBy(*keys).agg(*sizes).where("n > 1"))
    larger = groups.where("n > 2").drop("doc_id")
    starred = attach_group_value(rows, larger, keys, "first_id", "n", hot_threshold(total))
    found = groups.where("n = 2").select("doc_id", "first_id").unionByName(starred.select("doc_id", "first_id"))
    return found.where(F.col("first_id") < F.col("doc_id"))


def duplicate_clusters(
    docs: DataFrame, config: MinHashConfig = MinHashConfig(), doc_id: str = "doc_id", text: str = "text", scope: str | None = None
) -> DataFrame:
    """``(doc_id, cluster_id, cluster_size, keep)`` for documents in a cluster of two or more.

    Copies of one text have one signature, so only the first is hashed and the others
    join its cluster. The smallest ``doc_id`` of a cluster names it and is kept.
    """
    signed = sign(docs, config, doc_id, text, scope)
    return clusters_of(bucket_matches(signed.bands, config).unionByName(signed.copies))


@dataclass(frozen=True)
class Signed:
    """What is stored of a set of documents, so that no later step hashes or reads them again.

    ``digests`` has ``(doc_id, scope, digest)`` of every text, ``copies`` has ``(doc_id,
    first_id)`` of exact copies, ``bands`` has ``(doc_id, scope, bands)`` of the first of equal
    texts, bucketed by id if the documents were.
    """

    digests: DataFrame
    copies: DataFrame
    bands: DataFrame


def sign(
    docs: DataFrame,
    config: MinHashConfig = MinHashConfig(),
    doc_id: str = "doc_id",
    text: str = "text",
    scope: str | None = None,
    bucketed: bool = False,
) -> Signed:
    """Digests, exact copies and signatures. ``bucketed`` says that ``docs`` is a table of
    :func:`materialise_by` on its id: then its texts stay where they are."""
    digests = materialise(_keyed(docs, doc_id, text, scope).select("doc_id", "scope", F.sha2("text", 256).alias("digest")))
    copies = materialise(_star(digests, ["scope", "digest"], digests.count()))
    firsts = docs.join(copies.select(F.col("doc_id").alias(doc_id)), doc_id, "left_anti")
    sigs = signatures(firsts, config, doc_id, text, scope)
    return Signed(digests, copies, materialise_by(sigs, "doc_id", placed=True) if bucketed else materialise(sigs))


def clusters_of(matches: DataFrame) -> DataFrame:
    """Clusters with their sizes from ``(doc_id, first_id)`` matches."""
    members = materialise(
        connected_components(matches.select(F.col("doc_id").alias("u"), F.col("first_id").alias("v"))).select(
            F.col("node").alias("doc_id"), F.col("component").alias("cluster_id")
        )
    )
    sizes = members.groupBy("cluster_id").agg(F.count("*").alias("cluster_size")).withColumn("n", F.col("cluster_size"))
    sized = attach_group_value(members, sizes, ["cluster_id"], "cluster_size", "n", hot_threshold(members.count()))
    return sized.select("doc_id", "cluster_id", "cluster_size", (F.col("doc_id") == F.col("cluster_id")).alias("keep"))


def mark_duplicates(docs: DataFrame, clusters: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The documents with their cluster, and ``keep``; unclustered documents are kept."""
    found = clusters.withColumnRenamed("doc_id", doc_id)
    return docs.join(found, doc_id, "left").withColumn("keep", F.coalesce("keep", F.lit(True)))


def dedup_by_scope_then_all(
    docs: DataFrame, scope: str, config: MinHashConfig = MinHashConfig(), doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Duplicates removed per scope, then over the union of what remained.

    Adds ``stage`` (``dedup_scope``, ``dedup_all``, or null for kept) and ``cluster_id`` of
    the stage that decided.
    """
    # The one shuffle of texts: every later join on their ids finds them in place.
    placed = materialise_by(docs, doc_id)
    signed = sign(placed, config, doc_id, text, scope, bucketed=True)
    within = materialise(clusters_of(bucket_matches(signed.bands, config).unionByName(signed.copies)))
    lost = within.where(~F.col("keep")).select("doc_id")
    # Hashing is the dear step and does not depend on the scope. Every survivor has its
    # signature already: the smallest id of a cluster is never a copy.
    left = signed.digests.join(lost, "doc_id", "left_anti").withColumn("scope", F.lit(""))
    left = materialise(left)
    copies = materialise(_star(left, ["digest"], left.count()))
    gone = lost.unionByName(copies.select("doc_id"))
    sigs = signed.bands.join(gone, "doc_id", "left_anti").withColumn("scope", F.lit(""))
    across = materialise(clusters_of(bucket_matches(sigs, config).unionByName(copies)))
    removed = (
        within.where(~F.col("keep"))
        .select("doc_id", "cluster_id", F.lit("dedup_scope").alias("stage"))
        .unionByName(across.where(~F.col("keep")).select("doc_id", "cluster_id", F.lit("dedup_all").alias("stage")))
    )
    return placed.join(removed.withColumnRenamed("doc_id", doc_id), doc_id, "left")


def dedup_new_crawl(
    docs: DataFrame, stored: Signed, config: MinHashConfig = MinHashConfig(), doc_id: str = "doc_id", text: str = "text"
) -> tuple[DataFrame, Signed]:
    """``(doc_id, cluster_id, keep)`` of new documents against stored ones, and the grown store.

    Only the new documents are read and hashed. Of a cluster with a stored document no new one
    is kept, of another the smallest id; ``cluster_id`` is the smallest id of the cluster, null
    for a document without duplicates. Ids of both sets must differ.
    """
    fresh = sign(docs, config, doc_id, text)
    digests = materialise(stored.digests.unionByName(fresh.digests))
    copies = materialise(_star(digests, ["scope", "digest"], digests.count()))
    # A text that both sets have is signed in both; its ids are linked as copies already.
    grown = Signed(digests, copies, stored.bands.unionByName(fresh.bands))
    clusters = materialise(clusters_of(bucket_matches(grown.bands, config).unionByName(copies)))
    new = fresh.digests.select("doc_id", F.lit(True).alias("new"))
    members = clusters.select("doc_id", "cluster_id").join(new, "doc_id", "left")
    firsts = members.groupBy("cluster_id").agg(
        F.min(F.when(F.col("new"), F.col("doc_id"))).alias("first_new"), F.count_if(F.col("new").isNull()).alias("old"), F.count("*").alias("n")
    )
    firsts = firsts.withColumn("kept_id", F.struct(F.when(F.col("old") == 0, F.col("first_new")).alias("id")))
    known = materialise(members.where("new").select("doc_id", "cluster_id"))
    marked = attach_group_value(known, firsts, ["cluster_id"], "kept_id", "n", hot_threshold(known.count()))
    verdicts = new.select("doc_id").join(marked, "doc_id", "left")
    keep = F.col("cluster_id").isNull() | F.equal_null("doc_id", "kept_id.id")
    return verdicts.select("doc_id", "cluster_id", keep.alias("keep")), grown
