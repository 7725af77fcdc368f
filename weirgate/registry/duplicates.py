"""MinHash signatures, bucket matches, clusters and dedup filters over ``documents``.

Every query runs at the default configuration of 450 buckets of 20 rows, for which SQL takes
many minutes even on the smallest tables and is not given. The same queries at 14 x 8, with
that in their names, have SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirgate.functions import text as tx
from weirgate.operators import dedup as dd
from weirgate.operators import funnel
from weirgate.registry.documents import counts_sql
from weirgate.session import materialise
from weirgate.sources.tables import read_table

SMALL = dd.MinHashConfig(buckets=14, rows=8)
FIRST_CRAWL = "src0"
DEDUP_STAGES = ("dedup_scope", "dedup_all")


def _docs(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "documents")


def _bands(spark: SparkSession, sf: str, config: dd.MinHashConfig) -> DataFrame:
    return dd.long_bands(dd.signatures(_docs(spark, sf), config)).select("doc_id", "bucket", "band_hash")


def _matches(spark: SparkSession, sf: str, config: dd.MinHashConfig) -> DataFrame:
    return dd.bucket_matches(materialise(dd.signatures(_docs(spark, sf), config)), config)


def _clusters(spark: SparkSession, sf: str, config: dd.MinHashConfig) -> DataFrame:
    return dd.duplicate_clusters(_docs(spark, sf), config)


def _clusters_by_source(spark: SparkSession, sf: str, config: dd.MinHashConfig) -> DataFrame:
    return dd.duplicate_clusters(_docs(spark, sf), config, scope="source")


def _kept(spark: SparkSession, sf: str, config: dd.MinHashConfig) -> DataFrame:
    docs = _docs(spark, sf)
    return dd.mark_duplicates(docs, dd.duplicate_clusters(docs, config)).select("doc_id", "cluster_id", "cluster_size", "keep")


def _two_level(spark: SparkSession, sf: str, config: dd.MinHashConfig) -> DataFrame:
    return dd.dedup_by_scope_then_all(_docs(spark, sf), "source", config)


def _stages(spark: SparkSession, sf: str, config: dd.MinHashConfig) -> DataFrame:
    return _two_level(spark, sf, config).select("doc_id", "stage", "cluster_id")


def _tokens_before_and_after(spark: SparkSession, sf: str, config: dd.MinHashConfig) -> DataFrame:
    docs = _docs(spark, sf)
    marked = dd.mark_duplicates(docs, dd.duplicate_clusters(docs, config)).withColumn("n", tx.token_count(F.col("text")))
    return marked.groupBy("source").agg(
        F.sum("n").alias("tokens_before"), F.coalesce(F.sum(F.when(F.col("keep"), F.col("n"))), F.lit(0)).alias("tokens_after")
    )


def _funnel(spark: SparkSession, sf: str, config: dd.MinHashConfig) -> DataFrame:
    verdicts = _two_level(spark, sf, config).withColumn("doc_len", F.length("text").cast("long"))
    return funnel.stage_counts(verdicts, stages=DEDUP_STAGES).withColumn("doc_len_avg", F.round("doc_len_avg", 6))


def _second_crawl(spark: SparkSession, sf: str, config: dd.MinHashConfig) -> DataFrame:
    """The documents of all sources but one, matched against that one's stored signatures."""
    docs = _docs(spark, sf)
    stored = dd.sign(docs.where(f"source = '{FIRST_CRAWL}'"), config)
    return dd.dedup_new_crawl(docs.where(f"source <> '{FIRST_CRAWL}'"), stored, config)[0]


_BY_CONFIG = {
    "minhash_bands": _bands,
    "minhash_matches": _matches,
    "duplicate_clusters": _clusters,
    "duplicate_clusters_by_source": _clusters_by_source,
    "dedup_filter": _kept,
    "dedup_by_source_then_all": _stages,
    "dedup_funnel": _funnel,
    "tokens_before_and_after_dedup": _tokens_before_and_after,
    "second_crawl": _second_crawl,
}


def _at(query, config: dd.MinHashConfig):
    return lambda spark, sf: query(spark, sf, config)


QUERIES = {
    "exact_copies": lambda spark, sf: dd.exact_copies(_docs(spark, sf)),
    **{name: _at(query, dd.MinHashConfig()) for name, query in _BY_CONFIG.items()},
    **{f"{name}_14x8": _at(query, SMALL) for name, query in _BY_CONFIG.items()},
}

_MOD = "18446744073709551616"


def _hash60(text: str) -> str:
    return f"('0x' || substr(md5({text}), 1, 15))::BIGINT"


def _bands_sql(docs: str, suffix: str, scope: str = "''") -> str:
    s, c = suffix, SMALL
    return f"""
tok{s} AS (
  SELECT doc_id, scope, unnest(words) AS w, unnest(range(1, len(words) + 1)) AS p
  FROM (SELECT doc_id, {scope} AS scope, regexp_extract_all(lower(text), '{tx.WORD}') AS words FROM {docs})),
wide{s} AS (
  SELECT doc_id, scope, {" || ' ' || ".join(["w"] + [f"lead(w, {i}) OVER follow" for i in range(1, c.shingle_words)])} AS shingle
  FROM tok{s} WINDOW follow AS (PARTITION BY doc_id ORDER BY p)),
shingles{s} AS MATERIALIZED (SELECT DISTINCT doc_id, scope, {_hash60("shingle")} AS x FROM wide{s} WHERE shingle IS NOT NULL),
lows{s} AS (
  SELECT doc_id, scope, i, min((x::HUGEINT * mul + add) % {_MOD}) AS m FROM shingles{s}, perms GROUP BY doc_id, scope, i),
bands{s} AS MATERIALIZED (
  SELECT doc_id, scope, bucket, (CASE WHEN h >= 9223372036854775808 THEN h - {_MOD} ELSE h END)::BIGINT AS band_hash FROM (
    SELECT doc_id, scope, (l.i // {c.rows})::INTEGER AS bucket, sum((m * mix) % {_MOD}) % {_MOD} AS h
    FROM lows{s} l JOIN mixes x ON x.i = l.i % {c.rows} GROUP BY doc_id, scope, bucket))"""


def _clusters_sql(docs: str, suffix: str, scope: str = "''", bands: str | None = None) -> str:
    s = suffix
    return (
        (bands or _bands_sql(docs, suffix, scope))
        + f""",
firsts{s} AS (
  SELECT doc_id, min(doc_id) OVER (PARTITION BY scope, bucket, band_hash) AS first_id FROM bands{s}
  UNION ALL SELECT doc_id, min(doc_id) OVER (PARTITION BY {scope}, text) FROM {docs}),
links{s} AS (SELECT DISTINCT doc_id AS a, first_id AS b FROM firsts{s} WHERE doc_id <> first_id),
sym{s} AS (SELECT a, b FROM links{s} UNION SELECT b, a FROM links{s}),
reach{s}(a, b) AS (
  SELECT a, b FROM sym{s} UNION SELECT r.a, s.b FROM reach{s} r JOIN sym{s} s ON r.b = s.a),
clusters{s} AS MATERIALIZED (
  SELECT doc_id, cluster_id, count(*) OVER (PARTITION BY cluster_id) AS cluster_size, doc_id = cluster_id AS keep
  FROM (SELECT a AS doc_id, least(a, min(b)) AS cluster_id FROM reach{s} GROUP BY a))"""
    )


_PERMS = f"""RECURSIVE
perms AS (
  SELECT i, ({_hash60(f"'{SMALL.seed}:mul:' || i")} | 1)::HUGEINT AS mul, {_hash60(f"'{SMALL.seed}:add:' || i")}::HUGEINT AS add
  FROM range({SMALL.buckets * SMALL.rows}) AS t(i)),
mixes AS (SELECT i, ({_hash60(f"'{SMALL.seed}:mix:' || i")} | 1)::HUGEINT AS mix FROM range({SMALL.rows}) AS t(i)),"""
def sql_over(prefix: str, bands: str, bands_by_source: str) -> dict[str, str]:
    """The checks of all queries on tables ``bands1`` of the whole and by source, however these are made."""
    one = f"{prefix} {_clusters_sql('documents', '1', bands=bands)}"
    by_source = f"{prefix} {_clusters_sql('documents', '1', 'source', bands=bands_by_source)}"
    two = (
        by_source
        + ", left_over AS (SELECT d.* FROM documents d WHERE doc_id NOT IN (SELECT doc_id FROM clusters1 WHERE NOT keep)),"
        + _clusters_sql("left_over", "2", bands="""
bands2 AS (SELECT doc_id, '' AS scope, bucket, band_hash FROM bands1 WHERE doc_id IN (SELECT doc_id FROM left_over))""")
        + """, decided AS (
  SELECT d.doc_id, d.source, length(d.text)::BIGINT AS doc_len, coalesce(a.cluster_id, b.cluster_id) AS cluster_id,
    CASE WHEN a.doc_id IS NOT NULL THEN 'dedup_scope' WHEN b.doc_id IS NOT NULL THEN 'dedup_all' END AS stage,
    CASE WHEN a.doc_id IS NOT NULL THEN 0 WHEN b.doc_id IS NOT NULL THEN 1 ELSE 2 END AS rank
  FROM documents d LEFT JOIN (SELECT * FROM clusters1 WHERE NOT keep) a USING (doc_id)
    LEFT JOIN (SELECT * FROM clusters2 WHERE NOT keep) b USING (doc_id))"""
    )
    return {
        "minhash_bands": f"WITH {prefix} {bands} SELECT doc_id, bucket, band_hash FROM bands1",
        "minhash_matches": f"""WITH {prefix} {bands}
        SELECT DISTINCT doc_id, first_id FROM (SELECT doc_id, min(doc_id) OVER (PARTITION BY bucket, band_hash) AS first_id FROM bands1)
        WHERE first_id < doc_id""",
        "duplicate_clusters": f"WITH {one} SELECT * FROM clusters1",
        "duplicate_clusters_by_source": f"WITH {by_source} SELECT * FROM clusters1",
        "dedup_filter": f"""WITH {one} SELECT d.doc_id, cluster_id, cluster_size, coalesce(keep, true) AS keep
        FROM documents d LEFT JOIN clusters1 USING (doc_id)""",
        "dedup_by_source_then_all": f"WITH {two} SELECT doc_id, stage, cluster_id FROM decided",
        "dedup_funnel": f"""WITH {two}, counts AS ({counts_sql(DEDUP_STAGES, 'decided')})
        SELECT * REPLACE (round(doc_len_avg, 6) AS doc_len_avg) FROM counts""",
        "tokens_before_and_after_dedup": f"""WITH {one}, sized AS (
          SELECT d.source, coalesce(c.keep, true) AS keep, len(regexp_extract_all(d.text, '{tx.TOKEN}')) AS n
          FROM documents d LEFT JOIN clusters1 c USING (doc_id))
        SELECT source, sum(n)::BIGINT AS tokens_before, coalesce(sum(n) FILTER (keep), 0)::BIGINT AS tokens_after FROM sized GROUP BY source""",
        "second_crawl": f"""WITH {one}, members AS (
          SELECT doc_id, source, coalesce(cluster_id, -1 - doc_id) AS c, cluster_id FROM documents LEFT JOIN clusters1 USING (doc_id) WHERE text IS NOT NULL),
        firsts AS (SELECT c, min(doc_id) FILTER (source <> '{FIRST_CRAWL}') AS first_new, bool_or(source = '{FIRST_CRAWL}') AS old FROM members GROUP BY c)
        SELECT doc_id, cluster_id, NOT old AND doc_id = first_new AS keep FROM members JOIN firsts USING (c) WHERE source <> '{FIRST_CRAWL}'""",
    }


SQL = {f"{name}_14x8": sql for name, sql in sql_over(_PERMS, _bands_sql("documents", "1"), _bands_sql("documents", "1", "source")).items()}
SQL["exact_copies"] = "SELECT doc_id, first_id FROM (SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS first_id FROM documents) WHERE first_id < doc_id"

# The same checks over a table of bands of any size that is already there as ``stored_bands``.
OVER_STORED_BANDS = sql_over(
    "RECURSIVE",
    "bands1 AS (SELECT doc_id, '' AS scope, bucket, band_hash FROM stored_bands)",
    "bands1 AS (SELECT doc_id, source AS scope, bucket, band_hash FROM stored_bands JOIN documents USING (doc_id))",
)
