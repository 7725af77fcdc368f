"""Operator 1: exact top-k search by exhaustive term-at-a-time accumulation.

Query and candidate vectors are sparse rows of integer weights. They meet in tiles, one block
of queries with one block of candidates. In a tile, each dimension is a term with a posting
list of (candidate slot, weight); every query scatters its weighted postings into a dense
array of scores, term after term. A partial selection leaves k answers per query and tile,
and a window over the tiles merges them.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weirgate.llm.common import table

K = 10
SCALE = 1024
QUERY_EVERY = 100
QUERY_BLOCK = 4096
CANDIDATE_BLOCK = 2048

# Scores of this many queries are held at a time: 8 bytes for each of them and each candidate.
QUERIES_AT_ONCE = 256


def quantised(vector: Column, scale: int = SCALE) -> Column:
    """``floor(scale * x)`` of each component as long; null unless all components are finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(~bad, F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))))


def _sparse(vectors: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers, dimensions and weights of the components that are not 0, row by row."""
    n = np.fromiter((len(v) for v in vectors), np.int64, len(vectors))
    flat = np.concatenate(vectors).astype(np.int64) if n.sum() else np.empty(0, np.int64)
    row = np.repeat(np.arange(len(vectors)), n)
    dim = np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)
    there = flat != 0
    return row[there], dim[there], flat[there]


def accumulate(queries: list, candidates: list):
    """Yield ``(first query, scores)``: dense arrays, queries at once x candidates."""
    slot, dim, weight = _sparse(candidates)
    order = np.argsort(dim, kind="stable")
    slot, dim, weight = slot[order], dim[order], weight[order]
    terms, begin = np.unique(dim, return_index=True)
    postings = {t: (slot[a:b], weight[a:b]) for t, a, b in zip(terms.tolist(), begin, [*begin[1:], len(dim)])}
    for first in range(0, len(queries), QUERIES_AT_ONCE):
        some = queries[first : first + QUERIES_AT_ONCE]
        scores = np.zeros((len(some), len(candidates)), dtype=np.int64)
        row, term, own = _sparse(some)
        for q, t, w in zip(row.tolist(), term.tolist(), own.tolist()):
            if t in postings:
                slots, weights = postings[t]
                if len(slots) == len(candidates):
                    scores[q] += w * weights
                else:
                    scores[q, slots] += w * weights
        yield first, scores


def select(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id; ``ids`` ascend."""
    if len(scores) <= k:
        return np.lexsort((ids, -scores))
    bar = np.partition(scores, len(scores) - k)[len(scores) - k]
    above = np.flatnonzero(scores > bar)
    best = np.concatenate([above, np.flatnonzero(scores == bar)[: k - len(above)]])
    return best[np.lexsort((ids[best], -scores[best]))]


def _tile(queries: pd.DataFrame, candidates: pd.DataFrame, k: int) -> pd.DataFrame:
    out = []
    if len(queries) and len(candidates):
        candidates = candidates.sort_values("id", kind="stable", ignore_index=True)
        queries = queries.sort_values("id", kind="stable", ignore_index=True)
        ids, start = np.unique(candidates["id"].to_numpy(), return_index=True)
        own, own_start = np.unique(queries["id"].to_numpy(), return_index=True)
        own_start = [*own_start.tolist(), len(queries)]
        vectors, held = list(queries["vec"]), {}
        for first, scores in accumulate(vectors, list(candidates["vec"])):
            if len(ids) < len(candidates):
                scores = np.maximum.reduceat(scores, start, axis=1)
            for i, line in enumerate(scores):
                held[first + i] = line
            while own_start[0] in held and own_start[1] - 1 in held:
                rows = [held.pop(i) for i in range(own_start[0], own_start[1])]
                line, q = np.maximum.reduce(rows), own[len(own) - len(own_start) + 1]
                other = np.flatnonzero(ids != q)
                best = other[select(line[other], ids[other], k)]
                out.append(pd.DataFrame({"query_id": q, "vec_id": ids[best], "score": line[best]}))
                own_start.pop(0)
                if len(own_start) == 1:
                    break
    return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")


def top_k(
    queries: DataFrame,
    candidates: DataFrame,
    k: int = K,
    query_block: int = QUERY_BLOCK,
    candidate_block: int = CANDIDATE_BLOCK,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` for ``queries(id, vec)`` against ``candidates(id, vec)``.

    ``vec`` is an array of long; a dimension that one side lacks counts as 0, so an empty
    vector has the score 0 with every other. Fewer than k candidates give fewer rows. Ties go
    to the smaller id. Rows with a null id or vector take no part. An id never answers its
    own query; an id that occurs more than once answers once, with its best score, so repeated
    rows change nothing. Empty tables give an empty result.

    Shuffled are the queries once per candidate block and the candidates once per query
    block; a tile holds one block of each, and passes on k rows per query.
    """
    queries = queries.where("id IS NOT NULL AND vec IS NOT NULL").select("id", "vec")
    candidates = candidates.where("id IS NOT NULL AND vec IS NOT NULL").select("id", "vec")
    spark = queries.sparkSession
    nq = max(1, -(-queries.count() // query_block))
    nc = max(1, -(-candidates.count() // candidate_block))
    place = lambda n: F.pmod(F.xxhash64("id"), F.lit(n))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = queries.select("id", "vec", place(nq).cast("int").alias("qb"), every(nc).alias("cb"))
    right = candidates.select("id", "vec", every(nq).alias("qb"), place(nc).cast("int").alias("cb"))
    tiles = left.groupBy("qb", "cb").cogroup(right.groupBy("qb", "cb"))
    found = tiles.applyInPandas(lambda a, b: _tile(a, b, k), "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def search_embeddings(
    vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", every: int = QUERY_EVERY, k: int = K, scale: int = SCALE
) -> DataFrame:
    """:func:`top_k` of the quantised vectors whose id is divisible by ``every`` against all.

    Vectors that are null or hold a null or non-finite component take no part.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), quantised(F.col(vec_col), scale).alias("vec"))
    return top_k(rows.where(F.col("id") % every == 0), rows, k)


def query(spark, folder: str) -> DataFrame:
    return search_embeddings(table(spark, folder, "embeddings"))


SQL = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS vec FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(CAST(q.vec AS DOUBLE[]), CAST(c.vec AS DOUBLE[])) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""
