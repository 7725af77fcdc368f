"""Operator 13: a Merkle manifest of a dataset by cogrouped subtree exchange.

Rows are leaves of one tree per source, whose roots are the leaves of one tree more. Leaves are
cut into superblocks, subtrees of LEVELS levels. Upwards, superblocks reduce to nodes, and those
again, until one node is left. Downwards, each superblock's leaves and the outer node it needs,
the siblings on its way to the root, are cogrouped: the group finishes its own reduction, joins
its proofs to the outer one and folds them. A group holds one superblock, whatever the source.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirgate.llm.common import crc32_list_sql, positioned, table
from weirgate.session import materialise

ARITY = 3
LEVELS = 7
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")

NODE_DDL = "tree string, pos long, total long, node string, name string"
OUTER_DDL = "tree string, block long, path string, subroot string"
FOLDED_DDL = "doc_id string, leaf string, subroot string, proof_sha256 string, folded_root string"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def encoded(column: Column) -> Column:
    """A value as its UTF-8 byte count, a colon and the value; ``-`` for null."""
    value = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_of(fields: dict[str, Column]) -> Column:
    return F.sha2(F.concat(*[encoded(c) for c in fields.values()]), 256)


def tampered_text(doc_id: Column, text: Column) -> Column:
    """The text without line feeds where 2 divides the id's crc32; a null id is left alone."""
    hit = F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 2 == 0, F.lit(False))
    return F.when(hit, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)


def height(total: int, levels: int) -> int:
    """Levels a superblock of a tree of ``total`` nodes is reduced by."""
    found = 0
    while found < levels and total > 1:
        total, found = -(-total // ARITY), found + 1
    return found


def subtree(nodes: list[str], levels: int) -> list[list[str]]:
    """All levels of a subtree from its leaves up."""
    found = [nodes]
    for _ in range(levels):
        below = found[-1]
        found.append([digest("".join(below[i : i + ARITY])) for i in range(0, len(below), ARITY)])
    return found


def path_in(levels: list[list[str]], at: int) -> str:
    """The siblings of leaf ``at`` level by level, as ``left|right`` joined by ``/``."""
    steps = []
    for below in levels[:-1]:
        first = at - at % ARITY
        steps.append("".join(below[first:at]) + "|" + "".join(below[at + 1 : first + ARITY]))
        at //= ARITY
    return "/".join(steps)


def joined(path: str, outer: str) -> str:
    return f"{path}/{outer}" if path and outer else path or outer


def folded(node: str, path: str) -> str:
    """The root that a node and its path lead to."""
    for step in path.split("/") if path else ():
        left, right = step.split("|")
        node = digest(left + node + right)
    return node


def _in_order(rows: pd.DataFrame, levels: int) -> tuple[pd.DataFrame, list[list[str]]]:
    rows = rows.sort_values("pos", ignore_index=True)
    return rows, subtree(rows["node"].tolist(), height(int(rows["total"].iloc[0]), levels))


def reduced(nodes: DataFrame, levels: int) -> DataFrame:
    """The nodes above: one for each superblock. A tree of one node stays as it is."""
    wide = ARITY**levels

    def reduce(rows: pd.DataFrame) -> pd.DataFrame:
        rows, tree = _in_order(rows, levels)
        first = rows.iloc[0]
        return pd.DataFrame({"tree": [first["tree"]], "pos": [int(first["pos"]) // wide], "total": [-(-int(first["total"]) // wide)], "node": tree[-1], "name": [None]})

    block = F.floor(F.col("pos") / wide).alias("block")
    return nodes.groupBy("tree", block).applyInPandas(reduce, NODE_DDL)


def expanded(nodes: DataFrame, outer: DataFrame, levels: int) -> DataFrame:
    """``(tree, block, path, subroot)`` of each node: its path to the root, for the superblock below it.

    A node with a ``name`` is the root of the tree of that name: it becomes the outer node of that
    tree's only superblock, with itself as ``subroot``.
    """

    def expand(rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return pd.DataFrame({c: [] for c in ("tree", "block", "path", "subroot")})
        rows, tree = _in_order(rows, levels)
        path, subroot = above["path"].iloc[0], above["subroot"].iloc[0]
        named = rows["name"].notna().to_numpy()
        wide = ARITY**levels
        return pd.DataFrame({
            "tree": rows["name"].where(named, rows["tree"]),
            "block": rows["pos"].where(~named, 0),
            "path": [joined(path_in(tree, int(p) % wide), path) for p in rows["pos"]],
            "subroot": rows["node"].where(named, subroot),
        })

    block = F.floor(F.col("pos") / ARITY**levels).alias("block")
    return nodes.groupBy("tree", block).cogroup(outer.groupBy("tree", "block")).applyInPandas(expand, OUTER_DDL)


def finished(leaves: DataFrame, outer: DataFrame, levels: int) -> DataFrame:
    """Local reduction, proofs and folding of each superblock of leaves with its outer node."""

    def finish(rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return pd.DataFrame({c.split()[0]: [] for c in FOLDED_DDL.split(", ")})
        rows, tree = _in_order(rows, levels)
        outer_path, wide = above["path"].iloc[0], ARITY**levels
        paths = [joined(path_in(tree, int(p) % wide), outer_path) for p in rows["pos"]]
        start = rows["tampered"].where(rows["tampered"].notna(), rows["node"])
        return pd.DataFrame({
            "doc_id": rows["doc_id"],
            "leaf": rows["node"],
            "subroot": above["subroot"].iloc[0],
            "proof_sha256": [digest(p.replace("/", "").replace("|", "")) for p in paths],
            "folded_root": [folded(n, p) for n, p in zip(start, paths)],
        })

    block = F.floor(F.col("pos") / ARITY**levels).alias("block")
    leaves = leaves.withColumn("doc_id", F.col("doc_id").cast("string"))  # pandas has no integers besides nulls
    return leaves.groupBy("tree", block).cogroup(outer.groupBy("tree", "block")).applyInPandas(finish, FOLDED_DDL)


def _levels_up(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """The tables of nodes from ``nodes`` up to one node a tree."""
    most = nodes.agg(F.max("total")).first()[0] or 0
    tables = [nodes]
    while len(tables) == 1 or most > 1:
        tables.append(materialise(reduced(tables[-1], levels)))
        most = -(-most // ARITY**levels)
    return tables


def merkle_manifest(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """``(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)``, one row per input row.

    A leaf is the SHA-256 of the row's five columns. In each source's tree, leaves ascend by id
    and every ARITY neighbours, or the fewer at the end, give one node, until one is left. The
    sources' nodes, null first, then in byte order, give the root likewise. ``proof_sha256`` is
    the digest of the siblings on the way up; ``folded_root`` is what the leaf, tampered with
    where 2 divides the crc32 of the id, and those siblings lead to.

    Nulls in any column are part of the leaf as ``-``; a null id comes first and is never
    tampered with; a null source is a source of its own. Rows that repeat an id are ordered by
    their leaves; rows that repeat a leaf as well are alike, so either may have either place.
    Empty texts and texts of any length are hashed whole. Other columns are not read. A lone
    row's leaf is its source's node, and the root if there is no other source. An empty table
    gives an empty result.
    """
    fields = {c: F.col(c) for c in COLUMNS}
    changed = fields | {"text": tampered_text(F.col("doc_id"), F.col("text"))}
    own = F.col("source").cast("string")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.concat(F.lit("="), own), F.lit("")).alias("tree"),  # null first, then in byte order
        leaf_of(fields).alias("node"),
        F.when(changed["text"] != F.col("text"), leaf_of(changed)).alias("tampered"),
    )
    leaves = materialise(positioned(materialise(rows), ["tree"], ["doc_id", "node"]).withColumn("name", F.lit(None).cast("string")))
    below = _levels_up(leaves, levels)
    subroots = below[-1].select(F.col("tree").alias("name"), "node")
    top = positioned(subroots, [], ["name"]).select(F.lit("").alias("tree"), "pos", "total", "node", "name")
    above = _levels_up(materialise(top), levels)
    root = above[-1].first()
    outer = above[-1].select("tree", F.col("pos").alias("block"), F.lit("").alias("path"), F.lit(None).cast("string").alias("subroot"))
    for nodes in [*above[-2::-1], *below[-2:0:-1]]:
        outer = materialise(expanded(nodes, outer, levels))
    found = finished(leaves, outer, levels).withColumn("root", F.lit(root["node"] if root else None).cast("string"))
    return found.select(F.col("doc_id").cast("long").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def query(spark, folder: str) -> DataFrame:
    return merkle_manifest(table(spark, folder, "documents"))


def _leaf_sql(text: str) -> str:
    fields = [f"CAST({c} AS VARCHAR)" if c != "text" else text for c in COLUMNS]
    return "sha256(" + " || ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields) + ")"


_TAMPERED = f"""CASE WHEN {crc32_list_sql("list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))")} % 2 = 0
    THEN replace(text, chr(10), '') ELSE text END"""

SQL = f"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n
  FROM (SELECT row_number() OVER () AS id, doc_id, source, {_leaf_sql("text")} AS leaf, {_leaf_sql(_TAMPERED)} AS start FROM documents)
), nodes(level, source, pos, n, node) AS (
  SELECT 0, source, pos, n, leaf FROM d
  UNION ALL
  SELECT level + 1, source, pos // 3, (n + 2) // 3, sha256(string_agg(node, '' ORDER BY pos)) FROM nodes WHERE n > 1 GROUP BY level, source, pos // 3, n
), subroots AS MATERIALIZED (
  SELECT source, node, row_number() OVER (ORDER BY source IS NOT NULL, encode(source)) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1
), tops(level, pos, n, node) AS (
  SELECT 0, pos, n, node FROM subroots
  UNION ALL
  SELECT level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(node, '' ORDER BY pos)) FROM tops WHERE n > 1 GROUP BY level, pos // 3, n
), siblings AS (
  SELECT d.id, x.level, x.pos, x.node, sign(x.pos - d.pos // CAST(pow(3, x.level) AS BIGINT)) AS side
  FROM d JOIN nodes x ON x.source IS NOT DISTINCT FROM d.source AND x.n > 1 AND x.pos // 3 = d.pos // CAST(pow(3, x.level + 1) AS BIGINT)
  UNION ALL
  SELECT d.id, 1000 + x.level, x.pos, x.node, sign(x.pos - s.pos // CAST(pow(3, x.level) AS BIGINT))
  FROM d JOIN subroots s ON s.source IS NOT DISTINCT FROM d.source JOIN tops x ON x.n > 1 AND x.pos // 3 = s.pos // CAST(pow(3, x.level + 1) AS BIGINT)
), steps AS MATERIALIZED (
  SELECT id, row_number() OVER (PARTITION BY id ORDER BY level) AS step, coalesce(string_agg(node, '' ORDER BY pos) FILTER (WHERE side < 0), '') AS l,
    coalesce(string_agg(node, '' ORDER BY pos) FILTER (WHERE side > 0), '') AS r FROM siblings GROUP BY id, level
), fold(id, step, node) AS (
  SELECT id, 0, start FROM d
  UNION ALL
  SELECT fold.id, steps.step, sha256(l || node || r) FROM fold JOIN steps ON steps.id = fold.id AND steps.step = fold.step + 1
), ends AS (
  SELECT id, arg_max(node, step) AS folded_root FROM fold GROUP BY id
), proofs AS (
  SELECT id, sha256(string_agg(l || r, '' ORDER BY step)) AS proof FROM steps GROUP BY id
)
SELECT d.doc_id, d.leaf, s.node AS subroot, t.node AS root, coalesce(proofs.proof, sha256('')) AS proof_sha256, ends.folded_root, ends.folded_root = t.node AS verified
FROM d JOIN subroots s ON s.source IS NOT DISTINCT FROM d.source JOIN tops t ON t.n = 1 JOIN ends USING (id) LEFT JOIN proofs USING (id)
"""
